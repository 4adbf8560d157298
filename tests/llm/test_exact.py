"""Operators with exact results: tokenizer libraries, round trips, SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import license_sentences, pfor_tokens, sentencepiece_agenda, simhash_windows
from lodestone.llm.queries import ORACLE_SQL, QUERIES
from lodestone.llm.unit_cache import UnitCache
from lodestone.sources.tables import table

SF = "/root/testdata/sf0.001"
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = [(None, "no id"), (3, None), (2, ""), (9, "  "), (5, "a " * 50000 + "end"), (5, "again"), (6, "é漢😀▁\x00<s> <|endoftext|>\r\n\tit's")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, page string, shard int")


def some_texts(n, seed):
    random.seed(seed)
    alphabet = [" ", "  ", "a", "B", "\n", "\t", ".", ",", "'s", "'", "the", "é", "漢", "😀", "▁", "\x00", "<s>", "0", "19", "　", "́",
                "ﬁ", "\x85", "İ", "_", "…", "<|endoftext|>", "!!", "ing"]
    return ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(n)]


# --- SentencePiece -------------------------------------------------------------

def test_agenda_equals_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = some_texts(2000, 1) + ["a" * 500, "the" * 300, "", " "]
    v = sentencepiece_agenda.Vocabulary(PIECES)
    ids, at = sentencepiece_agenda.encode_rows(v, v.cache(), pa.array(texts))
    want = lib.encode(texts, add_bos=True, add_eos=True)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    assert [t.decode() for t in sentencepiece_agenda.decode_rows(v, ids, at)] == lib.decode(want)


def test_sentencepiece_query_and_odd_rows(spark, odd):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def digest(text):
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(lib.decode(ids).encode()).hexdigest())

    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_agenda.encode_digests(odd, PIECES).collect())
    assert got == Counter((i, *digest(t)) for i, t in ODD)
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op3_sentencepiece_agenda"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {i: digest(t) for i, t in docs.items()}
    assert sentencepiece_agenda.encode_digests(odd.limit(0), PIECES).count() == 0
    coded = sentencepiece_agenda.encode_ids(odd.where("doc_id in (2, 5)"), PIECES)
    assert Counter((r.doc_id, r.text) for r in sentencepiece_agenda.decode_ids(coded, PIECES).collect()) == \
        Counter((i, t) for i, t in ODD if i in (2, 5))


def test_decoding_equals_library_on_ids_of_no_text(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(lib.get_piece_size()) if lib.is_byte(i)}
    rng = random.Random(5)
    rows = [[byte[0xE6], byte[0xBC]], [byte[0xF0], byte[0x9F], byte[0x41]], [0], [1, 0, 300, 2], [], None, [byte[0xE6], byte[0xBC], byte[0xA2]]]
    rows += [[rng.choice([0, 1, 2, rng.randint(3, 31999), rng.randint(3, 258)]) for _ in range(rng.randint(0, 12))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in sentencepiece_agenda.decode_ids(df, PIECES).collect()}
    assert got == {i: lib.decode(r or []) for i, r in enumerate(rows)}


def test_a_unit_unlike_the_library_fails():
    v = sentencepiece_agenda.Vocabulary(PIECES)
    v.encode_units([b" the", b"(", b"\n", b" "])
    v.encode_unit = lambda unit: [5]
    with pytest.raises(ValueError):
        v.encode_units([b"("])


# --- token shards --------------------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50000), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=400))
def test_block_round_trip(ids):
    a = np.array(ids, dtype=np.uint32)
    assert (pfor_tokens.unpack_block(pfor_tokens.pack_block(a)) == a).all()


def test_page_ranges():
    ids = np.random.default_rng(0).integers(0, 49408, 5000).astype(np.uint32)
    data, starts = pfor_tokens.pack_page(ids)
    assert len(starts) == 5
    for s, n in ((0, 5000), (1000, 100), (1023, 2), (4999, 1), (7, 0)):
        assert (pfor_tokens.read_range(data, starts, s, n) == ids[s:s + n]).all()


def test_unit_encoder_equals_library():
    e = pfor_tokens.UnitEncoder(WORDS)
    texts = some_texts(3000, 2)
    assert [x.tolist() for x in e.encode(pa.array(texts))] == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]


class CountingLibrary:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, lib):
        self.lib, self.texts = lib, 0

    def __getattr__(self, name):
        return getattr(self.lib, name)

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.lib.encode_batch_fast(texts, **kw)


def test_units_go_to_the_library_together():
    e = pfor_tokens.UnitEncoder(WORDS)
    e.lib = CountingLibrary(e.lib)
    words = [a + b + c for a in "bdfgklmnprst" for b in ("ai", "e", "ö", "ou", "łe") for c in "bdfgklmnprst"]
    got = e.encode(pa.array([" ".join(words), ", ".join(words) + "."]))
    assert e.lib.texts <= 10
    assert [x.tolist() for x in got] == [e.lib.encode(t, add_special_tokens=False).ids
                                         for t in (" ".join(words), ", ".join(words) + ".")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abEZ019 ,.(<='’éÉßžİıŉſ×÷ªǅΣς漢र्\u0301\u0307\u0338\u00a0\u3000😀ĸ\u1c89")
                        | st.characters(exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=20))
def test_units_of_any_text_equal_library(texts):
    e = pfor_tokens.worker_encoder(WORDS)
    assert [x.tolist() for x in e.encode(pa.array(texts))] == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]


def test_cut_letters_next_to_marks_equal_library():
    e = pfor_tokens.UnitEncoder(WORDS)
    texts = [t for c in map(chr, range(0x80, 0x250)) for t in (f"a{c},b", f"({c}a", f"{c}", f"{c}{c}.", f"a{c}'s", f".{c}'{c},")]
    assert [x.tolist() for x in e.encode(pa.array(texts))] == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("max_units", [3000, 10000])
def test_unit_cache_equals_a_dictionary(max_units):
    sent = []
    cache = UnitCache(lambda units: sent.extend(units) or [list(u) for u in units], max_units)
    rng = np.random.default_rng(5)
    for _ in range(40):
        words = [str(n).encode() for n in rng.integers(0, 5000, 900)]
        padded = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        ids, n = cache.ids(padded, ends - [len(w) for w in words], ends)
        assert ids.tolist() == [b for w in words for b in w]
        assert n.tolist() == [len(w) for w in words]
    if max_units == 3000:
        assert len(cache) <= 3900 and len(sent) > len(set(sent))
    else:
        assert len(cache) == len(sent) == len(set(sent))


def test_unit_cache_finds_hashes_that_meet():
    cache = UnitCache(lambda units: [[1]] * len(units))
    hashes = np.array([0, 4096, 8192, 2 ** 63, 4095, 7, 2 ** 64 - 1], np.uint64)
    cache._add(hashes[:6], [b"x"] * 6)
    assert cache._find(hashes).tolist() == [0, 1, 2, 3, 4, 5, -1]
    cache._table(8192)
    assert cache._find(hashes).tolist() == [0, 1, 2, 3, 4, 5, -1]


def test_token_shards(spark, odd, monkeypatch):
    lib = pfor_tokens.load(WORDS)
    for df in (table(spark, SF, "documents"), odd.where("doc_id is not null")):
        rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0], r[1] or ""))
        want, at = [], 0
        for i, t in rows:
            ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in pfor_tokens.token_digests(df, WORDS).collect())
        assert got == sorted(want)
    first = pfor_tokens.token_digests(odd, WORDS).where("doc_id is null").collect()
    assert [r.start for r in first] == [0]
    assert pfor_tokens.token_digests(odd.limit(0), WORDS).count() == 0


# --- licences ------------------------------------------------------------------

def duck(sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op5_license_sentences", "op10_simhash_decontamination"])
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    got, ref = QUERIES[name](spark, sf).toPandas(), duck(sf).sql(ORACLE_SQL[name]).df()
    cols = sorted(ref.columns)
    assert sorted(got.columns) == cols and len(got) > 0
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, ref[cols].values.tolist()))


def test_license_rules(spark):
    s = license_sentences.SENTENCES
    wrapped = re.sub(r"((?:\S+ ){9})(?=[a-z])", lambda m: m.group().rstrip() + "\n", s["mit-grant"])
    rows = [
        (1, f"Intro text. {wrapped}:\n\n{s['mit-notice']}.\nrest of it."),
        (2, f"{s['bsd-redist']}:\n1. {s['bsd-source']}.\n2. {s['bsd-binary']}.\n3. {s['bsd-names']}.\n"),
        (3, f"{s['bsd-redist']}:\n{s['bsd-source']}.\n{s['bsd-binary']}.\n"),
        (4, "Code.\nLICENSED under  the APACHE License, version 2.0.\nReleased under the MIT License.\nReleased under the MIT License."),
        (5, "the license of this text is unknown."), (6, None), (7, ""), (8, "x. " * 30000 + "Licensed under CC BY-NC 4.0."),
        (None, "SPDX-License-Identifier: MIT")]
    df = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, ids int, seq string")
    got = {(r.doc_id, r.license, r.n_matches) for r in license_sentences.scan_licenses(df).collect()}
    assert got == {(1, "MIT", 1), (2, "BSD-3-Clause", 1), (3, "BSD-2-Clause", 1), (4, "Apache-2.0", 1), (4, "MIT", 2),
                   (8, "CC-BY-NC-4.0", 1), (None, "MIT", 1)}
    assert license_sentences.scan_licenses(df.limit(0)).count() == 0


GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE2 = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the Example University, Dept. of Things nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""


def marked(text, before, first="", last=""):
    return first + "".join(f"{before}{line}\n" for line in text.split("\n")) + last


def test_published_headers(spark):
    lgpl = GPL2.replace("This program is", "This library is").replace("General Public", "Lesser General Public").replace("version 2 ", "version 2.1 ")
    wanted = [("GPL-2.0-or-later", GPL2), ("MPL-2.0", MPL2), ("Apache-2.0", APACHE2), ("BSD-3-Clause", BSD3), ("LGPL-2.1-or-later", lgpl),
              ("LGPL-2.0-or-later", "See the GNU Lesser General Public License for more details."),
              ("AGPL-3.0-or-later", license_sentences.SENTENCES["agpl-free3"]),
              ("ISC", "Copyright (c) 2020, A. Person\n" + license_sentences.SENTENCES["isc-grant2"] + ".")]
    rows, want = [], set()
    for name, text in wanted:
        for form in (text, marked(text, " * ", "/*\n", " */"), marked(text, "# "), marked(text, "// "), "Copyright 2001 X\n" + text + "\nint main() {}"):
            want.add((len(rows), name))
            rows.append((len(rows), form))
    for form, names in (("/* SPDX-License-Identifier: Apache-2.0 OR MIT */", ("Apache-2.0", "MIT")),
                        ("# SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0) AND BSD-3-Clause\n", ("GPL-2.0-or-later", "BSD-3-Clause")),
                        ("// SPDX-License-Identifier: MPL-2.0.\nmit", ("MPL-2.0",))):
        want |= {(len(rows), n) for n in names}
        rows.append((len(rows), form))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_sentences.scan_licenses(df).collect()
    assert {(r.doc_id, r.license) for r in got} == want and {r.n_matches for r in got} == {1}
    con = duckdb.connect()
    con.register("headers", df.toPandas())
    ref = con.sql(license_sentences.oracle_sql("headers")).fetchall()
    assert sorted(ref) == sorted((r.doc_id, r.license, r.n_matches, r.n_sentences) for r in got)


def test_every_sentence_has_a_rule(spark):
    used = {i for _, ids in license_sentences.RULES for i in ids}
    assert used == set(license_sentences.SENTENCES)
    df = spark.createDataFrame([(i, f"Intro. {t}, and more") for i, t in enumerate(license_sentences.SENTENCES.values())], "doc_id long, text string")
    assert {r.doc_id for r in license_sentences.scan_licenses(df).collect()} == set(range(len(license_sentences.SENTENCES)))
    assert all(any(a in t.lower() for a in license_sentences.ANCHORS) for t in license_sentences.SENTENCES.values())


# --- decontamination -----------------------------------------------------------

def brute_windows(docs, items, threshold=0.8):
    """Every window of item length of every document."""
    out = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for j, it in items:
            q = re.findall(r"[^\x20\x09-\x0D]+", it or "")
            k = min(5, len(q))
            if not q or len(w) < k:
                continue
            want = Counter(tuple(q[a:a + k]) for a in range(len(q) - k + 1))
            for s in range(max(1, len(w) - len(q) + 1)):
                win = w[s:s + len(q)]
                have = Counter(tuple(win[a:a + k]) for a in range(len(win) - k + 1))
                sim = sum((want & have).values()) / sum((want | have).values())
                if sim >= threshold and sim > out.get((i, j), 0):
                    out[i, j] = sim
    return out


def test_windows_match_brute_force(spark):
    rng = random.Random(4)
    items = [(j, " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))) for j, n in enumerate((3, 5, 12, 30, 45, 60, 60))]
    items += [(90, None), (91, "")]
    docs = []
    for i in range(60):
        w = [f"v{rng.randint(0, 500)}" for _ in range(rng.randint(0, 120))]
        q = items[i % 7][1].split()
        if i % 3 == 0:
            if i % 2:
                q[rng.randrange(len(q))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = q
        docs.append((i, " \n".join(w)))
    q = items[5][1].split()
    docs += [(300, " ".join(q[20:] + q[:20])), (301, " ".join(["v"] * 9 + q[20:] + q[:20] + ["v"] * 9)), (302, " ".join(q[:30] + ["x"] + q[30:])),
             (303, " ".join(q[5:] + q[:3])), (304, " ".join(q[40:] + q[:40] + q)), (305, " ".join(q[3:58]))]
    docs += [(200, None), (201, ""), (202, items[4][1]), (202, items[4][1]), (None, items[5][1]),
             (203, " ".join(["z"] * 50000 + items[3][1].split()))]
    assert brute_windows([docs[60]], items)[300, 5] == pytest.approx(0.867, abs=1e-3)      # its two parts swapped
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id long, text string, len int, _contaminated_row string")
    bench = spark.createDataFrame([(j, t, 2) for j, t in items], "item_id long, text string, start int")
    rows = simhash_windows.contaminated(df, bench).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert len(rows) == len(got)
    assert got == pytest.approx(brute_windows([d for d in docs if d[0] != 203], items) | {(203, 3): 1.0})
    left = simhash_windows.drop_contaminated(df, bench)
    assert left.count() == len(docs) - sum((i, j) in got for i, t in docs for j in [next((k for (d, k) in got if d == i), -1)])
    assert simhash_windows.contaminated(df.limit(0), bench).count() == 0
    assert simhash_windows.contaminated(df, bench.limit(0)).count() == 0


def test_index_finds_every_fingerprint_within_the_radius(spark):
    masks = spark.range(1).select(simhash_windows._masks().alias("m")).first().m
    assert len(masks) == 697 and max(bin(m).count("1") for m in masks) == 3
    # within 31 differing bits over 8 blocks, some block differs in 3 at most
    assert simhash_windows.RADIUS == 31 and simhash_windows.RADIUS // simhash_windows.BLOCKS <= simhash_windows.BLOCK_RADIUS
