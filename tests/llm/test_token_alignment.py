"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestone.llm import token_alignment as T
from lodestone.llm.queries import QUERIES
from lodestone.sources.tables import table

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIB_A, LIB_B = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
LIB_A.encode_special_tokens = True
BYTES = T._byte_of()


def brute_groups(text):
    """[(A ids, B ids)] by the libraries over the whole text."""
    want = (" " + (text or "")).encode()
    if not text:
        return []
    a, b = LIB_A.encode(" " + text, add_special_tokens=False).ids, LIB_B.encode(text)
    a_bytes = [bytes(BYTES[c] for c in LIB_A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(LIB_B.id_to_piece(i)[3:5], 16)]) if LIB_B.is_byte(i) else LIB_B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return []
    ends_a, ends_b = (list(accumulate(map(len, x))) for x in (a_bytes, b_bytes))
    cuts = sorted(set(ends_a) & set(ends_b))
    out, low = [], 0
    for c in cuts:
        out.append(([i for i, e in zip(a, ends_a, strict=True) if low < e <= c], [i for i, e in zip(b, ends_b, strict=True) if low < e <= c]))
        low = c
    return out


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(rows):
    each = [(i, brute_groups(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in each]
    count = Counter(p for c in links for p in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (i, g), c in zip(each, links, strict=True):
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(written(g).encode()).hexdigest() if g else ""))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


PARTS = [" ", "  ", "   ", "a", "B", "\n", "\n\n", "\t", "\r\n", ".", ",", "'s", "'", "the", "é", "漢字", "😀", "▁", "\x00", "\x01", "<s>", "0", "19",
         "　", "́", "ﬁ", "\x85", "\xa0", "_", "…", "<|endoftext|>", "!!", "ing", "can't", "I'll", " 's", "x'y", "\x1c", "­", " "]


def check(texts):
    known = T.Units(T.load(A, B))
    totals, text, at, codes, links = T.align_texts(known, pa.array(texts, pa.large_string()))
    for k, t in enumerate(texts):
        g = brute_groups(t)
        assert text[k].decode() == written(g), repr(t)
        c = Counter((x, y) for a, b in g for x in a for y in b)
        assert [x[k] for x in totals] == [sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values())]
        mine = slice(at[k], at[k + 1])
        assert {divmod(p, known.pair.base): n for p, n in zip(codes[mine].tolist(), links[mine].tolist(), strict=True)} == c


def test_units_equal_the_libraries():
    rng = random.Random(7)
    check(["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(6000)] + ["", " ", "a" * 3000, "the" * 500])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text_equals_the_libraries(texts):
    check(texts)


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    monkeypatch.setattr(T, "LISTED", 1)
    rng = random.Random(8)
    check(["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1000)])


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(T, "MAX_UNITS", 3)
    known = T.Units(T.load(A, B))
    for t in ("some words here", "other words there", "some words here"):
        _, text, *_ = T.align_texts(known, pa.array([t]))
        assert text[0].decode() == written(brute_groups(t))


ODD = [(None, "no id"), (None, None), (3, None), (2, ""), (9, "  "), (5, "a " * 1500 + "end"), (5, "again"), (5, "again"),
       (6, "é漢😀\x00<s> <|endoftext|>\r\n\tit's"), (7, "has ▁ inside"), (-1, "again"), (10 ** 12, "again and again")]


@pytest.mark.parametrize("frequent,hot_part", [(1 << 18, 1000), (5, 4), (0, 10 ** 9)])
def test_odd_rows(spark, frequent, hot_part):
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in ODD], "doc_id long, text string, key string, copies int")
    assert got(T.alignments(df, A, B, frequent=frequent, hot_part=hot_part)) == brute(ODD)
    assert T.alignments(df.limit(0), A, B).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert got(QUERIES["op11_cross_tokenizer_alignment"](spark, SF)) == brute(rows)
