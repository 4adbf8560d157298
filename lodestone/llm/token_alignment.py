"""Alignment of two tokenizers' tokens, over exact-text deduplication.

Tokenizer A (byte-level BPE, tokenizers library) encodes a space and the text, B
(sentencepiece, which adds that space) the text; special tokens' strings are plain
text. Byte offsets where tokens of both end cut them into groups; every A token
and B token of a group are linked. An id pair's count is the number of documents
that hold it linked.

1. Rows are shuffled by their full text and counted (combined before the
   shuffle, so copies cost nothing), and each distinct text is encoded and aligned once.
2. Its distinct pairs, weighted by its copies, are summed over the corpus; a pair
   is best when no pair of its A id has a larger count.
3. The ``FREQUENT`` pairs with the largest counts go to every task, which
   scores them in place; only links with other pairs are joined by shuffle.
4. Measures return to the rows by a digest (SHA-256) of the text. Texts that more
   than one row in ``HOT_PART`` has (so fewer than ``HOT_PART``) are broadcast, all others joined by shuffle.

A text is cut into units where both tokenizers must cut (white space behind a
visible ASCII character, letters beside digits or marks, and so on, and no piece of B
holds both sides); each new unit is encoded by the libraries and aligned, and a
worker keeps ``MAX_UNITS`` units. Alignment works on the tokens of about ``TEXT_BYTES`` of text
at once. Links of a group with more than ``LISTED`` are counted by distinct ids.

Null and empty texts, and texts whose joined token bytes of A or B are not the
space and the text (such as texts with U+2581), have no tokens: zeros, and an
empty groups_sha256. Each row gives a row, also repeated ones and those with a null
id; every row counts as a document. Texts of any length are read whole; an
empty table gives no rows. Only the id and the text are read."""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.llm.common import TextBytes, map_text, span_hash, stash, stash_counted, text_slices

FREQUENT = 1 << 18                # pairs sent to every task: 4 MB
HOT_PART = 1000
MAX_UNITS, MAX_IDS = 200_000, 2_000_000              # kept per worker, some 50 MB
ADD = 4096                        # units given to the libraries at a time
LISTED = 4096                     # links of a group listed one by one
TEXT_BYTES = 1 << 19              # text aligned at a time
MARK = "▁"
LEAD = "\x01"                     # stands in front of a unit given to B, never part of a piece


# --- the two vocabularies ----------------------------------------------------

def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(0x100 + k)] = b
    return out


class Tokens:
    """Byte strings by id, in one array."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        before = np.cumsum(n) - n
        return self.pool[np.repeat(self.start[ids] - before, n) + np.arange(int(n.sum()))]


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_of()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        a_bytes = [bytes(byte_of[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        n = self.b.get_piece_size()
        b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                   else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.tokens = Tokens(a_bytes), Tokens(b_bytes)
        self.digits = Tokens([str(i).encode() for i in range(max(len(a_bytes), n))])
        self.base = n                                        # a pair's code: A id * base + B id
        self.lead = self.b.encode(LEAD)
        # pairs of ASCII characters (128: any other) that some piece of B holds side by side
        joined = np.zeros((129, 129), dtype=bool)
        joined[128, 128] = True
        for i in range(n):
            if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)):
                c = [min(ord(x), 128) for x in self.b.id_to_piece(i).replace(MARK, " ")]
                joined[c[:-1], c[1:]] = True
        if joined[1].any() or joined[:, 1].any():
            raise ValueError("a piece holds the lead character")
        # cuts that A makes whatever stands around: 0 other, 1 blank, 2 other ASCII white space, 3 letter, 4 digit, 5 mark
        kind = np.zeros(129, dtype=np.int8)
        kind[0x20] = 1
        kind[[9, 10, 11, 12, 13]] = 2
        for c in range(0x21, 0x7F):
            kind[c] = 3 if chr(c).isalpha() else 4 if chr(c).isdigit() else 5
        kind[0x27] = 6                                       # the apostrophe may begin a contraction
        self.kind = kind
        x, y = kind[:, None], kind[None, :]
        visible = (x >= 3)
        self.cut = ((visible & ((y == 1) | (y == 2)))                                  # white space behind a visible character
                    | ((x == 2) & (y == 1))                                            # see ``cuts``: only before a visible one
                    | ((x >= 3) & (x <= 5) & (y >= 3) & (y <= 5) & (x != y))) & ~joined
        self.after = ((x == 2) & (y >= 3)) & ~joined                                   # behind one white-space character

    def cuts(self, padded: np.ndarray, n: int) -> np.ndarray:
        """Flags: a unit begins at this byte."""
        c = np.minimum(padded[:n], 128)
        out = np.zeros(n + 1, dtype=bool)
        if n < 2:
            return out
        kind = self.kind[c]
        cut = self.cut[c[:-1], c[1:]]
        # a blank behind other white space begins a token only when a visible character follows it
        blank = (kind[:-1] == 2) & (kind[1:] == 1)
        follows = np.zeros(n - 1, dtype=bool)
        follows[:-1] = kind[2:] >= 3
        cut &= ~blank | follows
        # a single white-space character between visible ones is a token of its own
        single = np.zeros(n - 1, dtype=bool)
        single[1:] = kind[:-2] >= 3
        out[1:n] = cut | (self.after[c[:-1], c[1:]] & single)
        return out

    def encode(self, units: list[str]):
        """(A ids, B ids) of each unit."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        k = len(self.lead)
        b = [ids[k:] if ids[:k] == self.lead else [] for ids in self.b.encode([LEAD + u for u in units], num_threads=1)]
        return a, b


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


class Units:
    """Both tokenizers' ids of text units, kept by a 64-bit hash of their bytes; ``good``: both
    join to the unit's bytes."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self._reset()

    def _reset(self):
        self.slot: dict[int, int] = {}
        self.good = np.zeros(1024, dtype=bool)
        self.start, self.size = np.zeros((2, 1024), np.int64), np.zeros((2, 1024), np.int64)
        self.pool, self.used = [np.zeros(4096, np.int32), np.zeros(4096, np.int32)], [0, 0]

    def _add(self, hashes: list[int], units: list[bytes]) -> None:
        n, have = len(units), len(self.slot)
        while have + n > len(self.good):
            self.good = np.concatenate([self.good, np.zeros_like(self.good)])
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)], axis=1) for x in (self.start, self.size))
        good = np.ones(n, dtype=bool)
        whole = np.frombuffer(b"".join(units), dtype=np.uint8)
        length = np.fromiter(map(len, units), np.int64, n)
        for k, coded in enumerate(self.pair.encode([u.decode() for u in units])):
            size = np.fromiter(map(len, coded), np.int64, n)
            flat = np.fromiter((i for ids in coded for i in ids), np.int32, int(size.sum()))
            tokens = self.pair.tokens[k]
            joined = tokens.bytes_of(flat)
            if len(joined) != len(whole) or (joined != whole).any():       # some unit's bytes are others
                total = np.concatenate(([0], np.cumsum(tokens.size[flat])))[np.concatenate(([0], np.cumsum(size)))]
                for i in range(n):
                    good[i] &= joined[total[i]:total[i + 1]].tobytes() == units[i]
            while self.used[k] + len(flat) > len(self.pool[k]):
                self.pool[k] = np.concatenate([self.pool[k], np.zeros_like(self.pool[k])])
            self.pool[k][self.used[k]:self.used[k] + len(flat)] = flat
            self.size[k, have:have + n] = size
            self.start[k, have:have + n] = self.used[k] + np.cumsum(size) - size
            self.used[k] += len(flat)
        self.good[have:have + n] = good & (length > 0)
        self.slot.update(zip(hashes, range(have, have + n), strict=True))

    def slots(self, padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each unit."""
        if len(self.slot) > MAX_UNITS or max(self.used) > MAX_IDS:
            self._reset()
        uniq, at, inverse = np.unique(span_hash(padded, starts, ends), return_index=True, return_inverse=True)
        names = uniq.tolist()
        slots = np.fromiter((self.slot.get(h, -1) for h in names), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        for lo in range(0, len(new), ADD):
            some = new[lo:lo + ADD]
            have = len(self.slot)
            self._add([names[i] for i in some], [padded[starts[i]:ends[i]].tobytes() for i in at[some]])
            slots[some] = np.arange(have, have + len(some))
        return slots[inverse]

    def ids(self, k: int, slots: np.ndarray):
        """(ids of the units in order, ids per unit) of tokenizer ``k``."""
        n = self.size[k][slots]
        before = np.cumsum(n) - n
        return self.pool[k][np.repeat(self.start[k][slots] - before, n) + np.arange(int(n.sum()))], n


@lru_cache(maxsize=1)
def units(a_path: str, b_path: str) -> Units:
    """The units of this worker, kept from task to task."""
    return Units(load(a_path, b_path))


class Groups:
    """Groups of A and B tokens that cover the same bytes: ``of[k]`` the group of each token,
    ``count[k]`` the tokens of each group."""

    def __init__(self, a_size: np.ndarray, b_size: np.ndarray):
        ends = np.cumsum(a_size), np.cumsum(b_size)
        total = int(ends[0][-1]) if len(a_size) else 0
        self.of, self.count = [], []
        for mine, others in (ends, ends[::-1]):
            ended = np.zeros(total + 1, dtype=bool)
            ended[others] = True
            cut = ended[mine]
            self.of.append(np.cumsum(cut) - cut)
            self.n = int(cut.sum())
        for of in self.of:
            self.count.append(np.bincount(of, minlength=self.n))

    def links(self, a: np.ndarray, b: np.ndarray, base: int):
        """(group, code, links) of every linked pair; a group with many tokens by distinct ids."""
        size = self.count[0] * self.count[1]
        large = size > LISTED
        on = ~large[self.of[0]]
        many = self.count[1][self.of[0][on]]                       # B tokens that each A token meets
        first = (np.cumsum(self.count[1]) - self.count[1])[self.of[0][on]]
        before = np.cumsum(many) - many
        other = b[np.repeat(first - before, many) + np.arange(int(many.sum()))]
        group = [np.repeat(self.of[0][on], many)]
        code = [np.repeat(a[on].astype(np.int64) * base, many) + other]
        times = [np.ones(len(other), np.int64)]
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(a[slice(*np.searchsorted(self.of[0], (g, g + 1)))], return_counts=True)
            y, ny = np.unique(b[slice(*np.searchsorted(self.of[1], (g, g + 1)))], return_counts=True)
            code.append((x.astype(np.int64)[:, None] * base + y).ravel())
            times.append((nx[:, None] * ny).ravel())
            group.append(np.full(len(x) * len(y), g))
        return np.concatenate(group), np.concatenate(code), np.concatenate(times)

    def written(self, a: np.ndarray, b: np.ndarray, digits: Tokens):
        """(bytes of ``a1,a2|b1;a3|b2;``..., end of each group in them)."""
        n = len(a) + len(b)
        upto = [np.cumsum(c) for c in self.count]
        place = (np.arange(len(a)) + (upto[1] - self.count[1])[self.of[0]], np.arange(len(b)) + upto[0][self.of[1]])
        ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[place[0]], ids[place[1]] = a, b
        last = upto[0] + upto[1]                                   # tokens up to each group's end
        sign[last - 1] = ord(";")
        sign[last - self.count[1] - 1] = ord("|")
        size = digits.size[ids] + 1
        end = np.cumsum(size)
        out = np.empty(int(end[-1]) if n else 0, np.uint8)
        number = np.ones(len(out), dtype=bool)
        number[end - 1] = False
        out[number] = digits.bytes_of(ids)
        out[end - 1] = sign
        return out.tobytes(), end[last - 1]


def align_texts(known: Units, texts: pa.Array):
    """Per row: A tokens, B tokens, groups, links (arrays), groups as bytes; and the rows' distinct
    pairs: offsets by row, codes, links."""
    n, pair = len(texts), known.pair
    t = TextBytes(pa.array([" " + x if x else "" for x in texts.to_pylist()], pa.large_string()))
    size = len(t.buf)
    cut = pair.cuts(t.padded, size)
    cut[t.offsets] = True
    cut[size] = True
    edge = np.flatnonzero(cut)
    starts, ends = edge[:-1], edge[1:]
    slots = known.slots(t.padded, starts, ends) if len(starts) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, t.offsets)))
    good = np.bincount(row, ~known.good[slots], n) == 0
    slots, row = slots[good[row]], row[good[row]]
    (a, na), (b, nb) = known.ids(0, slots), known.ids(1, slots)
    groups = Groups(pair.tokens[0].size[a], pair.tokens[1].size[b])
    row_of = np.zeros(groups.n, np.int64)
    row_of[groups.of[0]] = np.repeat(row, na)
    totals = [np.bincount(row, na, n), np.bincount(row, nb, n), np.bincount(row_of, minlength=n),
              np.bincount(row_of, groups.count[0] * groups.count[1], n)]
    data, end = groups.written(a, b, pair.digits)
    at = np.concatenate(([0], end))[np.searchsorted(row_of, np.arange(n + 1))].tolist()
    text = [data[x:max(x, y - 1)] for x, y in zip(at[:-1], at[1:], strict=True)]
    group, code, times = groups.links(a, b, pair.base)
    top = pair.base * len(pair.tokens[0].size)
    key = row_of[group] * top + code
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    if len(key):
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, times = key[new], np.add.reduceat(times, new)
    return [x.astype(np.int64) for x in totals], text, np.searchsorted(key, np.arange(n + 1) * top), key % top, times


# --- Spark -------------------------------------------------------------------

def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int64()))


def aligned_texts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Distinct ``text`` with ``copies`` -> key, copies, n_a, n_b, n_groups, n_links, groups (as
    text ``a1,a2|b1;a3|b2``, as its SHA-256), codes and links of its distinct pairs."""
    def run(batches):
        known = units(a_path, b_path)
        for batch in batches:
            for part in text_slices(batch, max_bytes=TEXT_BYTES):
                totals, text, at, codes, links = align_texts(known, part.column(2))
                sha = [hashlib.sha256(g).hexdigest() if g else "" for g in text]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in totals), pa.array(sha, pa.string()),
                     _lists(at, codes), _lists(at, links)],
                    ["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links"])

    return map_text(texts.select("key", "copies", "text"), run,
                    "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                    "codes array<long>, links array<long>")


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """code, n (documents that hold the pair linked), best (no pair of its A id has more)."""
    counts = (aligned.select("copies", F.explode("codes").alias("code"))
              .groupBy("code").agg(F.sum("copies").alias("n")))
    # an A id meets at most as many B ids as there are
    of_a = Window.partitionBy(F.expr(f"code div {base}"))
    return counts.select("code", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def _scored(aligned: DataFrame, table: DataFrame, frequent: int) -> DataFrame:
    """key, n_best, count_sum of every distinct text."""
    top = table.orderBy(F.desc("n"), "code").limit(frequent).toPandas().sort_values("code")
    shared = aligned.sparkSession.sparkContext.broadcast(
        (top["code"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def run(batches):
        code, n, best = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            codes = lists.values.to_numpy()[at[0]:at[-1]]
            links = batch.column(2).values.to_numpy()[at[0]:at[-1]]
            at = at - at[0]
            rows = batch.num_rows
            row = np.repeat(np.arange(rows), np.diff(at))
            place = np.minimum(np.searchsorted(code, codes), max(len(code) - 1, 0))
            hit = code[place] == codes if len(code) else np.zeros(len(codes), bool)
            on = place[hit]
            n_best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(n_best, row[hit], links[hit] * best[on])
            np.add.at(total, row[hit], links[hit] * n[on])
            rest = np.searchsorted(row[~hit], np.arange(rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(total), _lists(rest, codes[~hit]), _lists(rest, links[~hit])],
                ["key", "n_best", "count_sum", "codes", "links"])

    near = stash(map_text(aligned.select("key", "codes", "links"), run,
                          "key binary, n_best long, count_sum long, codes array<long>, links array<long>"), "links")
    far = (near.where("size(codes) > 0").select("key", F.explode(F.arrays_zip("codes", "links")).alias("p"))
           .select("key", F.col("p.codes").alias("code"), F.col("p.links").alias("links"))
           .join(table.hint("merge"), "code")
           .select("key", F.expr("if(best, links, 0L)").alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum")))
    return (near.select("key", "n_best", "count_sum").unionByName(far)
            .groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
               frequent: int = FREQUENT, hot_part: int = HOT_PART) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    base = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    keys, seen = stash_counted(rows.select("doc_id", key.alias("key")), "keys", n=F.count(F.lit(1)))
    distinct = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select(key.alias("key"), "copies", "text")
    aligned = stash(aligned_texts(distinct, a_path, b_path), "aligned")
    table = stash(pair_counts(aligned, base), "pairs")
    own = aligned.select("key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    measures = stash(own.join(_scored(aligned, table, frequent).hint("merge"), "key"), "measures")
    hot = measures.where(F.col("copies") * hot_part > seen["n"]).drop("copies")          # fewer than ``hot_part``
    with_hot = keys.join(F.broadcast(hot), "key")
    others = (keys.join(F.broadcast(hot.select("key")), "key", "left_anti")
              .join(measures.drop("copies").hint("merge"), "key"))
    return with_hot.unionByName(others).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
