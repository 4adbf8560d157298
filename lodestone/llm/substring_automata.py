"""Removal of repeated passages by suffix automata of reference shards.

A passage is a run of ``WIDTH`` words (windows) that also starts in a document
with a smaller id; every word in such a window goes. Suffix automata over words
give each document's matching statistics against the documents before it: at
every word the length of the longest match that ends there (counted up to
``WIDTH``) and the smallest document that holds it. Maximal runs of words in
matches of ``WIDTH`` words or more are the spans removed.

Reference shards. Every window has an anchor: the smallest hash among its
``GRAM``-word shingles, so equal windows have equal anchors and neighbours mostly
share one. A shard is the set of runs of windows with one anchor.
1. Anchors are counted by shuffle; those that one row alone holds are done.
2. The runs under the others are sent to their anchor's shard in ascending
   document order. The shard's automaton is walked with each run, then grows by
   what was new in it, so it holds distinct text only.
3. Spans return to their documents, which are cut.

Hot passages. Windows that more than one row in 100 holds (found in a keyed
sample of one row in ``SAMPLE``, at most ``HOT``) never enter that shuffle: one
aggregate over all rows gives each window's first document, their automaton is
broadcast (``HOT`` x ``WIDTH`` words at most), and documents stream past it where they are.
Anchors as frequent whose windows are not are refined to the window's own hash.
The sample only chooses the way; either way is exact.

Words are runs of anything but space and 0x09-0x0D, kept unchanged. Null text
has no words. A null id counts as the largest number: such rows lose what any
other document has and remove nothing. Rows with one id never remove each other's
words; repeated rows each give a row. Texts of any length are read whole; an
empty table gives no rows. Only the id and the text are read."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import SLICE_BYTES, TextBytes, map_text, text_slices

WIDTH, GRAM = 13, 5
RUN = 32                          # windows of a run at most
SAMPLE, HOT, HOT_SHARE, HOT_ROWS = 64, 8192, 0.01, 8
LAST = 2 ** 63 - 1                # stands for a null id
_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


# --- automaton ---------------------------------------------------------------

class Automaton:
    """Suffix automaton of several word sequences, added in ascending order of document.
    ``first[v]``: the smallest document that holds the words of state v."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [LAST]

    def _state(self, following: dict, link: int, length: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of p's longest words followed by ``word``, taken out of q."""
        half = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = half
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = half
            p = self.link[p]
        return half

    def _step(self, last: int, word, doc: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state({}, 0, self.length[last] + 1, doc)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def add(self, words: list, doc: int) -> None:
        last = 0
        for w in words:
            last = self._step(last, w, doc)

    def windows(self, words: list, below: int, width: int) -> list[int]:
        """Starts of the ``width``-word windows that a document before ``below`` holds."""
        following, link, length, first = self.next, self.link, self.length, self.first
        out, v, n = [], 0, 0
        for i, w in enumerate(words):
            t = following[v].get(w)
            while t is None and v:
                v = link[v]
                n = length[v]
                t = following[v].get(w)
            if t is None:
                n = 0
                continue
            v, n = t, n + 1
            if n >= width:
                n = width
                while length[link[v]] >= width:     # the state of just the last ``width`` words
                    v = link[v]
                if first[v] < below:
                    out.append(i - width + 1)
        return out


def spans(starts: list[int], width: int) -> list[tuple[int, int]]:
    """Maximal word spans covered by windows that start at ``starts`` (ascending)."""
    out = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + width)
        else:
            out.append((s, s + width))
    return out


# --- windows and anchors -----------------------------------------------------

class Windows:
    """The windows of a text column: ``row``, ``at`` (index of the first word among all words),
    ``hash`` and ``value`` (the anchor; the window's own hash for a hot anchor)."""

    def __init__(self, t: TextBytes, width: int, gram: int, hot_anchors: np.ndarray):
        self.row, self.hash, self.at = t.windows(width)
        self.row_start = t.first
        _, h, at = t.windows(gram)
        reach, low = 1, h
        span = width - gram + 1
        while reach < span:                          # sliding minimum in doubling steps
            shift = min(reach, span - reach)
            low = np.minimum(low[:-shift], low[shift:]) if len(low) > shift else low[:0]
            reach += shift
        self.value = low[np.searchsorted(at, self.at)] if len(self.at) else np.zeros(0, np.uint64)
        if len(hot_anchors) and len(self.value):
            refined = np.isin(self.value, hot_anchors)
            self.value = np.where(refined, self.hash, self.value)

    def runs(self, on: np.ndarray):
        """(first window, windows) of the runs of windows in ``on`` with one row and one value."""
        n = len(self.row)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (self.value[1:] != self.value[:-1]) | (on[1:] != on[:-1])
        begin = np.flatnonzero(new)
        place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
        begin = np.flatnonzero(place % RUN == 0)
        size = np.diff(np.append(begin, n))
        kept = on[begin]
        return begin[kept], size[kept]


def words_of(raw: bytes) -> list[bytes]:
    return [w for w in raw.translate(_SPACES).split(b" ") if w]


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _texts(batches, column: str, *others: str):
    """Slices of unpacked texts of about SLICE_BYTES: (TextBytes, list of each other column)."""
    unpack = zstandard.ZstdDecompressor().decompress

    def ready():
        return TextBytes(pa.array([t.decode() for t in texts], pa.large_string())), *rest

    texts, rest, held = [], [[] for _ in others], 0
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in (column, *others)]
        for i in range(batch.num_rows):
            texts.append(unpack(columns[0][i].as_py()))
            for kept, c in zip(rest, columns[1:], strict=True):
                kept.append(c[i].as_py())
            held += len(texts[-1])
            if held >= SLICE_BYTES:
                yield ready()
                texts, rest, held = [], [[] for _ in others], 0
    if texts:
        yield ready()


# --- steps -------------------------------------------------------------------

def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rk")))


def _frequent(rows: DataFrame, width: int, gram: int, sample: int, least: int):
    """(window hashes, anchors) that a keyed sample holds often; at most HOT each."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                t = TextBytes(part.column(part.schema.get_field_index("text")))
                w = Windows(t, width, gram, np.zeros(0, np.uint64))
                kinds, hashes = [np.full(part.num_rows, 2, np.int32)], [np.zeros(part.num_rows, np.uint64)]
                for kind, h in enumerate((w.hash, w.value)):
                    order = np.lexsort((h, w.row))
                    h, row = h[order], w.row[order]
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    hashes.append(h[new])
                    kinds.append(np.full(int(new.sum()), kind, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds)), _signed(np.concatenate(hashes))], ["kind", "h"])

    seen = map_text(rows.where(F.pmod("rk", F.lit(sample)) == 0).select("text"), run, "kind int, h long")
    counts = seen.groupBy("kind", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    top = counts.orderBy(F.desc("n"), "kind", "h").limit(2 * HOT + 1).collect()
    total = max([r.n for r in top if r.kind == 2], default=0)
    found = [[r.h for r in top if r.kind == kind and r.n >= HOT_SHARE * total][:HOT] for kind in (0, 1)]
    return tuple(np.sort(np.array(f, dtype=np.int64).view(np.uint64)) for f in found)


def _hot_automaton(rows: DataFrame, hot: np.ndarray, width: int, gram: int) -> Automaton:
    """The automaton of the hot windows with the first document of each, over all rows."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                t = TextBytes(part.column(part.schema.get_field_index("text")))
                row, h, at = t.windows(width)
                on = np.flatnonzero(np.isin(h, hot))
                if len(on) == 0:
                    continue
                ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                firsts: dict[bytes, int] = {}
                for r in np.unique(row[on]).tolist():
                    doc = LAST if ids[r] is None else ids[r]
                    words = words_of(t.row_bytes(r))
                    for s in (at[on[row[on] == r]] - t.first[r]).tolist():
                        key = b" ".join(words[s:s + width])
                        if doc < firsts.get(key, LAST):
                            firsts[key] = doc
                yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in firsts], pa.string()),
                                                  pa.array(list(firsts.values()), pa.int64())], ["window", "first"])

    found = (map_text(rows.select("doc_id", "text"), run, "window string, first long")
             .groupBy("window").agg(F.min("first").alias("first")).collect())
    automaton = Automaton()
    for r in sorted(found, key=lambda r: (r.first, r.window)):
        automaton.add(r.window.encode().split(b" "), r.first)
    return automaton


def _shared(rows: DataFrame, hot: np.ndarray, hot_anchors: np.ndarray, width: int, gram: int) -> DataFrame:
    """(rk, value): the anchors of each row that another row holds too, hot windows aside."""
    def anchors(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                t = TextBytes(part.column(part.schema.get_field_index("text")))
                w = Windows(t, width, gram, hot_anchors)
                begin, _ = w.runs(~np.isin(w.hash, hot))
                rk = part.column(part.schema.get_field_index("rk")).to_numpy()[w.row[begin]]
                value = w.value[begin].view(np.int64)
                order = np.lexsort((value, rk))
                rk, value = rk[order], value[order]
                new = np.ones(len(rk), dtype=bool)
                new[1:] = (rk[1:] != rk[:-1]) | (value[1:] != value[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(value[new]), pa.array(rk[new])], ["value", "rk"])

    def several(batches):
        """Rows come by value, then rk: a value is shared when its first and last rk differ."""
        value, rk, known = np.zeros(0, np.int64), np.zeros(0, np.int64), None      # the open value's rows, or that it is shared
        for batch in batches:
            value = np.concatenate((value, batch.column(0).to_numpy()))
            rk = np.concatenate((rk, batch.column(1).to_numpy()))
            if len(value) == 0:
                continue
            begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            end = np.append(begin[1:], len(value))
            many = rk[begin] != rk[end - 1]
            if known is not None:
                many |= value[begin] == known
            known = int(value[-1]) if many[-1] else None
            out = np.repeat(many, end - begin)
            yield pa.RecordBatch.from_arrays([pa.array(rk[out]), pa.array(value[out])], ["rk", "value"])
            held = 0 if many[-1] else 1              # rows of one value and one rk are alike
            value, rk = value[len(value) - held:], rk[len(rk) - held:]

    found = map_text(rows.select("text", "rk"), anchors, "value long, rk long")
    return map_text(found.repartition("value").sortWithinPartitions("value", "rk"), several, "rk long not null, value long not null")


def _runs(packed: DataFrame, shared: DataFrame, hot: np.ndarray, hot_anchors: np.ndarray, width: int, gram: int) -> DataFrame:
    """(shard, doc, rk, start, words) of every run under a shared anchor."""
    def run(batches):
        for t, ids, keys, lists in _texts(batches, "z", "doc_id", "rk", "values"):
            w = Windows(t, width, gram, hot_anchors)
            begin, size = w.runs(~np.isin(w.hash, hot))
            row, value = w.row[begin], w.value[begin].view(np.int64)
            edge = np.searchsorted(row, np.arange(len(ids) + 1))
            out = [[], [], [], [], []]
            for r in range(len(ids)):
                mine = slice(edge[r], edge[r + 1])
                on = np.flatnonzero(np.isin(value[mine], np.array(lists[r], dtype=np.int64))) + edge[r]
                if len(on) == 0:
                    continue
                words = words_of(t.row_bytes(r))
                start = w.at[begin[on]] - t.first[r]
                out[0] += value[on].tolist()
                out[1] += [LAST if ids[r] is None else ids[r]] * len(on)
                out[2] += [keys[r]] * len(on)
                out[3] += start.tolist()
                out[4] += [b" ".join(words[a:b]).decode() for a, b in
                           zip(start.tolist(), (start + size[on] + width - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.int32()),
                                              pa.array(out[4], pa.string())], ["shard", "doc", "rk", "start", "words"])

    lists = shared.groupBy("rk").agg(F.collect_set("value").alias("values"))
    return map_text(packed.join(lists.hint("merge"), "rk").select("rk", "doc_id", "z", "values"), run,
                    "shard long, doc long, rk long, start int, words string")


def _covered(runs: DataFrame, width: int) -> DataFrame:
    """(rk, start, end): spans of words that an earlier document holds, shard by shard."""
    def run(batches):
        shard, doc, automaton, pending = None, None, None, {}
        for batch in batches:
            out = [[], [], []]
            for s, d, rk, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    shard, doc, automaton, pending = s, d, Automaton(), {}
                elif d != doc:
                    for words in pending.values():
                        automaton.add(words, doc)
                    doc, pending = d, {}
                words = text.split(" ")
                found = automaton.windows(words, d, width)
                for a, b in spans(found, width):
                    out[0].append(rk)
                    out[1].append(start + a)
                    out[2].append(start + b)
                if len(found) < len(words) - width + 1 and text not in pending and d < LAST:
                    have = set(found)
                    new = [i for i in range(len(words) - width + 1) if i not in have]
                    pending[text] = words[new[0]:new[-1] + width]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.int32())], ["rk", "start", "end"])

    ordered = runs.repartition("shard").sortWithinPartitions("shard", "doc")
    return map_text(ordered, run, "rk long not null, start int, end int")


def _kept(packed: DataFrame, covered: DataFrame, hot: np.ndarray, automaton, width: int, emit, schema: str) -> DataFrame:
    """``emit(ids, rows of (words, kept flags))`` over the rows with their covered words taken out."""
    def run(batches):
        known = automaton.value if automaton is not None else None
        for t, ids, found in _texts(batches, "z", "doc_id", "found"):
            extra: dict[int, np.ndarray] = {}
            if known is not None:
                row, h, at = t.windows(width)
                on = np.flatnonzero(np.isin(h, hot))
                for r in np.unique(row[on]).tolist():
                    extra[r] = at[on[row[on] == r]] - t.first[r]
            rows = []
            for r, doc in enumerate(ids):
                words = words_of(t.row_bytes(r))
                left = np.ones(len(words), dtype=bool)
                for s in found[r] or ():
                    left[s["start"]:s["end"]] = False
                if r in extra:
                    for a, b in spans(extra[r].tolist(), width):            # stretches of hot windows
                        for s, e in spans(known.windows(words[a:b], LAST if doc is None else doc, width), width):
                            left[a + s:a + e] = False
                rows.append((words, left))
            yield emit(ids, rows)

    lists = covered.groupBy("rk").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    return map_text(packed.join(lists.hint("merge"), "rk", "left").select("doc_id", "z", "found"), run, schema)


def _pack(rows: DataFrame) -> DataFrame:
    """(rk, doc_id, z): texts compressed, so that the shuffle by row key stays small."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([pack(t.encode()) for t in part.column(2).to_pylist()], pa.binary())],
                    ["rk", "doc_id", "z"])

    return map_text(rows.select("rk", "doc_id", "text"), run, "rk long not null, doc_id long, z binary")


def _deduplicate(docs: DataFrame, emit, schema: str, id_col: str, text_col: str, width: int, sample: int, least: int) -> DataFrame:
    gram = min(GRAM, width)
    rows = _rows(docs, id_col, text_col)
    hot, hot_anchors = _frequent(rows, width, gram, sample, least)
    automaton = docs.sparkSession.sparkContext.broadcast(_hot_automaton(rows, hot, width, gram)) if len(hot) else None
    packed = _pack(rows)
    runs = _runs(packed, _shared(rows, hot, hot_anchors, width, gram), hot, hot_anchors, width, gram)
    return _kept(packed, _covered(runs, width), hot, automaton, width, emit, schema)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    sample: int = SAMPLE, least: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""
    def emit(ids, rows):
        kept = [b" ".join([w for w, on in zip(words, left.tolist(), strict=True) if on]) for words, left in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(x) for _, x in rows], pa.int64()),
             pa.array([int(len(x) - x.sum()) for _, x in rows], pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _deduplicate(docs, emit, "doc_id long, n_words long, n_removed long, kept_sha256 string",
                        id_col, text_col, width, sample, least)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   sample: int = SAMPLE, least: int = HOT_ROWS) -> DataFrame:
    """doc_id, text (kept words joined by one space), removed (spans of word positions: start, end)."""
    def emit(ids, rows):
        kept, cuts = [], []
        for words, left in rows:
            kept.append(b" ".join([w for w, on in zip(words, left.tolist(), strict=True) if on]).decode())
            edge = np.flatnonzero(np.diff(np.concatenate(([1], left.astype(np.int8), [1]))))
            cuts.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(kept, pa.string()),
             pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["doc_id", "text", "removed"])

    return _deduplicate(docs, emit, "doc_id long, text string, removed array<struct<start:int,end:int>>",
                        id_col, text_col, width, sample, least)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rk, doc_id, w, unnest(range(len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
win AS (SELECT rk, doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS k FROM s),
firsts AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (SELECT DISTINCT rk, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (k) WHERE first < doc_id),
words AS (SELECT rk, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (SELECT rk, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (rk, p) GROUP BY rk),
n AS (SELECT rk, count(*) AS n FROM gone GROUP BY rk)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rk) LEFT JOIN n USING (rk)
"""
