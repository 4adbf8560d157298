"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut into units where no piece of the vocabulary holds the two
adjacent characters, so that no merge can cross; each unit is encoded by an
agenda: adjacent symbol pairs in a heap ordered by piece score, then position;
the best is merged and its neighbours enter. Symbols outside the vocabulary
become byte pieces. Every unit a worker meets for the first time is also encoded by the
library, and so are one short document a batch as a whole; a difference fails the job.
Decoding joins the pieces' bytes; ids that form no text (stray byte pieces, the
unknown id) are left to the library.

Null text counts as empty (begin and end ids only). Only the id and the text are
read, so extra columns are ignored; repeated rows are each encoded, in any order of equal
ids. Texts of any length are read whole, a slice of rows at a time; an empty
table gives no rows."""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import map_text, text_slices
from lodestone.llm.unit_cache import UnitCache

CHECK_DOC_BYTES = 20_000         # a whole document is compared when it is no longer than this
MARK = "▁"                  # the library's sign for a space
LEAD = "\x01"                     # put before a unit for the library, part of no piece


class Vocabulary:
    """Pieces, scores and byte pieces of a BPE model with a dummy prefix and identity normaliser."""

    def __init__(self, path: str):
        self.lib = p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = p.bos_id(), p.eos_id()
        n = p.get_piece_size()
        self.byte_id = [-1] * 256
        self.ids, self.score = {}, {}
        self.text = [b""] * n
        for i in range(n):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b] = i
                self.text[i] = bytes([b])
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                plain = piece.replace(MARK, " ")
                self.ids[plain], self.score[plain] = i, p.get_score(i)
                self.text[i] = plain.encode()
        if min(self.byte_id) < 0 or p.normalize("ﬁ á  b") != MARK + f"ﬁ{MARK}á{MARK}{MARK}b":
            raise ValueError("only BPE models with byte pieces, a dummy prefix and no normalisation are supported")
        joined = np.zeros((129, 129), dtype=bool)      # classes of adjacent bytes within some piece; 128: not ASCII
        joined[128, 128] = True
        for piece in self.ids:
            c = [min(ord(x), 128) for x in piece]
            joined[c[:-1], c[1:]] = True
        joined[:, 0x20] &= np.arange(129) == 0x20      # a piece with an inner space would be seen here
        if any(" " in piece.lstrip(" ") for piece in self.ids):
            raise ValueError("pieces that span a space are not supported")
        if joined[1].any() or joined[:, 1].any():
            raise ValueError("a piece holds the lead character")
        self.lead = p.encode(LEAD)
        self.joined = joined
        self.lens = np.array([len(t) for t in self.text])
        self.pool = np.frombuffer(b"".join(self.text), dtype=np.uint8)
        self.at = np.cumsum(self.lens) - self.lens

    def encode_unit(self, unit: bytes) -> list[int]:
        """Ids of one unit by the agenda."""
        sym = list(unit.decode())
        n = len(sym)
        score = self.score
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            s = score.get(sym[i] + sym[i + 1])
            if s is not None:
                agenda.append((-s, i, i + 1, sym[i] + sym[i + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, merged = heapq.heappop(agenda)
            # stale when either side has changed since the pair was entered
            if sym[i] is None or right[i] != j or sym[j] is None or sym[i] + sym[j] != merged:
                continue
            sym[i], sym[j] = merged, None
            k = right[j]
            right[i] = k
            if k >= 0:
                left[k] = i
                pair = merged + sym[k]
                if pair in score:
                    heapq.heappush(agenda, (-score[pair], i, k, pair))
            k = left[i]
            if k >= 0:
                pair = sym[k] + merged
                if pair in score:
                    heapq.heappush(agenda, (-score[pair], k, i, pair))
        out = []
        for s in sym:
            if s is not None:
                i = self.ids.get(s)
                out += [i] if i is not None else [self.byte_id[b] for b in s.encode()]
        return out

    def encode_units(self, units: list[bytes]) -> list[list[int]]:
        coded = [self.encode_unit(u) for u in units]
        k = len(self.lead)
        checked = self.lib.encode([LEAD + u.decode() for u in units])
        for unit, mine, want in zip(units, coded, checked, strict=True):
            if want[:k] != self.lead or mine != want[k:]:
                raise ValueError(f"unit {unit!r}: {mine} differs from the library's {want[k:]}")
        return coded

    def cache(self) -> UnitCache:
        return UnitCache(self.encode_units)


def normalised(texts: pa.Array):
    """(padded bytes, offsets): every text that is not empty gets a space in front."""
    raw = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts.to_pylist()]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
    return np.frombuffer(b"".join([*raw, bytes(8)]), dtype=np.uint8), offsets


def units(vocabulary: Vocabulary, padded: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first unit of each row)."""
    n = int(offsets[-1])
    kind = np.minimum(padded[:n], 128)
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = ~vocabulary.joined[kind[:-1], kind[1:]]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    return starts, ends, np.searchsorted(starts, offsets)


def encode_rows(vocabulary: Vocabulary, cache: UnitCache, texts: pa.Array):
    """(all ids with begin and end ids, row offsets into them)."""
    padded, offsets = normalised(texts)
    starts, ends, first = units(vocabulary, padded, offsets)
    flat, per_unit = cache.ids(padded, starts, ends)
    cut = np.concatenate(([0], np.cumsum(per_unit)))[first]
    rows = len(offsets) - 1
    out = np.empty(len(flat) + 2 * rows, dtype=np.int32)
    at = cut + 2 * np.arange(rows + 1)
    body = np.ones(len(out), dtype=bool)
    body[at[:-1]] = False
    body[at[1:] - 1] = False
    out[body] = flat
    out[at[:-1]], out[at[1:] - 1] = vocabulary.bos, vocabulary.eos
    return out, at


def decode_rows(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Bytes of each row: pieces joined, control pieces empty, the space in front removed."""
    n = vocabulary.lens[ids]
    before = np.cumsum(n) - n
    total = int(n.sum())
    data = vocabulary.pool[np.repeat(vocabulary.at[ids] - before, n) + np.arange(total)].tobytes()
    cut = np.concatenate((before, [total]))[at].tolist()
    out = []
    for i in range(len(at) - 1):
        row = data[cut[i]:cut[i + 1]]
        out.append(row[1:] if row[:1] == b" " else row)
    return out


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def worker_cache(path: str) -> UnitCache:
    """The units of this Python worker, kept from task to task."""
    return load(path).cache()


def decoded(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """Text of each row, as the library decodes it."""
    out = []
    # pieces without bytes part a run of byte pieces, but for a begin and an end id at the ends
    parted = np.concatenate(([0], np.cumsum(vocabulary.lens[ids] == 0)))
    first, last = at[:-1], at[1:]
    ends = np.zeros(len(first), np.int64)
    some = last > first
    ends[some] += ids[first[some]] == vocabulary.bos
    some = last > first + 1
    ends[some] += ids[last[some] - 1] == vocabulary.eos
    special = parted[last] - parted[first] > ends
    for i, raw in enumerate(decode_rows(vocabulary, ids, at)):
        try:
            text = None if special[i] else raw.decode()
        except UnicodeDecodeError:
            text = None
        out.append(vocabulary.lib.decode(ids[at[i]:at[i + 1]].tolist()) if text is None else text)
    return out


def _coded(docs: DataFrame, model_path: str, schema: str, columns, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        vocabulary, cache = load(model_path), worker_cache(model_path)
        for batch in batches:
            checked = False
            for part in text_slices(batch):
                ids, at = encode_rows(vocabulary, cache, part.column(1))
                if not checked:
                    checked = True
                    for i, text in enumerate(part.column(1).slice(0, 1).to_pylist()):
                        if len(text or "") <= CHECK_DOC_BYTES:
                            want = vocabulary.lib.encode(text or "", add_bos=True, add_eos=True)
                            if ids[at[i]:at[i + 1]].tolist() != want:
                                raise ValueError("a document's ids differ from the library's")
                yield pa.RecordBatch.from_arrays([part.column(0), *columns(vocabulary, part, ids, at)],
                                                 names=[x.split()[0] for x in schema.split(", ")])

    return map_text(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                    run, schema)


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit), decoded_sha256."""
    def columns(vocabulary, part, ids, at):
        raw = ids.astype("<u4").tobytes()
        texts = decode_rows(vocabulary, ids, at)
        sha = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return [pa.array(np.diff(at)), pa.array(sha), pa.array([hashlib.sha256(t).hexdigest() for t in texts])]

    return _coded(docs, model_path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                  columns, id_col, text_col)


def encode_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids."""
    def columns(vocabulary, part, ids, at):
        return [pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))]

    return _coded(docs, model_path, "doc_id long, n_tokens long, ids array<int>", columns, id_col, text_col)


def decode_ids(rows: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of rows with doc_id and ids (null ids count as none)."""
    def run(batches):
        vocabulary = load(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [x or [] for x in part.column(1).to_pylist()]
                cut = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
                flat = np.array([i for x in lists for i in x], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(decoded(vocabulary, flat, cut), pa.string())], ["doc_id", "text"])

    return map_text(rows.select("doc_id", "ids"), run, "doc_id long, text string")
