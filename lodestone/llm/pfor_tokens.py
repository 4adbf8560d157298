"""Token-id shards in patched frame-of-reference blocks.

Documents are dealt to shards by ascending id and encoded with the tokenizers
library; every document ends with ``END_ID``. A shard is a run of pages of whole
documents (a page is closed once it holds ``PAGE_IDS`` ids), a page a run of
blocks of ``BLOCK`` ids. A block stores (little-endian):

    minimum u32, ids u16, width u8, exceptions u16,
    ids - minimum packed at ``width`` bits, lowest bit first (exceptions as zero),
    positions u16 and values u32 (id - minimum) of the exceptions

where ``width`` fits the 95th percentile of the block. Pages are rows of a
Parquet table in the shared folder: data, block starts, and for each document
its id, start and length. Spark's writer commits a page once however often its
task is retried, and no task holds more than one page and one document.

Null text counts as empty (the end id alone). Rows with a null id come first;
rows that repeat an id are ordered by text, equal ones each get a row. Texts of any length are
encoded whole; an empty table gives no rows. Only the id and the text are read."""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import TextBytes, map_text, text_slices
from lodestone.llm.unit_cache import UnitCache
from lodestone.session import checkpoint_dir

BLOCK = 1024
PAGE_IDS = 64 * BLOCK
PERCENTILE = 95
END_ID = 1
MAX_UNITS = 1_000_000            # units a worker keeps from task to task: some 100 MB
GROUP = 256                      # units in one text for the library
_HEAD = struct.Struct("<IHBH")
PAGE_SCHEMA = ("shard long, page long, n_ids long, data binary, block_starts array<long>, "
               "doc_ids array<long>, doc_starts array<long>, doc_lengths array<long>")


# --- blocks ------------------------------------------------------------------

def pack_block(ids: np.ndarray) -> bytes:
    """One block of 1 to 65,535 ids."""
    low = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(low)
    rank = -(-PERCENTILE * (len(rest) - 1) // 100)
    width = int(np.partition(rest, rank)[rank]).bit_length()
    out = np.flatnonzero(rest > np.uint32((1 << width) - 1))
    kept = rest.copy()
    kept[out] = 0
    bits = np.unpackbits(kept.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return b"".join([_HEAD.pack(low, len(ids), width, len(out)), packed,
                     out.astype("<u2").tobytes(), rest[out].astype("<u4").tobytes()])


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, n, width, n_out = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), dtype=np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width,
                                    bitorder="little").reshape(n, width)
    rest = np.packbits(bits, bitorder="little").view("<u4").astype(np.uint32)
    where = np.frombuffer(data, "<u2", n_out, at + size)
    rest[where] = np.frombuffer(data, "<u4", n_out, at + size + 2 * n_out)
    return rest + np.uint32(low)


def pack_page(ids: np.ndarray) -> tuple[bytes, list[int]]:
    blocks = [pack_block(ids[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    return b"".join(blocks), (np.cumsum(sizes) - sizes).tolist()


def read_range(data: bytes, block_starts: list[int], start: int, length: int) -> np.ndarray:
    """Ids start to start + length of a page; only the blocks that hold them are unpacked."""
    if length == 0:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, (start + length - 1) // BLOCK
    ids = np.concatenate([unpack_block(data, block_starts[b]) for b in range(first, last + 1)])
    return ids[start - first * BLOCK:start - first * BLOCK + length]


# --- encoding ----------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER, _MARK = 1, 3            # kinds of bytes: their sum is 4 at an edge of the two only
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = _MARK             # not the apostrophe: it starts contractions
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC3, 0xC4, 0xC5]] = True                                     # of U+00C0 to U+017F
_NO_LETTER = (0xC397, 0xC3B7, 0xC4B0)                                # times, divide; I with dot: not one letter in lower case


@lru_cache(maxsize=2)
def load(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class UnitEncoder:
    """Ids of texts by the library, which sees each distinct unit once. A unit is a word, also
    cut between a letter (ASCII, U+00C0 to U+017F) and an ASCII mark, where this tokenizer's
    pre-tokenizer always splits, and in lower case (ASCII), as its normaliser makes it. Units
    of letters only go to the library ``GROUP`` at a time, a space between. Texts that hold a
    special token's string go to it whole."""

    def __init__(self, path: str):
        self.lib = load(path)
        self.special = [t.content.encode() for t in self.lib.get_added_tokens_decoder().values()]
        vocabulary = self.lib.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)        # tokens that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(self.lib.model.end_of_word_suffix)]] = True
        self.cache = UnitCache(self._units, MAX_UNITS)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, units: list[bytes]) -> list[list[int]]:
        texts = [u.decode() for u in units]
        words, single = [], []
        for i, text in enumerate(texts):
            (words if text.lower().isalpha() else single).append(i)
        out = [[]] * len(texts)
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        for group, ids in zip(groups, self._library([" ".join([texts[i] for i in g]) for g in groups]), strict=True):
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(group):              # each has one end at least: as many, so one each
                single += group
                continue
            at = 0
            for i, to in zip(group, ends.tolist(), strict=True):
                out[i] = ids[at:to]
                at = to
        for i, ids in zip(single, self._library([texts[i] for i in single]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        t = TextBytes(texts)
        whole = t.buf.tobytes()
        special = {i: t.row_bytes(i).decode() for i in range(len(t.n_words)) if any(s in t.row_bytes(i) for s in self.special)} \
            if any(s in whole for s in self.special) else {}
        t.padded[:] = _LOWER[t.padded]               # this tokenizer lower-cases; fewer distinct units
        kind = _KIND[t.buf]
        lead = np.flatnonzero(_LEAD[t.buf])
        if len(lead):
            lead = lead[~np.isin(t.buf[lead] * np.uint16(256) + t.buf[lead + 1], _NO_LETTER)]
            kind[lead] = kind[lead + 1] = _LETTER
        edge = np.zeros(len(t.buf) + 1, dtype=bool)
        edge[1:-1] = kind[:-1] + kind[1:] == _LETTER + _MARK
        edge[t.offsets] = False                      # a row's first byte starts a word anyhow
        begin, end = edge.copy(), edge
        begin[t.starts] = True
        end[t.ends] = True
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
        flat, n = self.cache.ids(t.padded, starts, ends)
        at = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, t.offsets)]
        out = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for i, text in special.items():
            out[i] = np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        return out


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> UnitEncoder:
    """The encoder of this Python worker: its units serve every task the worker runs."""
    return UnitEncoder(path)


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> None:
    """Encode ``docs`` into shards of pages at ``path``, in ascending id order."""
    def run(batches):
        encoder, shard, page = worker_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        held, names, total = [], [], 0

        def close():
            data, starts = pack_page(np.concatenate(held))
            lengths = np.array([len(h) for h in held], dtype=np.int64)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "page": page, "n_ids": total, "data": data, "block_starts": starts,
                "doc_ids": names, "doc_starts": (np.cumsum(lengths) - lengths).tolist(),
                "doc_lengths": lengths.tolist()}], schema=pages)

        for batch in batches:
            for part in text_slices(batch):
                coded = encoder.encode(part.column(1))
                for name, ids in zip(part.column(0).to_pylist(), coded, strict=True):
                    held.append(np.append(ids, np.int32(end_id)))
                    names.append(name)
                    total += len(held[-1])
                    if total >= PAGE_IDS:
                        yield close()
                        held, names, total, page = [], [], 0, page + 1
        if held:
            yield close()

    pages = pa.schema([("shard", pa.int64()), ("page", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary()),
                       ("block_starts", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
                       ("doc_starts", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64()))])
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    map_text(ordered, run, PAGE_SCHEMA).write.option("compression", "none").parquet(path)


def page_starts(pages: DataFrame) -> DataFrame:
    """(shard, page, base): ids before each page. Shards follow each other by number, which
    follows the id order. One total a shard (a task of the writing job) goes through the
    driver; pages are summed within their shard."""
    from pyspark.sql import Window
    totals = pages.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    base, rows = 0, []
    for r in totals:
        rows.append((r.shard, base))
        base += r.n
    bases = pages.sparkSession.createDataFrame(rows, "shard long, shard_base long")
    before = Window.partitionBy("shard").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return (pages.select("shard", "page", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_before"))
            .join(F.broadcast(bases), "shard")
            .select("shard", "page", (F.col("shard_base") + F.col("_before")).alias("base")))


def read_shards(pages: DataFrame) -> DataFrame:
    """doc_id, page_start (in its page), n_tokens, ids_crc32, shard, page, unpacked from the blocks."""
    def run(batches):
        for batch in batches:
            for p in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
                rows = []
                ids = np.concatenate([unpack_block(p["data"], b) for b in p["block_starts"]]).astype("<u4")
                for s, n in zip(p["doc_starts"], p["doc_lengths"], strict=True):
                    rows.append(zlib.crc32(ids[s:s + n].tobytes()))
                k = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p["doc_ids"], pa.int64()), pa.array(p["doc_starts"], pa.int64()),
                     pa.array(p["doc_lengths"], pa.int64()), pa.array(rows, pa.int64()),
                     pa.array([p["shard"]] * k, pa.int64()), pa.array([p["page"]] * k, pa.int64())],
                    ["doc_id", "page_start", "n_tokens", "ids_crc32", "shard", "page"])

    return map_text(pages, run, "doc_id long, page_start long, n_tokens long, ids_crc32 long, shard long, page long")


def token_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  path: str | None = None) -> DataFrame:
    """Write the shards, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_shards(docs, tokenizer_path, path, id_col, text_col)
    pages = spark.read.parquet(path)
    return (read_shards(pages).join(page_starts(pages), ["shard", "page"])
            .select("doc_id", (F.col("base") + F.col("page_start")).alias("start"), "n_tokens", "ids_crc32"))
