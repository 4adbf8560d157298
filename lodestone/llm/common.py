"""Helpers shared by the training-data operators: intermediate tables in the
cluster's shared folder, bounded label samples, and word arrays over the bytes
of an Arrow text column.

Words are maximal runs of bytes outside space and 0x09-0x0D. Null text is read
as empty text everywhere."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestone.session import checkpoint_dir, ship_package
from lodestone.sources.shared import remove

SLICE_BYTES = 2 << 20       # text bytes handled by the numpy kernels at a time


# --- tables ------------------------------------------------------------------

_FOLDERS: list[str] = []            # of the scratch blocks under way, innermost last


@contextmanager
def scratch(spark: SparkSession):
    """Tables stashed inside the block go when it ends; what is kept must be written
    elsewhere before that."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stash/scratch-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    try:
        yield
    finally:
        _FOLDERS.remove(path)
        remove(spark, path)


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it
    back: lineage ends there, and a lost executor costs one file read."""
    spark = df.sparkSession
    folder = _FOLDERS[-1] if _FOLDERS else f"{checkpoint_dir(spark).rstrip('/')}/stash"
    path = f"{folder}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stash_counted(df: DataFrame, tag: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stash``, and aggregates of the rows taken while they are written."""
    seen = Observation()
    out = stash(df.observe(seen, *(c.alias(k) for k, c in metrics.items())), tag)
    return out, seen.get


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def map_text(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package present on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fold(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(buckets)


def held_out(id_col: str, buckets: int, remainder: int) -> Column:
    """True for the rows labels are not learned from (a null id counts as held out)."""
    return F.coalesce(fold(id_col, buckets) == remainder, F.lit(True))


def label_sample(labels: DataFrame, label: str, buckets: int, remainder: int, max_rows: int,
                 id_col: str = "doc_id") -> DataFrame:
    """At most ``max_rows`` labelled ids outside the held-out remainder, the ones
    with the smallest hash of the id (a uniform choice that does not depend on
    partitioning). Columns ``_id``, ``_y``; an id labelled twice takes the larger label."""
    rows = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
            .where(F.col("_id").isNotNull() & F.col("_y").isNotNull()
                   & ~held_out("_id", buckets, remainder))
            .groupBy("_id").agg(F.max("_y").alias("_y")))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)


def training_rows(features: DataFrame, sample: DataFrame, columns: list[str]):
    """(X, y) of the sampled ids as float64 arrays. The sample is bounded by its
    ``max_rows``, so it is broadcast, and so is what comes back. Rows are
    ordered, so the fit does not depend on task order."""
    rows = (features.join(F.broadcast(sample), features["doc_id"] == sample["_id"])
            .select("_id", "_y", *columns).dropDuplicates(["_id"]).toPandas()
            .sort_values("_id"))
    x = rows[columns].to_numpy(dtype=np.float64) if len(rows) else np.zeros((0, len(columns)))
    return x, rows["_y"].to_numpy(dtype=np.float64)


# --- Arrow text --------------------------------------------------------------

def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy row slices of at most ``max_bytes`` of text (one row at least)."""
    if batch.num_rows == 0:
        return
    text = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(np.nan_to_num(
        pa.compute.binary_length(text).to_numpy(zero_copy_only=False).astype(np.float64)))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0.0
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)   # splitmix64 constants
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def span_hash(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, eight bytes a step; spans over 64 bytes by xxh3.
    ``padded`` has eight bytes after the last span."""
    lanes = np.ndarray(shape=(max(1, len(padded) - 7),), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = mix(length.astype(np.uint64) * _GOLD)
    for k in range(8):
        on = np.flatnonzero(length > 8 * k) if k else slice(None)
        if k and len(on) == 0:
            break
        left = np.minimum(length[on] - 8 * k, 8)
        h[on] = mix((h[on] ^ (lanes[starts[on] + 8 * k] & _MASKS[left])) + _GOLD)
    for i in np.flatnonzero(length > 64):
        h[i] = xxhash.xxh3_64_intdigest(padded[starts[i]:ends[i]].tobytes())
    return h


class TextBytes:
    """The bytes of a text column and its words, as flat arrays.

    ``buf`` bytes; ``offsets[i]:offsets[i+1]`` row i; ``starts``/``ends`` the
    words' byte spans; ``first[i]:first[i+1]`` row i's words."""

    def __init__(self, text: pa.Array):
        text = pa.compute.fill_null(text, "").cast(pa.large_string())
        off = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
        data = text.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.offsets = off - off[0]
        n = int(self.offsets[-1])
        self.padded = np.zeros(n + 8, dtype=np.uint8)
        self.padded[:n] = raw[off[0]:off[-1]]
        self.buf = self.padded[:n]
        self.solid = ~_SPACE[self.buf]
        edge = self.offsets[:-1][self.offsets[:-1] < n]
        before = np.zeros(n, dtype=bool)
        before[1:] = self.solid[:-1]
        before[edge] = False
        after = np.zeros(n, dtype=bool)
        after[:-1] = self.solid[1:]
        after[edge[edge > 0] - 1] = False
        self.starts = np.flatnonzero(self.solid & ~before)
        self.ends = np.flatnonzero(self.solid & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.n_words = np.diff(self.first)
        self._hash = None

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array for each row."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def row_bytes(self, i: int) -> bytes:
        return self.buf[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def word_hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(self.padded, self.starts, self.ends)
        return self._hash

    def windows(self, width: int):
        """(row, hash) of every run of ``width`` consecutive words of a row, in order."""
        h = self.word_hash()
        row = np.repeat(np.arange(len(self.n_words)), self.n_words)
        last = len(h) - width + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(row[:last] == row[width - 1:])
        out = h[at]
        for j in range(1, width):
            out = mix(out * _GOLD + h[at + j])
        return row[at], out, at
