"""Arrow-batched vector kernels: the fast path for dense-vector math.

Spark's array higher-order functions (``transform``, ``aggregate``,
``zip_with``) are interpreted per element, about a microsecond per step. For
k medoids x d dimensions per row that dominates a pass, so the same formulas
run here on whole Arrow batches: the list column's flat value buffer is
viewed as an (n, d) matrix and multiplied with the k x d medoid matrix.
Spark still partitions, schedules and retries the work; only the arithmetic
inside a task is numpy. ``lodestone.functions.vectors`` holds the pure-SQL
twins of every kernel (``engine="sql"``), used as test oracles.

Small constant matrices (medoids, cluster sums) ride in the UDF closure when
under CLOSURE_CELLS doubles; larger ones go out once per executor as a
broadcast variable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.session import ship_package

CLOSURE_CELLS = 65_536
CHUNK_ROWS = 4096
PRODUCT_ROWS = 128               # every matrix product has this many rows, see ``products``
MEDOID_BLOCK = 512               # medoids compared at a time: a slice's temporaries are CHUNK_ROWS x MEDOID_BLOCK
DIST_DECIMALS = 12


def to_matrix(arr, dim: int | None = None) -> np.ndarray:
    """(n, d) float64 view of a list<float|double> Arrow array; rows must be
    non-null and of one length (``dim`` when given)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, dim or 0))
    if arr.null_count:
        raise ValueError("null vector")
    lengths = np.diff(np.asarray(arr.offsets))
    d = int(lengths[0]) if dim is None else dim
    if np.any(lengths != d):
        bad = int(lengths[lengths != d][0])
        raise ValueError(f"vector length must be {d}, got {bad}")
    flat = np.asarray(arr.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if not np.isfinite(flat).all():
        raise ValueError("vector with a null, NaN or infinite component")
    return flat.reshape(n, d)


def _slices(n: int):
    """Row ranges of at most CHUNK_ROWS: float64 temporaries stay bounded
    (CHUNK_ROWS x dim x 8 bytes) whatever the Arrow batch size."""
    for lo in range(0, n, CHUNK_ROWS):
        yield lo, min(CHUNK_ROWS, n - lo)


def _batch_slices(batches):
    """Non-empty zero-copy slices of at most CHUNK_ROWS rows of each batch."""
    for whole in batches:
        for lo, ln in _slices(whole.num_rows):
            yield whole.slice(lo, ln)


def _per_slice(fn, *arrays) -> pa.Array:
    """Apply ``fn`` to zero-copy slices of equally long Arrow arrays and
    concatenate the Arrow results."""
    n = len(arrays[0])
    if n <= CHUNK_ROWS:
        return fn(*arrays)
    parts = [fn(*(a.slice(lo, ln) for a in arrays)) for lo, ln in _slices(n)]
    return pa.concat_arrays(parts)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in float64; zero rows stay zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    safe = np.where(norms > 0, norms, 1.0)
    return np.where(norms[:, None] > 0, m / safe[:, None], 0.0)


def from_matrix(m: np.ndarray) -> pa.Array:
    n, d = m.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * d)
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), type=pa.float64()))


def _ship(matrix: np.ndarray, spark):
    """Closure value, or a broadcast variable for big matrices."""
    ship_package(spark)
    if matrix.size <= CLOSURE_CELLS:
        return lambda: matrix
    bc = spark.sparkContext.broadcast(matrix)
    return lambda: bc.value


def unit_vectors(vec, dim: int | None = None) -> Column:
    """Kernel twin of ``vectors.unit``: u/|u|, zero stays zero."""
    ship_package()
    @F.arrow_udf("array<double>")
    def _unit(v: pa.Array) -> pa.Array:
        return _per_slice(lambda x: from_matrix(unit_rows(to_matrix(x, dim))), v)
    return _unit(F.col(vec) if isinstance(vec, str) else vec)


def _round(x: np.ndarray, decimals: int) -> np.ndarray:
    return np.round(x, decimals) + 0.0          # + 0.0 turns -0.0 into 0.0


def products(um: np.ndarray, mm: np.ndarray) -> np.ndarray:
    """um @ mm.T in products of one shape (the last one padded with zero rows): a row's result
    then has the same bits whatever rows come with it, so distances do not depend on partitioning."""
    out = np.empty((len(um), len(mm)))
    for lo in range(0, len(um), PRODUCT_ROWS):
        part = um[lo:lo + PRODUCT_ROWS]
        n = len(part)
        if n < PRODUCT_ROWS:
            part = np.concatenate([part, np.zeros((PRODUCT_ROWS - n, um.shape[1]))])
        out[lo:lo + n] = (part @ mm.T)[:n]
    return out


class Blocks:
    """k medoid vectors in blocks of like direction, for an exact nearest search that skips
    blocks: with c a block's middle and r the largest angle from it to a member, no member is
    nearer to u in angle than angle(u, c) - r.

    Vectors come in the order that breaks ties (smallest id first)."""

    def __init__(self, mm: np.ndarray, size: int | None = None):
        self.mm, self.size = mm, size or MEDOID_BLOCK
        k = len(mm)
        if k <= self.size:
            self.members, self.middle = [np.arange(k)], None
            return
        # greedy middles far apart, members dealt to the nearest, then cut to size; zero vectors,
        # at distance 1 from everything, keep to themselves
        solid = np.einsum("ij,ij->i", mm, mm) > 0
        count = -(-k // self.size)
        middles, near = [], np.where(solid, -2.0, np.inf)
        while len(middles) < count and np.isfinite(near).any():
            middles.append(int(np.argmin(near)))
            near = np.maximum(near, products(mm, mm[middles[-1:]])[:, 0])
        to = np.where(solid, np.argmax(products(mm, mm[middles]), axis=1) if middles else 0, count)
        self.members = [m[lo:lo + self.size] for g in range(count + 1) for m in [np.flatnonzero(to == g)]
                        for lo in range(0, len(m), self.size)]
        self.middle = unit_rows(np.array([mm[m].mean(axis=0) for m in self.members]))
        self.reach = np.array([np.arccos(np.clip(mm[m] @ c, -1, 1)).max() for m, c in zip(self.members, self.middle, strict=True)])
        self.zero = np.array([not solid[m[0]] for m in self.members])

    def nearest(self, um: np.ndarray, counted: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest medoid, rounded distance) of each row; ``counted`` gets the
        number of products made."""
        n = len(um)
        best, at = np.full(n, np.inf), np.full(n, len(self.mm))

        def compare(b: int, rows: np.ndarray) -> None:
            members = self.members[b]
            if counted is not None:
                counted.append(-(-len(rows) // PRODUCT_ROWS) * PRODUCT_ROWS * len(members))
            key = _round(1.0 - products(um[rows], self.mm[members]), DIST_DECIMALS)
            j = np.argmin(key, axis=1)
            dist, index = key[np.arange(len(rows)), j], members[j]
            better = (dist < best[rows]) | ((dist == best[rows]) & (index < at[rows]))
            best[rows[better]], at[rows[better]] = dist[better], index[better]

        if self.middle is None:
            compare(0, np.arange(n))
            return at, best
        angle = np.arccos(np.clip(products(um, self.middle), -1, 1))
        floor = 1 - np.cos(np.maximum(angle - self.reach, 0)) - 1e-9         # no member is nearer
        floor[:, self.zero] = 1 - 1e-9
        floor[np.einsum("ij,ij->i", um, um) == 0] = -1
        likely = np.argmin(angle, axis=1)                # its block first, so that others can be skipped
        for b in np.unique(likely).tolist():
            compare(b, np.flatnonzero(likely == b))
        for b in range(len(self.members)):
            rows = np.flatnonzero((floor[:, b] <= best) & (likely != b))
            if len(rows):
                compare(b, rows)
        return at, best


def nearest_medoid(u, medoids: list[tuple[int, int, list[float]]], spark,
                   skip_null: bool = False) -> Column:
    """Kernel twin of ``kmedoids.nearest``: struct(dist, mid, label) of the
    medoid nearest to vector ``u`` (normalised here), ties to the smaller
    medoid id."""
    ordered = sorted(medoids, key=lambda m: m[1])
    mids = np.array([m[1] for m in ordered], dtype=np.int64)
    labels = np.array([m[0] for m in ordered], dtype=np.int64)
    get = _ship(np.array([m[2] for m in ordered], dtype=np.float64), spark)

    @F.arrow_udf("struct<dist:double,mid:bigint,label:bigint>")
    def _nearest(v: pa.Array) -> pa.Array:
        mm = get()
        blocks = Blocks(mm)

        def one(x):
            if skip_null and x.null_count:
                valid = np.asarray(x.is_valid())
                place = np.cumsum(valid) - 1
                got = one(x.filter(pa.array(valid)))
                return got.take(pa.array(place, mask=~valid))
            um = unit_rows(to_matrix(x, mm.shape[1]))
            idx, dist = blocks.nearest(um)          # ties: smallest medoid id
            return pa.StructArray.from_arrays(
                [pa.array(dist, type=pa.float64()),
                 pa.array(mids[idx], type=pa.int64()), pa.array(labels[idx], type=pa.int64())],
                names=["dist", "mid", "label"])
        return _per_slice(one, v)
    return _nearest(F.col(u) if isinstance(u, str) else u)


def _row_lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    pos = np.searchsorted(keys[order], wanted)
    pos = np.minimum(pos, len(keys) - 1)
    found = keys[order][pos] == wanted
    if not np.all(found):
        raise ValueError(f"unknown cluster label {wanted[~found][0]}")
    return order[pos]


def distance_to_label(u, label, medoids: list[tuple[int, int, list[float]]], spark) -> Column:
    """Kernel twin of ``kmedoids.distance_to``: 1 - u . medoid(label)."""
    labels = np.array([m[0] for m in medoids], dtype=np.int64)
    get = _ship(np.array([m[2] for m in medoids], dtype=np.float64), spark)

    @F.arrow_udf("double")
    def _dist(v: pa.Array, lab: pa.Array) -> pa.Array:
        mm = get()

        def one(x, lb):
            um = unit_rows(to_matrix(x, mm.shape[1]))
            rows = mm[_row_lookup(labels, np.asarray(lb.to_numpy(zero_copy_only=False), np.int64))]
            return pa.array(_round(1.0 - (um * rows).sum(axis=1), DIST_DECIMALS), type=pa.float64())
        return _per_slice(one, v, lab)
    return _dist(F.col(u) if isinstance(u, str) else u,
                 (F.col(label) if isinstance(label, str) else label).cast("long"))


# --- fused partial aggregates (map side of the medoid update) -----------------
#
# The update needs, per cluster, |K| and S_K = sum of u, then per point
# s = |K| - u . S_K and the min (s, id). Rather than emit one row per point
# and aggregate in the JVM, each task reduces its Arrow batches in numpy to one
# row per cluster; k rows a task cross the shuffle. The cluster of a row is its
# ``label`` column, or its nearest medoid when ``medoids`` is given.
#
# Sums are exact: components are whole multiples of 2**-FIXED_BITS, held as two
# 64-bit integers (high part, low 32 bits), and distances are decimals, so the
# result has the same bits in any order of rows, batches and tasks.

FIXED_BITS = 50                  # |u| <= 1, CHUNK_ROWS = 2**12: a slice's sum fits 63 bits
LOW_BITS = 32
HELD_CELLS = 2_000_000           # a task's accumulators go out when they hold more cells
SUMS_SCHEMA = "label bigint, n bigint, hi array<bigint>, lo array<bigint>, dist decimal(38,12)"
TOTAL_SCHEMA = "label bigint, n bigint, S array<double>, dist decimal(38,12)"
BEST_SCHEMA = "label bigint, s double, id bigint, u array<double>"
SUM_DECIMALS = 9
_LOW = (1 << LOW_BITS) - 1
_DIST = pa.decimal128(38, DIST_DECIMALS)


def _labels_of(batch: pa.RecordBatch, um: np.ndarray, med) -> tuple[np.ndarray, np.ndarray | None]:
    """(label per row, distance to that label's medoid)."""
    if med is None:
        return np.asarray(batch.column("label").to_numpy(zero_copy_only=False), dtype=np.int64), None
    blocks, labels = med
    idx, dist = blocks.nearest(um)
    return labels[idx], dist


def _groups(lab: np.ndarray):
    order = np.argsort(lab, kind="stable")
    sl = lab[order]
    uniq, starts = np.unique(sl, return_index=True)
    return order, uniq, starts


def _medoid_arrays(medoids, spark):
    ship_package(spark)
    if medoids is None:
        return None
    ordered = sorted(medoids, key=lambda m: m[1])
    get = _ship(np.array([m[2] for m in ordered], dtype=np.float64), spark)
    return get, np.array([m[0] for m in ordered], dtype=np.int64)


def _decimal(units: int):
    from decimal import Decimal
    return Decimal(units).scaleb(-DIST_DECIMALS)


class _Sums:
    """Exact sums by label: rows, components (high, low), distance in units of 10**-12."""

    def __init__(self):
        self.of: dict[int, list] = {}
        self.cells = 0

    def add(self, label: int, n: int, hi: np.ndarray, lo: np.ndarray, units: int) -> None:
        have = self.of.get(label)
        if have is None:
            self.of[label] = [n, hi.copy(), lo.copy(), units]
            self.cells += 2 * len(hi)
            return
        have[0] += n
        have[1] += hi
        have[2] += lo
        have[1] += have[2] >> LOW_BITS               # the low part stays below 2**32
        have[2] &= _LOW
        have[3] += units

    def batch(self) -> pa.RecordBatch:
        rows = [(label, *x) for label, x in sorted(self.of.items())]
        self.__init__()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64())),
             pa.array([_decimal(r[4]) for r in rows], _DIST)], names=["label", "n", "hi", "lo", "dist"])


def cluster_partial_sums(points, medoids=None, dim: int | None = None):
    """``(label, n, hi, lo, dist)`` partial rows: per task and cluster the member
    count, the sum of unit vectors in fixed point and (with ``medoids``) the sum of
    distances to the nearest medoid. Input columns: ``v`` (normalised here)
    [, ``label``]."""
    spark = points.sparkSession
    med = _medoid_arrays(medoids, spark)
    cols = ["v"] if medoids is not None else ["v", "label"]

    def run(batches):
        m, sums = None if med is None else (Blocks(med[0]()), med[1]), _Sums()
        for batch in _batch_slices(batches):
            um = unit_rows(to_matrix(batch.column("v"), m[0].mm.shape[1] if m is not None else dim))
            lab, dist = _labels_of(batch, um, m)
            order, uniq, starts = _groups(lab)
            fixed = np.rint(um[order] * 2.0 ** FIXED_BITS).astype(np.int64)
            total = np.add.reduceat(fixed, starts, axis=0)
            units = [0] * len(uniq) if dist is None else \
                np.add.reduceat(np.rint(dist[order] * 10.0 ** DIST_DECIMALS).astype(np.int64), starts).tolist()
            counts = np.diff(np.append(starts, len(order))).tolist()
            for i, label in enumerate(uniq.tolist()):
                sums.add(label, counts[i], total[i] >> LOW_BITS, total[i] & _LOW, units[i])
            if sums.cells > HELD_CELLS:
                yield sums.batch()
        yield sums.batch()
    return points.select(*cols).mapInArrow(run, SUMS_SCHEMA)


def cluster_totals(parts):
    """``(label, n, S, dist)``: the partial sums of each cluster added up, streamed by label."""
    def run(batches):
        sums, now, out = _Sums(), None, []

        def total():
            n, hi, lo, units = sums.of[now]
            sums.__init__()
            return now, n, (hi * 2.0 ** LOW_BITS + lo) * 2.0 ** -FIXED_BITS, _decimal(units)

        for batch in batches:
            for r in range(batch.num_rows):
                label, n = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                if now is not None and label != now:
                    out.append(total())
                now = label
                sums.add(label, n, *(batch.column(c)[r].values.to_numpy() for c in (2, 3)),
                         int(batch.column(4)[r].as_py().scaleb(DIST_DECIMALS)))
            if out:
                yield totals(out)
                out = []
        if now is not None:
            yield totals([total()])

    def totals(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.float64())), pa.array([r[3] for r in rows], _DIST)],
            names=["label", "n", "S", "dist"])

    return parts.repartition("label").sortWithinPartitions("label").mapInArrow(run, TOTAL_SCHEMA)


def cluster_partial_best(points, sums: list[tuple[int, int, list[float]]], medoids=None):
    """``(label, s, id, u)`` partial rows: per task and cluster the member
    with the least s = |K| - u . S_K (s at SUM_DECIMALS places, then smaller
    id), with its unit vector. Input columns: ``id``, ``v`` (normalised here)
    [, ``label``]."""
    spark = points.sparkSession
    med = _medoid_arrays(medoids, spark)
    s_labels = np.array([s[0] for s in sums], dtype=np.int64)
    s_counts = np.array([s[1] for s in sums], dtype=np.float64)
    get_s = _ship(np.array([s[2] for s in sums], dtype=np.float64), spark)
    cols = ["id", "v"] if medoids is not None else ["id", "v", "label"]

    def run(batches):
        m = None if med is None else (Blocks(med[0]()), med[1])
        sm, best, cells = get_s(), {}, 0

        def held():
            rows = sorted(best.items())
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()), pa.array([x[0] for _, x in rows], pa.float64()),
                 pa.array([x[1] for _, x in rows], pa.int64()), pa.array([x[2] for _, x in rows], pa.list_(pa.float64()))],
                names=["label", "s", "id", "u"])

        for batch in _batch_slices(batches):
            um = unit_rows(to_matrix(batch.column("v"), sm.shape[1]))
            ids = np.asarray(batch.column("id").to_numpy(zero_copy_only=False), dtype=np.int64)
            lab, _ = _labels_of(batch, um, m)
            row = _row_lookup(s_labels, lab)
            # summed row by row: the same bits whatever rows come with it
            s = _round(s_counts[row] - (um * sm[row]).sum(axis=1), SUM_DECIMALS)
            order = np.lexsort((ids, s, lab))            # by label, then s, then id
            sl = lab[order]
            first = order[np.concatenate(([True], sl[1:] != sl[:-1]))]
            for i in first.tolist():
                mine = (float(s[i]), int(ids[i]))
                have = best.get(int(lab[i]))
                if have is None:
                    cells += um.shape[1]
                if have is None or mine < have[:2]:
                    best[int(lab[i])] = (*mine, um[i].copy())
            if cells > HELD_CELLS:
                yield held()
                best, cells = {}, 0
        yield held()
    return points.select(*cols).mapInArrow(run, BEST_SCHEMA)
