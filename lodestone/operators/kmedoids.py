"""Cosine k-medoids (D1-D10) on DataFrames.

Points are ``(id, v)``, v normalised where it is used. Medoids, k rows,
travel to the tasks as one constant array, so the nearest-medoid search is a
per-row expression: no cross join, no shuffle. The medoid update uses

    sum_{j in K} (1 - u_c . u_j) = |K| - u_c . S_K,   S_K = sum_{j in K} u_j

(one aggregate per cluster, then one dot product per point and a min per
cluster) instead of all pairs within a cluster: O(n d), exact, skew-proof
because every step is a map-side-combined aggregate or a broadcast of k rows.

Variants (the reference's four programs plus its single-machine one):

=================  ==============  =================  ===================  ======================
variant            start           re-assigned/pass   medoid chosen from   cost reported
=================  ==============  =================  ===================  ======================
base               k md5-random    all                whole cluster        new medoids, old assignment
improved           k md5-random    all                whole cluster        same; stop on rel. gain
local              k md5-random    all                whole cluster        all points to nearest new medoid
sampling           random bucket   md5 20 % sample    md5 20 % sample      stored distances
smart_sampling     id mod k        worst 20 %/cluster nearest 30 %/cluster stored distances
=================  ==============  =================  ===================  ======================
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import vector_kernels as K
from lodestone.functions.sampling import hash_fraction, hash_key
from lodestone.functions.vectors import dot, double_array_literal, unit
from lodestone.operators.ranks import percent_rank_filter, percent_rank_flag
from lodestone.sources.shared import Bucketed, children, remove, shared_path

# "arrow": vector math in Arrow-batched numpy kernels (fast); "sql": the same
# formulas as Spark array higher-order functions (pure JVM, interpreted).
ENGINE = "arrow"
# Medoid rows are shipped to every task (closure or broadcast on the kernel
# path, a plan literal on the SQL path); k * dim doubles must stay below this.
MAX_MEDOID_CELLS = 16_000_000
# Decimal places of a distance before it is compared (ties then go to the smaller id).
DIST_DECIMALS = 12
SUM_DECIMALS = 9
# Buckets of a sampling variant's tables: state rows a task hashes (some 60 bytes each), rows
# worth a task of their own while there are cores for them, and the most buckets.
BUCKET_ROWS, SMALL_BUCKET, MAX_BUCKETS = 1_000_000, 5_000, 50_000


@dataclass
class KMedoidsResult:
    assignments: DataFrame   # (id, label, medoid_id, dist)
    medoids: DataFrame       # (label, medoid_id)
    trace: DataFrame         # (iteration, cost)
    iterations: int
    cost: float
    seconds: float = 0.0
    cached: DataFrame | None = None
    converged: bool = True   # the variant's own test ended the loop, not max_iter
    tables: list = field(default_factory=list)     # of the run, in the shared folder

    def report(self) -> DataFrame:
        """K4: the reference's four-line run report (time, iterations, cost
        per pass, final cost) as a one-column DataFrame; write it with
        ``sources.files.write_lines``."""
        costs = ",".join(repr(r.cost) for r in self.trace.orderBy("iteration").collect())
        # The wording of the report's lines.
        lines = [f"Time: {int(self.seconds)} seconds", f"Iterations: {self.iterations}", costs,
                 f"Final cost: {self.cost!r}"]
        # four lines: one partition, so the text sink writes them as one ordered file
        return self.trace.sparkSession.createDataFrame([(x,) for x in lines],
                                                       "value string").coalesce(1)

    def unpersist(self) -> None:
        """Release what the run holds once the assignments are written: the cached points
        (``cache=True``) and a sampling variant's tables in the shared folder."""
        if self.cached is not None:
            self.cached.unpersist()
        while self.tables:
            self.tables.pop().remove()


# --- points and medoids ------------------------------------------------------
#
# Points are ``(id, v)`` with ``v`` the vector as stored (float or double).
# Every consumer normalises it on the fly (the kernels per Arrow batch in
# float64, the SQL path with ``unit``), so no double-width copy of the data
# is ever materialised, cached or checkpointed. Medoids are k tuples
# ``(label, medoid id, unit vector)``.

def _unit(vec, dim: int | None, engine: str | None) -> Column:
    return K.unit_vectors(vec, dim) if (engine or ENGINE) == "arrow" else unit(vec, dim)


def _dim(medoids) -> int | None:
    return len(medoids[0][2]) if medoids else None


def prepare_points(df: DataFrame, id_col: str, vec_col: str, keep: tuple[str, ...] = ()
                   ) -> DataFrame:
    """``(id bigint, v, *keep)``: the id and the vector as stored (only the
    needed columns reach the scan); ``keep`` carries other columns along."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), *keep)


def pick_medoids(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """K rows ordered by md5(id:seed), then id. A bounded top-k
    (per-task k rows, one merge)."""
    return points.orderBy(hash_key("id", seed), "id").limit(k)


def _collect_medoids(rows) -> list[tuple[int, int, list[float]]]:
    """rows with (label, mid, vec) -> checked list."""
    out = [(int(r[0]), int(r[1]), list(r[2])) for r in rows]
    if out:
        _check_cells(len(out), len(out[0][2]))
    return out


def _check_cells(k: int, dim: int) -> None:
    if k * dim > MAX_MEDOID_CELLS:
        raise ValueError(f"{k} medoids x {dim} dims exceed {MAX_MEDOID_CELLS} cells")


def medoid_rows(rows_df: DataFrame, engine: str | None = None, label_col: str | None = None
                ) -> list[tuple[int, int, list[float]]]:
    """k rows ``(id, v[, label])`` -> medoid tuples with unit vectors (the
    normalisation runs in Spark, by the same engine as the passes). The
    label is the id unless ``label_col`` is given."""
    lab = F.col(label_col) if label_col else F.col("id")
    rows = rows_df.select(lab.alias("label"), "id", _unit("v", None, engine).alias("u")).collect()
    return _collect_medoids(sorted((r.label, r.id, r.u) for r in rows))


def medoid_literal(medoids: list[tuple[int, int, list[float]]]) -> Column:
    """k medoids as a constant ``array<struct<label, mid, vec>>``."""
    return F.array(*[F.struct(F.lit(label).cast("long").alias("label"),
                              F.lit(mid).cast("long").alias("mid"),
                              double_array_literal(vec).alias("vec"))
                     for label, mid, vec in medoids])


def nearest(u, medoids: Column) -> Column:
    """D2/W1 (SQL form): struct(dist, mid, label) of the nearest medoid to the
    unit vector ``u``; ties go to the smaller medoid id (distances compared at
    DIST_DECIMALS places)."""
    u = F.col(u) if isinstance(u, str) else u
    # u reaches the lambda as a repeated argument, so it is computed once per row
    def score(m, uu):
        return F.struct(F.round(F.lit(1.0) - dot(uu, m["vec"]), DIST_DECIMALS).alias("dist"),
                        m["mid"].alias("mid"), m["label"].alias("label"))
    return F.array_min(F.zip_with(medoids, F.array_repeat(u, F.size(medoids)), score))


def distance_to(u, label, medoids: Column) -> Column:
    """D4 (SQL form): distance from unit vector u to the medoid of ``label``."""
    u = F.col(u) if isinstance(u, str) else u
    label = F.col(label) if isinstance(label, str) else label
    vec = F.element_at(F.map_from_arrays(F.transform(medoids, lambda m: m["label"]),
                                         F.transform(medoids, lambda m: m["vec"])), label)
    return F.round(F.lit(1.0) - dot(u, vec), DIST_DECIMALS)


def _nearest(v, medoids, spark, engine: str | None, where: Column | None = None) -> Column:
    """With ``where``, null for the rows that fail it; their vectors never reach the kernel."""
    if (engine or ENGINE) == "arrow":
        v = F.col(v) if isinstance(v, str) else v
        return K.nearest_medoid(v if where is None else F.when(where, v), medoids, spark, where is not None)
    return nearest(unit(v, _dim(medoids)), medoid_literal(medoids))


def _distance_to(v, label, medoids, spark, engine: str | None) -> Column:
    if (engine or ENGINE) == "arrow":
        return K.distance_to_label(v, label, medoids, spark)
    return distance_to(unit(v, _dim(medoids)), label, medoid_literal(medoids))


def assign(points: DataFrame, medoids: list[tuple[int, int, list[float]]],
           engine: str | None = None) -> DataFrame:
    """``(id, v, label, medoid_id, dist)``: every point to its nearest medoid."""
    best = _nearest("v", medoids, points.sparkSession, engine)
    return points.select("id", "v", best["label"].alias("label"), best["mid"].alias("medoid_id"),
                         best["dist"].alias("dist"))


def cluster_sums(assigned: DataFrame, engine: str | None = None, medoids=None, dim: int | None = None
                 ) -> list[tuple[int, int, list[float]]]:
    """(label, |K|, S_K) per cluster, S_K the sum of unit vectors: one
    aggregate, partial sums map-side, k rows back (size-checked like the
    medoids). ``assigned`` has ``v`` and ``label``, or only ``v`` when
    ``medoids`` says which cluster a row is in."""
    if dim is None and medoids is None:
        first = assigned.select(F.size("v").alias("d")).limit(1).collect()
        dim = first[0].d if first else 0
    dim = dim or _dim(medoids)
    most = MAX_MEDOID_CELLS // max(dim or 1, 1)
    totals = _cluster_totals(assigned, engine, medoids)
    rows = totals.select("label", "n", "S").limit(most + 1).collect()        # checked before they are brought here
    return _collect_medoids(sorted((r["label"], r["n"], r["S"]) for r in rows))


def _cluster_totals(assigned: DataFrame, engine: str | None, medoids) -> DataFrame:
    """(label, n, S, dist): exact sums, the same in any order (see the kernels). In SQL form the
    components are summed as decimals."""
    if (engine or ENGINE) == "arrow":
        return K.cluster_totals(K.cluster_partial_sums(assigned, medoids))
    rows = assign(assigned, medoids, engine) if medoids is not None else assigned.withColumn("dist", F.lit(0.0))
    scale = 2.0 ** K.FIXED_BITS
    parts = rows.select("label", F.col("dist").cast("decimal(38,12)").alias("dist"), F.posexplode(unit("v")).alias("p", "x"))
    cells = (parts.groupBy("label", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("dist").alias("dist"),
                                             F.sum(F.rint(F.col("x") * scale).cast("decimal(20,0)")).alias("x")))
    component = F.struct("p", (F.col("x").cast("double") / scale).alias("x"))
    return cells.groupBy("label").agg(
        F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(component)), lambda e: e["x"]).alias("S"),
        F.max("dist").alias("dist"))


def update_medoids(assigned: DataFrame, engine: str | None = None, medoids=None, dim: int | None = None) -> DataFrame:
    """``(label, medoid_id, s, u)``: per cluster the member with the least
    sum of distances to all members, s (ties: smaller id), and its unit vector.

    |K| and S_K come back as k rows; each point then scores
    s = |K| - u . S_K against that constant and a min per cluster is taken,
    combined map-side. No join, no all-pairs. ``assigned`` has ``id``, ``v``
    and ``label``, or only ``id`` and ``v`` when ``medoids`` is given (each
    row then belongs to its nearest medoid's cluster)."""
    eng = engine or ENGINE
    sums = cluster_sums(assigned, eng, medoids, dim)
    if not sums:
        return assigned.sparkSession.createDataFrame(
            [], "label long, medoid_id long, s double, u array<double>")
    if eng == "arrow":
        best = K.cluster_partial_best(assigned, sums, medoids).groupBy("label").agg(
            F.min(F.struct("s", "id", "u")).alias("b"))
    else:
        if medoids is not None:
            assigned = assign(assigned, medoids, eng)
        table = F.map_from_arrays(
            F.array(*[F.lit(lbl).cast("long") for lbl, _, _ in sums]),
            F.array(*[F.struct(F.lit(n).cast("double").alias("n"),
                               double_array_literal(vec).alias("S")) for _, n, vec in sums]))
        ks = F.element_at(table, F.col("label"))
        scored = assigned.select("label", "id", unit("v").alias("u")).select(
            "label", "id", "u", (ks["n"] - dot("u", ks["S"])).alias("s"))
        best = scored.groupBy("label").agg(
            F.min(F.struct(F.round("s", SUM_DECIMALS).alias("s"), "id", "u")).alias("b"))
    return best.select("label", F.col("b.id").alias("medoid_id"), F.col("b.s").alias("s"),
                       F.col("b.u").alias("u"))


def initial_assignment(points: DataFrame, medoids: list[tuple[int, int, list[float]]], k: int,
                       how: str = "mod", seed: int = 42, engine: str | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """D3: ``(id, v, label, medoid_id, dist, *keep)`` without a distance search.
    Medoids are numbered 0..k-1 by id; a point goes to number ``id mod k``
    (``how="mod"``) or to ``floor(h * k)`` for h uniform from md5(id:seed)
    (``how="hash"``). A small literal lookup replaces the join on the number."""
    ordered = sorted(medoids, key=lambda m: m[1])
    if how == "mod":
        slot = F.pmod(F.col("id"), F.lit(len(ordered)))
    elif how == "hash":
        h = F.conv(F.substring(hash_key("id", seed, "init"), 1, 8), 16, 10).cast("double")
        slot = F.least(F.floor(h / F.lit(float(2**32)) * len(ordered)), F.lit(len(ordered) - 1))
    else:
        raise ValueError("how must be 'mod' or 'hash'")
    labels = F.array(*[F.lit(m[0]).cast("long") for m in ordered])
    mids = F.array(*[F.lit(m[1]).cast("long") for m in ordered])
    idx = slot.cast("int") + 1
    out = points.select(*keep, "id", "v", F.element_at(labels, idx).alias("label"),
                        F.element_at(mids, idx).alias("medoid_id"))
    return out.withColumn("dist", _distance_to("v", "label", medoids, points.sparkSession, engine))


# --- the loop ----------------------------------------------------------------

class _Passes:
    """The tables of a sampling variant: points (rid, id, v), written once, and after each pass
    the rows' state (rid, id, label, medoid_id, dist), both dealt into the same buckets by ``rid``, a
    row number that holds for the run. A pass joins the two where they lie and writes state rows
    only, whatever the dimension."""

    STATE = "rid bigint, id bigint, label bigint, medoid_id bigint, dist double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.points: Bucketed | None = None
        self.state: Bucketed | None = None
        self.spare: Bucketed | None = None           # distances of the pass under way
        self.rows: int | None = None                 # known when this call wrote the points

    def start(self, points: DataFrame) -> DataFrame:
        self.rows = points.count()
        some = min(self.spark.sparkContext.defaultParallelism, -(-self.rows // SMALL_BUCKET))
        buckets = max(1, min(max(some, -(-self.rows // BUCKET_ROWS)), MAX_BUCKETS))
        rows = points.select(F.monotonically_increasing_id().alias("rid"), "id", "v")
        self.points, _ = Bucketed.write(rows.repartition(buckets, "rid"), f"{self.path}/points", "rid", buckets)
        return self.points.rows()

    def reopen(self, schema: str, buckets: int, state: str) -> None:
        """Go on with a committed state; what a broken pass left behind goes."""
        for name in children(self.spark, self.path):
            if name.startswith(("state-", "distances-")) and name != state:
                remove(self.spark, f"{self.path}/{name}")
        self.points = Bucketed.open(self.spark, f"{self.path}/points", schema, "rid", buckets)
        self.state = Bucketed.open(self.spark, f"{self.path}/{state}", self.STATE, "rid", buckets)

    def write(self, rows: DataFrame, name: str, **metrics) -> tuple[Bucketed, dict]:
        return Bucketed.write(rows.select("rid", "id", "label", "medoid_id", "dist"), f"{self.path}/{name}", "rid",
                              self.points.buckets, **metrics)

    def with_vectors(self, state: DataFrame) -> DataFrame:
        """``state`` and the rows' vectors; neither side moves, the narrow one is hashed."""
        return self.points.rows().select("rid", "v").join(state.hint("shuffle_hash"), "rid")

    def advance(self, state: Bucketed) -> None:
        for old in (self.state, self.spare):
            if old is not None:
                old.remove()
        self.state, self.spare = state, None

    def tables(self) -> list:
        return [t for t in (self.points, self.state, self.spare) if t is not None]


class _Log:
    """The passes committed to a folder: medoids and costs of each, and the name of its state.
    A pass counts once its commit table is complete; the two last ones are kept."""

    def __init__(self, spark: SparkSession, path: str, header: dict):
        self.spark, self.path, self.header = spark, path, header

    def _passes(self) -> list[str]:
        return [c for c in children(self.spark, self.path) if c.startswith("pass-")]

    def commit(self, it: int, prev: float, cur: float, costs: list[float], medoids, state: str | None, buckets: int) -> None:
        at = f"{self.path}/pass-{it:06d}"
        remove(self.spark, at)
        self.spark.createDataFrame(medoids, "label long, mid long, vec array<double>").write.parquet(f"{at}/medoids")
        row = (it, prev, cur, costs, state, buckets, *self.header.values())
        kinds = {int: "long", float: "double", str: "string"}
        schema = "iteration long, prev double, cur double, costs array<double>, state string, buckets long, " + \
            ", ".join(f"{k} {kinds[type(v)]}" for k, v in self.header.items())
        self.spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{at}/commit")
        for old in self._passes():
            if int(old[5:]) < it - 1:
                remove(self.spark, f"{self.path}/{old}")

    def last(self):
        """(commit row, medoids) of the last complete pass, None before the first."""
        for name in reversed(self._passes()):
            at = f"{self.path}/{name}"
            if "_SUCCESS" in children(self.spark, f"{at}/commit"):
                row = self.spark.read.parquet(f"{at}/commit").first()
                other = {k: (row[k], v) for k, v in self.header.items() if row[k] != v}
                if other:
                    raise ValueError(f"the run in {self.path} has other settings: {other}")
                got = self.spark.read.parquet(f"{at}/medoids").collect()
                return row, _collect_medoids(sorted((r.label, r.mid, r.vec) for r in got))
        return None


def reassigned_cost(points: DataFrame, medoids, engine: str | None = None) -> float:
    """D9, the single-machine rule: every point's distance to its nearest
    medoid, summed exactly (partial sums per task on the kernel path)."""
    if (engine or ENGINE) == "arrow":
        total = K.cluster_partial_sums(points, medoids).agg(F.sum("dist")).first()[0]
    else:
        total = assign(points, medoids, engine).agg(F.sum(F.col("dist").cast("decimal(38,12)"))).first()[0]
    return float(total or 0.0)


def _go_on(prev: float, cur: float, rule: str, tol: float) -> bool:
    if rule == "decrease":
        return prev > cur
    gain = (prev - cur) / cur if cur != 0 else (0.0 if prev == cur else float("inf"))
    if rule == "gain":
        return gain > tol
    return prev > cur and gain > tol


def k_medoids(df: DataFrame, id_col: str, vec_col: str, k: int, variant: str = "improved",
              tol: float = 0.005, max_iter: int | None = None, seed: int = 42,
              init_ids: list[int] | None = None, fraction: float = 0.2,
              core_fraction: float = 0.3, engine: str | None = None,
              cache: bool = False, run_path: str | None = None) -> KMedoidsResult:
    """D10. Returns assignments, medoids and the per-pass cost trace.

    Every variant stops on the first pass that fails its test and reports that
    pass's cost; ``max_iter`` bounds the passes when given, and ``converged`` says
    whether the variant's own test ended the loop. Passes are deterministic
    (md5 sampling keyed by id, seed and pass number; sums do not depend on the order of
    rows). ``cache=True`` keeps the (id, vector) columns in memory/disk between passes, for
    data that fits; by default each pass re-reads the source, which only sends the two
    columns through the scan. The sampling variants keep tables in the shared folder until
    ``unpersist``.

    ``run_path``: a folder that driver and executors share. Each pass is committed there,
    and a call that names a folder with committed passes goes on behind the last one, over the
    same data and settings."""
    variants = ("base", "improved", "local", "sampling", "smart_sampling")
    if variant not in variants:
        raise ValueError(f"variant must be one of {variants}")
    spark = df.sparkSession
    started = time.perf_counter()
    points = prepare_points(df, id_col, vec_col)
    sampling = variant in ("sampling", "smart_sampling")
    log, resumed = None, None
    if run_path is not None:
        log = _Log(spark, run_path.rstrip("/"), {"variant": variant, "k": k if init_ids is None else len(init_ids), "seed": seed,
                                                 "fraction": float(fraction), "core_fraction": float(core_fraction)})
        resumed = log.last()
    if resumed is not None:
        medoids = resumed[1]
        k = len(medoids)
    elif init_ids is not None:
        chosen = points.where(F.col("id").isin([int(i) for i in init_ids]))
        medoids = medoid_rows(chosen, engine)
        if len(medoids) != len(init_ids):
            raise ValueError("init_ids not all found")
        k = len(medoids)
    else:
        first = points.select(F.size("v").alias("d")).limit(1).collect()
        if first:
            _check_cells(k, first[0].d or 0)         # before k rows are brought here
        medoids = medoid_rows(pick_medoids(points, k, seed), engine)
    if not medoids:
        raise ValueError("no points")
    _check_cells(len(medoids), len(medoids[0][2]))
    if cache:
        points = points.persist(StorageLevel.MEMORY_AND_DISK)
    costs: list[float] = []
    prev, cur, it = float("inf"), float("1.7976931348623157e308"), 0
    rule = {"base": "decrease", "local": "decrease", "improved": "gain"}.get(variant, "both")
    passes = _Passes(spark, log.path if log else shared_path(spark, "kmedoids")) if sampling else None

    if resumed is not None:
        done = resumed[0]
        prev, cur, it, costs = done.prev, done.cur, done.iteration, list(done.costs)
        if sampling:
            vec = df.schema[vec_col].dataType.simpleString()
            passes.reopen(f"rid bigint, id bigint, v {vec}", done.buckets, done.state)
    else:
        if variant == "local":
            cur = reassigned_cost(points, medoids, engine)
        if sampling:
            how = "hash" if variant == "sampling" else "mod"
            dealt = passes.start(points)
            begun = initial_assignment(dealt, medoids, k, how, seed, engine, keep=("rid",))
            passes.advance(passes.write(begun, "state-000000")[0])

    total = F.sum(F.col("dist").cast("decimal(38,12)"))
    while _go_on(prev, cur, rule, tol) and (max_iter is None or it < max_iter):
        it += 1
        if not sampling:
            new = update_medoids(points, engine, medoids=medoids).collect()
            step_cost = math.fsum(r["s"] for r in new)
            by_label = {r["label"]: r for r in new}
            # a cluster with no member keeps its medoid
            rows = [(m[0], by_label[m[0]]["medoid_id"], by_label[m[0]]["u"]) if m[0] in by_label
                    else m for m in medoids]
            medoids = _collect_medoids(rows)
            if variant == "base":   # the label is the medoid itself, renamed each pass
                medoids = [(mid, mid, vec) for _, mid, vec in medoids]
            if variant == "local":
                step_cost = reassigned_cost(points, medoids, engine)
        else:
            now = passes.state.rows()
            if variant == "sampling":
                marked = now.withColumn("_sel", hash_fraction("id", fraction, seed, it, "reassign"))
            else:
                if it > 1:                           # the distance and the medoid it belongs to
                    ids = F.map_from_arrays(F.array(*[F.lit(m[0]).cast("long") for m in medoids]),
                                            F.array(*[F.lit(m[1]).cast("long") for m in medoids]))
                    fresh = passes.with_vectors(now).withColumns({
                        "dist": _distance_to("v", "label", medoids, spark, engine),
                        "medoid_id": F.element_at(ids, F.col("label"))})
                    passes.spare, _ = passes.write(fresh, f"distances-{it:06d}")
                    now = passes.spare.rows()
                marked = percent_rank_flag(now, ["label"], "dist", fraction, descending=True, stored=True, rows=passes.rows)
            # a row is re-assigned by a test on itself, so no anti join and union are needed
            best = _nearest("v", medoids, spark, engine, F.col("_sel"))
            merged = passes.with_vectors(marked).select(
                "rid", "id",
                F.when(F.col("_sel"), best["label"]).otherwise(F.col("label")).alias("label"),
                F.when(F.col("_sel"), best["mid"]).otherwise(F.col("medoid_id")).alias("medoid_id"),
                F.when(F.col("_sel"), best["dist"]).otherwise(F.col("dist")).alias("dist"))
            written, seen = passes.write(merged, f"state-{it:06d}", total=total)
            step_cost = float(seen["total"] or 0.0)
            if variant == "sampling":
                cand = written.rows().where(hash_fraction("id", fraction, seed, it, "update"))
            else:
                cand = percent_rank_filter(written.rows(), ["label"], "dist", core_fraction,
                                           descending=False, stored=True, rows=passes.rows)
            new = update_medoids(passes.with_vectors(cand).select("id", "v", "label"), engine,
                                 dim=_dim(medoids)).collect()
            by_label = {r["label"]: r for r in new}
            medoids = _collect_medoids([(m[0], by_label[m[0]]["medoid_id"], by_label[m[0]]["u"])
                                        if m[0] in by_label else m for m in medoids])
        prev, cur = cur, step_cost
        costs.append(step_cost)
        if log is not None:
            log.commit(it, prev, cur, costs, medoids, f"state-{it:06d}" if sampling else None,
                       passes.points.buckets if sampling else 0)
        if sampling:                                 # the state before goes once this pass is committed
            passes.advance(written)

    if sampling:
        assignments = passes.state.rows().select("id", "label", "medoid_id", "dist")
    else:
        assignments = assign(points, medoids, engine).select("id", "label", "medoid_id", "dist")
    med_df = spark.createDataFrame([(m[0], m[1]) for m in medoids], "label long, medoid_id long")
    trace = spark.createDataFrame([(i + 1, c) for i, c in enumerate(costs)],
                                  "iteration int, cost double")
    return KMedoidsResult(assignments, med_df, trace, it, cur, time.perf_counter() - started,
                          points if cache else None, not _go_on(prev, cur, rule, tol),
                          passes.tables() if sampling and log is None else [])
