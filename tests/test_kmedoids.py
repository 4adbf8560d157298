import hashlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.functions.sampling import hex_threshold
from lodestone.functions.vectors import dot, unit
from lodestone.operators.kmedoids import (
    SUM_DECIMALS, assign, k_medoids, medoid_rows, prepare_points, update_medoids)


def medoid_cost_pairwise(assigned):
    """The reference's all-pairs medoid search, as a test oracle."""
    a = assigned.select("label", F.col("id").alias("cid"), unit("v").alias("cu"))
    b = assigned.select("label", unit("v").alias("ou"))
    s = a.join(b, "label").groupBy("label", "cid").agg(
        F.sum(F.lit(1.0) - dot("cu", "ou")).alias("s"))
    best = s.groupBy("label").agg(F.min(F.struct(F.round("s", SUM_DECIMALS).alias("s"),
                                                 "cid")).alias("b"))
    return best.select("label", F.col("b.cid").alias("medoid_id"), F.col("b.s").alias("s"))

# FIXTURES 2.4: two directions plus a zero vector
PLANTED = [(0, [1.0, 0.0]), (1, [.9, .1]), (2, [.8, .3]), (3, [0.0, 1.0]), (4, [.1, .9]),
           (5, [.3, .8]), (6, [0.0, 0.0])]


@pytest.fixture(scope="module")
def planted(spark):
    return spark.createDataFrame(PLANTED, "id long, v array<double>")


def _trace(res):
    return [round(r.cost, 6) for r in res.trace.orderBy("iteration").collect()]


@pytest.mark.parametrize("engine", ["arrow", "sql"])
@pytest.mark.parametrize("variant,init,trace", [
    ("improved", [0, 3], [1.073478, 1.073478]),
    ("improved", [0, 1], [1.984383, 1.073478, 1.073478]),
    ("base", [0, 1], [1.984383, 1.073478, 1.073478]),
    ("local", [0, 1], [1.16408, 1.073478, 1.073478]),
])
def test_planted_fixture(planted, variant, init, trace, engine):
    res = k_medoids(planted, "id", "v", 2, variant, init_ids=init, engine=engine)
    assert _trace(res) == trace
    assert sorted(r.medoid_id for r in res.medoids.collect()) == [1, 4]
    got = {r.id: r.medoid_id for r in res.assignments.collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 4, 4: 4, 5: 4, 6: 1}   # zero vector: tie -> smaller id


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_factored_update_equals_pairwise(spark, engine):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)], int(i % 4)) for i in range(80)]
    rows.append((80, [0.0] * 6, 1))
    rows.append((81, rows[5][1], 1))                   # an equal vector under another id
    df = spark.createDataFrame(rows, "id long, v array<double>, label long")
    pts = prepare_points(df, "id", "v", keep=("label",))
    fact = {r.label: (r.medoid_id, round(r.s, 6)) for r in update_medoids(pts, engine).collect()}
    pair = {r.label: (r.medoid_id, round(r.s, 6)) for r in medoid_cost_pairwise(pts).collect()}
    assert fact == pair


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_wrong_length_rejected(spark, engine):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0, 1.0])],
                               "id long, v array<double>")
    with pytest.raises(PySparkException):
        k_medoids(df, "id", "v", 2, "improved", init_ids=[0, 1], engine=engine).assignments.collect()


def test_equal_vectors_keep_their_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])],
                               "id long, v array<double>")
    res = k_medoids(df, "id", "v", 2, "improved", init_ids=[0, 2])
    assert sorted(r.id for r in res.assignments.collect()) == [0, 1, 2]


# --- brute force of the sampling variants -------------------------------------

def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def _pr_keep(dist, labels, frac, desc):
    keep = np.zeros(len(dist), bool)
    for lab in set(labels):
        idx = [i for i in range(len(dist)) if labels[i] == lab]
        n = len(idx)
        for i in idx:
            ahead = sum(1 for j in idx if (dist[j] > dist[i] if desc else dist[j] < dist[i]))
            pr = ahead / (n - 1) if n > 1 else 0.0
            keep[i] = pr <= frac
    return keep


def _brute(ids, X, k, variant, init, seed=42, tol=0.005, max_iter=20, frac=0.2, core=0.3):
    nrm = np.linalg.norm(X, axis=1, keepdims=True)
    U = np.where(nrm > 0, X / np.where(nrm > 0, nrm, 1), 0.0)
    pos = {i: p for p, i in enumerate(ids)}
    med = {m: m for m in sorted(init)}                  # label -> medoid id

    def dist(p, mid):
        return round(1.0 - float(U[p] @ U[pos[mid]]), 12)

    def nearest(p):
        return min((dist(p, mid), mid, lab) for lab, mid in med.items())

    ordered = sorted(med)
    if variant == "sampling":
        slot = [min(int(int(_md5(f"{i}:{seed}:init")[:8], 16) / 2**32 * k), k - 1) for i in ids]
    else:
        slot = [i % k for i in ids]
    labels = [ordered[s] for s in slot]
    d = [dist(p, med[labels[p]]) for p in range(len(ids))]
    prev, cur, it, costs = float("inf"), 1.7976931348623157e308, 0, []
    thr = hex_threshold(frac)
    while prev > cur and (prev - cur) / cur > tol and it < max_iter:
        it += 1
        if variant == "smart_sampling":
            d = [dist(p, med[labels[p]]) for p in range(len(ids))]
            sel = _pr_keep(d, labels, frac, True)
        else:
            sel = [_md5(f"{i}:{seed}:{it}:reassign")[:8] < thr for i in ids]
        for p in range(len(ids)):
            if sel[p]:
                d[p], _, labels[p] = nearest(p)
        if variant == "smart_sampling":
            cand = _pr_keep(d, labels, core, False)
        else:
            cand = [_md5(f"{i}:{seed}:{it}:update")[:8] < thr for i in ids]
        for lab in list(med):
            members = [p for p in range(len(ids)) if labels[p] == lab and cand[p]]
            if members:
                best = min((round(sum(1.0 - float(U[c] @ U[o]) for o in members), 9), ids[c])
                           for c in members)
                med[lab] = best[1]
        prev, cur = cur, float(sum(d))
        costs.append(cur)
    return costs, med, labels


@pytest.mark.parametrize("engine", ["arrow", "sql"])
@pytest.mark.parametrize("variant", ["sampling", "smart_sampling"])
def test_sampling_variants_match_brute_force(spark, variant, engine):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(3, 4)) * 3
    X = np.vstack([centers[i % 3] + rng.normal(size=4) for i in range(60)])
    ids = list(range(100, 160))
    df = spark.createDataFrame([(i, [float(x) for x in X[p]]) for p, i in enumerate(ids)],
                               "id long, v array<double>")
    init = [100, 101, 102]
    costs, med, labels = _brute(ids, X, 3, variant, init)
    res = k_medoids(df, "id", "v", 3, variant, init_ids=init, max_iter=20, engine=engine)
    assert [round(c, 6) for c in costs] == _trace(res)
    assert {r.label: r.medoid_id for r in res.medoids.collect()} == med
    got = {r.id: r.label for r in res.assignments.collect()}
    assert [got[i] for i in ids] == labels


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_assign_is_a_projection(spark, planted, engine):
    pts = prepare_points(planted, "id", "v")
    plan = assign(pts, [(0, 0, [1.0, 0.0]), (3, 3, [0.0, 1.0])], engine)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_engines_agree_on_embeddings(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = {}
    for engine in ("arrow", "sql"):
        pts = prepare_points(e, "vec_id", "embedding")
        med = medoid_rows(pts.orderBy("id").limit(6), engine)
        out[engine] = sorted((r.id, r.medoid_id, round(r.dist, 9))
                             for r in assign(pts, med, engine).collect())
    assert out["arrow"] == out["sql"]


def test_embeddings_improved_runs(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    res = k_medoids(e, "vec_id", "embedding", 4, "improved", max_iter=5)
    assert res.assignments.count() == e.count()
    costs = _trace(res)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))   # full re-assignment never rises
    assert res.assignments.where(F.col("dist") < -1e-9).count() == 0


def test_report_has_four_lines(planted, tmp_path):
    from lodestone.sources.files import write_lines
    res = k_medoids(planted, "id", "v", 2, "improved", init_ids=[0, 1])
    out = str(tmp_path / "report")
    write_lines(res.report(), out)
    lines = [r.value for r in res.report().collect()]
    assert lines[0].startswith("Time: ") and lines[1] == "Iterations: 3"
    assert lines[3].startswith("Final cost: 1.07347")
    assert len(lines[2].split(",")) == 3
    res.unpersist()


def test_kernels_across_batches_and_broadcast(spark, monkeypatch):
    import lodestone.functions.vector_kernels as K
    rng = np.random.default_rng(21)
    rows = [(i, [float(x) for x in rng.normal(size=5)], int(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label long").repartition(3)
    pts = prepare_points(df, "id", "v", keep=("label",))
    ref = sorted(tuple(r) for r in update_medoids(pts, "sql").select("label", "medoid_id").collect())
    med = medoid_rows(pts.orderBy("id").limit(4), "sql")
    ref_m = sorted(tuple(r) for r in update_medoids(pts.select("id", "v"), "sql", medoids=med)
                   .select("label", "medoid_id").collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for cells in (65_536, 0):                      # closure, then broadcast variable
            monkeypatch.setattr(K, "CLOSURE_CELLS", cells)
            got = sorted(tuple(r) for r in update_medoids(pts, "arrow")
                         .select("label", "medoid_id").collect())
            got_m = sorted(tuple(r) for r in update_medoids(pts.select("id", "v"), "arrow",
                                                            medoids=med)
                           .select("label", "medoid_id").collect())
            assert got == ref and got_m == ref_m
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_empty_cluster_keeps_its_medoid(spark, engine):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.1, 1.0])],
                               "id long, v array<double>")
    # pass 1: every tie goes to the smaller medoid id, so cluster 1 has no member
    # and keeps medoid 1, while cluster 0 moves to point 3
    res = k_medoids(df, "id", "v", 2, "improved", init_ids=[0, 1], max_iter=1, engine=engine)
    assert {r.label: r.medoid_id for r in res.medoids.collect()} == {0: 3, 1: 1}
    # pass 2: points 0 and 1 come back to cluster 1, whose medoid becomes 0 (smaller id)
    res = k_medoids(df, "id", "v", 2, "improved", init_ids=[0, 1], max_iter=2, engine=engine)
    assert {r.label: r.medoid_id for r in res.medoids.collect()} == {0: 2, 1: 0}


def test_kernels_slice_large_batches(spark):
    # one partition of 10,000 rows = one Arrow batch, cut into 4096-row slices
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4)], int(i % 3)) for i in range(10_000)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label long").coalesce(1)
    pts = prepare_points(df, "id", "v", keep=("label",))
    med = medoid_rows(pts.orderBy("id").limit(3), "sql")
    res = {}
    for engine in ("arrow", "sql"):
        a = assign(pts.select("id", "v"), med, engine)
        res[engine] = (sorted((r.id, r.medoid_id) for r in a.collect()),
                       sorted(tuple(r) for r in update_medoids(pts, engine)
                              .select("label", "medoid_id").collect()))
    assert res["arrow"] == res["sql"]


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_smart_sampling_distance_belongs_to_its_medoid(spark, engine):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(80, 4))
    df = spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(80)], "id long, v array<double>")
    res = k_medoids(df, "id", "v", 4, "smart_sampling", tol=-1.0, max_iter=3, engine=engine)
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    rows = res.assignments.collect()
    assert all(abs(r.dist - (1 - U[r.id] @ U[r.medoid_id])) < 1e-9 for r in rows)


@pytest.mark.parametrize("engine", ["arrow", "sql"])
@pytest.mark.parametrize("value", [float("nan"), float("inf")])
def test_non_finite_vectors_rejected(spark, engine, value):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, value])], "id long, v array<double>")
    with pytest.raises(PySparkException):
        k_medoids(df, "id", "v", 1, "improved", init_ids=[0], engine=engine).assignments.collect()


def test_converged_flag(spark, planted):
    assert k_medoids(planted, "id", "v", 2, "improved", init_ids=[0, 1]).converged
    assert not k_medoids(planted, "id", "v", 2, "improved", init_ids=[0, 1], max_iter=1).converged


# --- the sampling variants' tables ---------------------------------------------

def _cloud(spark, n, dim, seed=7):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, dim)) + 2 * rng.normal(size=(4, dim))[np.arange(n) % 4]
    return spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(n)], "id long, v array<double>")


def _bytes(path):
    import os
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


@pytest.mark.parametrize("variant", ["sampling", "smart_sampling"])
def test_state_does_not_grow_with_the_dimension(spark, variant, tmp_path):
    sizes = []
    for dim in (4, 64):
        run = str(tmp_path / f"run{dim}")
        res = k_medoids(_cloud(spark, 2000, dim), "id", "v", 4, variant, tol=-1.0, max_iter=2, run_path=run)
        assert res.iterations == 2
        sizes.append((_bytes(f"{run}/state-000002"), _bytes(f"{run}/points")))
    assert sizes[1][0] < 1.1 * sizes[0][0] and sizes[1][1] > 8 * sizes[0][1]


def test_points_are_not_moved_by_a_pass(spark, tmp_path):
    from lodestone.operators.kmedoids import _Passes
    passes = _Passes(spark, str(tmp_path / "run"))
    rows = passes.start(_cloud(spark, 500, 3))
    state = rows.select("rid", "id", F.lit(0).cast("long").alias("label"), F.col("id").alias("medoid_id"), F.lit(0.5).alias("dist"))
    passes.advance(passes.write(state, "state-0")[0])
    joined = passes.with_vectors(passes.state.rows())
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ShuffledHashJoin" in plan and joined.count() == 500
    for t in passes.tables():
        t.remove()
    assert not (tmp_path / "run" / "points").exists()


def test_ids_may_repeat(spark):
    df = _cloud(spark, 40, 3).withColumn("id", F.col("id") % 20)
    res = k_medoids(df, "id", "v", 3, "sampling", tol=-1.0, max_iter=2)
    assert res.assignments.count() == 40
    res.unpersist()


class _Killed(Exception):
    pass


@pytest.mark.parametrize("variant", ["sampling", "smart_sampling", "improved"])
def test_a_killed_run_goes_on(spark, variant, tmp_path, monkeypatch):
    from lodestone.operators import kmedoids as M
    df = _cloud(spark, 400, 4)
    whole = k_medoids(df, "id", "v", 4, variant, tol=-1.0, max_iter=4)
    want = sorted(map(tuple, whole.assignments.collect()))
    run = str(tmp_path / "run")
    real = M.update_medoids
    calls = []

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise _Killed
        return real(*args, **kw)

    monkeypatch.setattr(M, "update_medoids", dies)
    with pytest.raises(_Killed):
        k_medoids(df, "id", "v", 4, variant, tol=-1.0, max_iter=4, run_path=run)
    monkeypatch.setattr(M, "update_medoids", real)
    res = k_medoids(df, "id", "v", 4, variant, tol=-1.0, max_iter=4, run_path=run)
    assert res.iterations == 4 and sorted(map(tuple, res.assignments.collect())) == want
    assert [r.cost for r in res.trace.orderBy("iteration").collect()] == [r.cost for r in whole.trace.orderBy("iteration").collect()]
    left = sorted(p.name for p in (tmp_path / "run").iterdir())
    assert left == [*(["pass-000003", "pass-000004"]), *(["points", "state-000004"] if variant != "improved" else [])]
    with pytest.raises(ValueError):
        k_medoids(df, "id", "v", 3, variant, run_path=run)
    whole.unpersist()


# --- exact sums, pruned search ---------------------------------------------------

def test_sums_have_the_same_bits_for_any_partitioning(spark):
    h = [((F.xxhash64("id", F.lit(j)) % 1000) / 7.0 + F.lit(float(j))).alias(f"x{j}") for j in range(5)]
    df = spark.range(1_000_000).select("id", *h).select("id", F.array(*[f"x{j}" for j in range(5)]).alias("v"))
    seen = set()
    for n in (1, 7, 211):
        pts = prepare_points(df.repartition(n), "id", "v")
        med = medoid_rows(pts.where("id < 4"))
        best = sorted((r.label, r.medoid_id, r.s.hex()) for r in update_medoids(pts, medoids=med).collect())
        from lodestone.operators.kmedoids import cluster_sums, reassigned_cost
        sums = [(a, b, [x.hex() for x in c]) for a, b, c in cluster_sums(pts, medoids=med)]
        seen.add(repr((best, sums, reassigned_cost(pts, med).hex())))
    assert len(seen) == 1


def test_pruned_search_equals_plain_search():
    from lodestone.functions.vector_kernels import Blocks, _round, products, unit_rows
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    mm = unit_rows(centres[np.arange(5000) % 40] + 0.15 * rng.normal(size=(5000, 16)))
    mm[77] = 0.0
    mm[4000] = mm[12]                                   # a tie: the first wins
    um = unit_rows(np.vstack([centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 16)), mm[[12, 4000]], np.zeros((3, 16)),
                              rng.normal(size=(200, 16))]))
    key = _round(1 - products(um, mm), 12)
    want = np.argmin(key, axis=1)
    counted = []
    at, dist = Blocks(mm, 128).nearest(um, counted)
    assert (at == want).all() and (dist == key[np.arange(len(um)), want]).all()
    assert sum(counted) < 0.6 * um.shape[0] * mm.shape[0]
