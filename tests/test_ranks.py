import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import lodestone.operators.ranks as R
from lodestone.operators.ranks import percent_rank_filter


@pytest.fixture
def tiny_limits(monkeypatch):
    monkeypatch.setattr(R, "BUCKETS", 3)
    monkeypatch.setattr(R, "EXACT_LIMIT", 5)


def _data(spark, seed=7, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", "c", "d"]) if i % 3 else "a", float(rnd.choice([rnd.random(), 0.5, 1.0])))
            for i in range(n)]
    rows += [("solo", 3.0), (None, 1.0), (None, 2.0), (None, 2.0), (None, 5.0)]
    return spark.createDataFrame(rows, "g string, v double")


def test_order_statistics_match_sorting(spark):
    df = _data(spark)
    pdf = df.toPandas()
    tg = [(g, i, r) for g in ["a", "b", "solo", None] for i, r in enumerate([1, 2, 50, 10**6])]
    targets = spark.createDataFrame(tg, "g string, tid long, r long")
    got = {(row.g, row.tid): row.value for row in
           R.order_statistics(df, ["g"], "v", targets, buckets=4, exact_limit=7).collect()}
    for g, tid, r in tg:
        vs = sorted(pdf[pdf.g.isna()].v if g is None else pdf[pdf.g == g].v)
        assert got[(g, tid)] == (vs[r - 1] if r <= len(vs) else None)


@pytest.mark.parametrize("frac,desc", [(0.2, True), (0.3, False), (0.0, True), (1.0, False), (0.5, True)])
def test_percent_rank_filter_equals_window(spark, tiny_limits, frac, desc):
    df = _data(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").desc() if desc else F.col("v"))
    ref = df.withColumn("pr", F.percent_rank().over(w)).where(F.col("pr") <= frac).drop("pr")
    got = R.percent_rank_filter(df, ["g"], "v", frac, desc)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, ref.collect()))


def test_percent_rank_global_group(spark):
    df = _data(spark)
    w = Window.orderBy(F.col("v").desc())
    ref = df.withColumn("pr", F.percent_rank().over(w)).where("pr <= 0.2").drop("pr")
    assert sorted(map(repr, R.percent_rank_filter(df, [], "v", 0.2, True).collect())) == \
        sorted(map(repr, ref.collect()))


def test_order_statistics_geometric_values(spark):
    # equal-width buckets split a geometric sequence slowly: many passes, still exact
    vals = [2.0 ** -i for i in range(40)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    targets = spark.createDataFrame([(0, 1), (1, 20), (2, 40)], "tid long, r long")
    got = {r.tid: r.value for r in R.order_statistics(df, [], "v", targets, buckets=4,
                                                      exact_limit=2).collect()}
    s = sorted(vals)
    assert got == {0: s[0], 1: s[19], 2: s[39]}


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("values,kind", [
    ([INF, 1.0, 2.0, 3.0, -INF, NAN, 5.0, 5.0, 1e308, -1e308, 1e-300] * 3, "double"),
    ([2**53 + i for i in range(40)] + [2**63 - 1, -2**63, 0], "long"),
    ([10.0 ** e for e in range(-300, 300, 7)] + [-(10.0 ** e) for e in range(-300, 300, 9)], "double")])
@pytest.mark.parametrize("desc", [False, True])
def test_refinement_on_hard_values(spark, values, kind, desc):
    df = spark.createDataFrame([(1, v) for v in values], f"g int, v {kind}")
    w = Window.partitionBy("g").orderBy(F.col("v").desc() if desc else F.col("v"))
    for frac in (0.0, 0.3, 0.9):
        want = df.withColumn("p", F.percent_rank().over(w)).where(F.col("p") <= frac).drop("p")
        got = percent_rank_filter(df, ["g"], "v", frac, desc, exact_limit=2)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_two_hundred_thousand_groups(spark):
    # as many thresholds as groups; nothing of them comes to the driver
    n = 200_000
    df = spark.range(4 * n).select((F.col("id") % n).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("v"))
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    want = df.withColumn("p", F.percent_rank().over(w)).where("p <= 0.4").drop("p")
    got = percent_rank_filter(df, ["g"], "v", 0.4, True)
    mark = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("g", "v")).alias("x"), F.sum("v").alias("s")]
    assert tuple(got.agg(*mark).first()) == tuple(want.agg(*mark).first())


def test_many_open_groups_refine_together(spark, tiny_limits):
    df = spark.range(60_000).select((F.col("id") % 300).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 6)) / 7).alias("v"))
    w = Window.partitionBy("g").orderBy("v")
    want = df.withColumn("p", F.percent_rank().over(w)).where("p <= 0.3").drop("p")
    got = percent_rank_filter(df, ["g"], "v", 0.3)
    mark = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("g", "v")).alias("x")]
    assert tuple(got.agg(*mark).first()) == tuple(want.agg(*mark).first())


def test_empty_table_and_null_values(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "g int, v double")
    assert [tuple(r) for r in percent_rank_filter(df, ["g"], "v", 0.2).collect()] == [(2, 5.0)]
    assert percent_rank_filter(df.limit(0), ["g"], "v", 0.2).count() == 0
    assert percent_rank_filter(df.limit(0), [], "v", 0.2).count() == 0
