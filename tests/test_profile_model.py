import numpy as np

import pytest
from pyspark.sql import functions as F

from lodestone.operators.model import (
    area_under_roc, dictionary, fit_and_score, fit_features, fold_of, hash_split, numbered, prediction_breakdown, string_index, tune)
from lodestone.operators.profile import count_by, profile


def test_profile_matches_numpy(spark):
    rng = np.random.default_rng(5)
    vals = [float(x) for x in rng.integers(0, 50, size=301)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.statistic: r.value for r in profile(df, "x").collect()}
    arr = np.array([v for v in vals if v is not None])
    assert got["count"] == 301 and got["min"] == arr.min() and got["max"] == arr.max()
    assert abs(got["mean"] - arr.mean()) < 1e-9 and abs(got["stddev"] - arr.std(ddof=1)) < 1e-9
    for key, q in (("25%", 25), ("50%", 50), ("75%", 75)):
        assert abs(got[key] - np.percentile(arr, q)) < 1e-9


def test_profile_empty_and_approx(spark):
    df = spark.createDataFrame([(None,)], "x double")
    got = {r.statistic: r.value for r in profile(df, "x").collect()}
    assert got["count"] == 0 and got["50%"] is None
    df2 = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    approx = {r.statistic: r.value for r in profile(df2, "x", exact=False).collect()}
    assert approx["50%"] == 50.0


def test_count_by_orders_by_count(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in count_by(df, "k").collect()] == [("b", 2), ("c", 2), ("a", 1)]


def _toy(spark):
    rows = []
    for i in range(200):
        lang = ["en", "fr", "de"][i % 3]
        src = f"s{i % 5}"
        rows.append((i, lang, src, float((i * 37) % 101), int((i % 3 == 0) or (i % 7 == 0))))
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars double, quality int")


def test_string_index_by_frequency_then_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    got = {r.k: r.k_index for r in string_index(df, "k").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_pipeline_fits_and_keeps_unseen_category(spark):
    df = _toy(spark)
    train, test = hash_split(df, "doc_id", 0.8, 42)
    unseen = spark.createDataFrame([(999, "xx", "s_new", 5.0, 1)], df.schema)
    model, ev = fit_and_score(train, test.unionByName(unseen), ["lang", "source"], ["n_chars"], "quality")
    assert 0.0 <= ev.auc <= 1.0 and 0.0 <= ev.accuracy <= 1.0
    assert ev.predictions.where("doc_id = 999").count() == 1
    br = prediction_breakdown(ev.predictions, "lang").collect()
    assert sum(r["count"] for r in br) == test.count() + 1


def test_hash_split_is_repeatable(spark):
    df = _toy(spark)
    a1, _ = hash_split(df, "doc_id")
    a2, _ = hash_split(df.repartition(7), "doc_id")
    assert sorted(r.doc_id for r in a1.collect()) == sorted(r.doc_id for r in a2.collect())


def test_run_study_end_to_end(spark):
    from lodestone.operators.model import run_study
    df = _toy(spark)
    st = run_study(df, ["lang", "source"], ["n_chars"], "quality", "n_chars", "lang",
                   ["lang", "n_chars"], id_col="doc_id")
    assert st.train_rows + st.test_rows == 200
    assert 0.0 <= st.tuned_evaluation.auc <= 1.0
    assert {r.statistic for r in st.profile.collect()} >= {"count", "50%"}
    assert sum(r["count"] for r in st.breakdowns["lang"].collect()) == st.test_rows


def test_sample_rows_repeatable(spark):
    from lodestone.operators.sampling import pick_rows, sample_rows
    df = spark.range(1000)
    a = sorted(r.id for r in sample_rows(df, 0.2, 42, "id", "x").collect())
    b = sorted(r.id for r in sample_rows(df.repartition(5), 0.2, 42, "id", "x").collect())
    assert a == b and 120 < len(a) < 280
    assert sample_rows(df, 0.5, 1).count() > 0
    assert [r.id for r in pick_rows(df, 3, "id").collect()] == \
        [r.id for r in pick_rows(df.repartition(4), 3, "id").collect()]


def test_numbers_follow_the_order_over_many_partitions(spark):
    df = spark.range(20_000).select((F.xxhash64("id") % 5000).alias("k"), "id").repartition(13)
    rows = numbered(df, F.desc("k"), F.asc("id")).collect()
    want = sorted(((r.k, r.id) for r in rows), key=lambda r: (-r[0], r[1]))
    assert [(r.k, r.id) for r in sorted(rows, key=lambda r: r._n)] == want
    assert sorted(r._n for r in rows) == list(range(20_000))


def test_dictionary_of_many_values(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), F.col("id") % 9001)).alias("k"))
    got = {r.value: r["index"] for r in dictionary(df, "k").collect()}
    counts = {r.k: r["count"] for r in df.where("k is not null").groupBy("k").count().collect()}
    assert got == {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    assert dictionary(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("n,levels", [(1, 1), (50, 3), (3000, 40), (3000, 10 ** 6)])
def test_area_under_roc_counts_pairs(spark, n, levels):
    rng = np.random.default_rng(n + levels)
    s, y = rng.integers(0, levels, n) / 7.0, rng.integers(0, 2, n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)] + [(None, 1.0), (1.0, None)], "score double, label double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)) if len(pos) and len(neg) else 0.0
    for parts in (1, 64):
        assert area_under_roc(df.repartition(parts)) == pytest.approx(want, abs=1e-12)


def test_area_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(4000).select((F.xxhash64("id") % 300).cast("double").alias("score"),
                                  F.when(F.xxhash64("id", F.lit(1)) % 3 == 0, 1.0).otherwise(0.0).alias("label"))
    lib = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC", numBins=0).evaluate(df)
    assert area_under_roc(df) == pytest.approx(lib, abs=1e-9)


def test_features_have_a_slot_for_unseen_and_null(spark):
    df = _toy(spark)
    features = fit_features(df, ["lang", "source"], ["n_chars"], "quality")
    odd = spark.createDataFrame([(1, "xx", None, 5.0, 1), (2, "en", "s0", 6.0, 0)], df.schema)
    got = {r.doc_id: r.features.toArray().tolist() for r in features.transform(odd).collect()}
    assert len(got[1]) == 4 + 6 + 1 and got[1][3] == 1 and got[1][9] == 1 and got[1][10] == 5.0
    assert sum(got[2][:4]) == 1 and sum(got[2][4:10]) == 1 and got[2][3] == 0


def test_folds_and_grid_do_not_follow_the_partitioning(spark):
    df = _toy(spark)
    a = {r.doc_id: r.f for r in df.select("doc_id", fold_of("doc_id").alias("f")).collect()}
    b = {r.doc_id: r.f for r in df.repartition(64).select("doc_id", fold_of("doc_id").alias("f")).collect()}
    assert a == b and set(a.values()) == {0, 1, 2}
    grids = [[(r, e, round(x, 6)) for r, e, x in tune(df.repartition(n), ["lang"], ["n_chars"], "quality", id_col="doc_id").grid]
             for n in (1, 64)]
    assert grids[0] == grids[1] and len(grids[0]) == 9


def test_split_without_an_id_follows_the_content(spark):
    df = _toy(spark).drop("doc_id")
    a, _ = hash_split(df)
    b, _ = hash_split(df.repartition(9))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and 100 < a.count() < 200
