"""Registered queries: each reads the whole given tables (``sf_dir``) and runs
one operator; ``ORACLE_SQL`` holds the equivalent DuckDB SQL under the same
key, with the same column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.primes import odd_primes_upto, prime_filter, top_primes
from lodestone.operators.profile import count_by, profile
from lodestone.operators.text import word_count, word_search
from lodestone.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# The tokenizer as DuckDB writes it (lower, non a-z to space, split on space).
_SQL_TOKENS = "string_split(regexp_replace(lower({c}), '[^a-z]', ' ', 'g'), ' ')"


# --- C1 word count -----------------------------------------------------------

@register("word_count", f"""
SELECT word, count(*) AS count FROM (
  SELECT unnest({_SQL_TOKENS.format(c='text')}) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def q_word_count(spark, sf):
    return word_count(table(spark, sf, "documents"), "text")


@register("word_count_conversations", f"""
SELECT word, count(*) AS count FROM (
  SELECT unnest({_SQL_TOKENS.format(c='text')}) AS word FROM conversations)
WHERE word <> '' GROUP BY word""")
def q_word_count_conv(spark, sf):
    return word_count(table(spark, sf, "conversations"), "text")


@register("word_count_pages", f"""
SELECT word, count(*) AS count FROM (
  SELECT unnest({_SQL_TOKENS.format(c='html')}) AS word FROM pages)
WHERE word <> '' GROUP BY word""")
def q_word_count_pages(spark, sf):
    return word_count(table(spark, sf, "pages"), "html")


@register("word_count_benchmark", f"""
SELECT word, count(*) AS count FROM (
  SELECT unnest({_SQL_TOKENS.format(c='text')}) AS word FROM benchmark)
WHERE word <> '' GROUP BY word""")
def q_word_count_benchmark(spark, sf):
    return word_count(table(spark, sf, "benchmark"), "text")


# --- C2 word search ----------------------------------------------------------

@register("word_search_documents", f"""
SELECT count(DISTINCT doc_id) AS count FROM documents
WHERE list_contains({_SQL_TOKENS.format(c='text')}, 'the')""")
def q_word_search_docs(spark, sf):
    return word_search(table(spark, sf, "documents"), "the", "text", "doc_id", per="id")


@register("word_search_conv_per_id", f"""
SELECT count(DISTINCT conv_id) AS count FROM conversations
WHERE list_contains({_SQL_TOKENS.format(c='text')}, 'data')""")
def q_word_search_conv_id(spark, sf):
    return word_search(table(spark, sf, "conversations"), "data", "text", "conv_id", per="id")


@register("word_search_conv_per_record", f"""
SELECT count(*) AS count FROM conversations
WHERE list_contains({_SQL_TOKENS.format(c='text')}, 'data')""")
def q_word_search_conv_rec(spark, sf):
    return word_search(table(spark, sf, "conversations"), "data", "text", "conv_id",
                       per="record")


@register("word_search_pages_script", f"""
SELECT count(DISTINCT page_id) AS count FROM pages
WHERE list_contains({_SQL_TOKENS.format(c='html')}, 'script')""")
def q_word_search_pages(spark, sf):
    return word_search(table(spark, sf, "pages"), "script", "html", "page_id", per="id")


@register("word_search_documents_zero", f"""
SELECT count(DISTINCT doc_id) AS count FROM documents
WHERE list_contains({_SQL_TOKENS.format(c='text')}, 'zzzzzzzz')""")
def q_word_search_zero(spark, sf):
    # no document has the word: one row with 0
    return word_search(table(spark, sf, "documents"), "zzzzzzzz", "text", "doc_id", per="id")


# --- C3-C5 primes ------------------------------------------------------------

def _sql_top_primes(tbl: str, col: str, max_sql: str, k: int = 100) -> str:
    return f"""
WITH ds AS (
  SELECT d FROM generate_series(3, CAST(floor(sqrt({max_sql})) AS BIGINT), 2) t(d)
  WHERE NOT EXISTS (SELECT 1 FROM generate_series(3, CAST(floor(sqrt(d)) AS BIGINT), 2) u(e)
                    WHERE d % e = 0))
SELECT {col} AS value FROM {tbl} n
WHERE {col} = 2 OR ({col} > 2 AND {col} % 2 = 1
      AND NOT EXISTS (SELECT 1 FROM ds WHERE d < n.{col} AND n.{col} % d = 0))
ORDER BY {col} DESC LIMIT {k}"""


@register("top_primes_orders", _sql_top_primes("orders", "o_orderkey",
                                               "(SELECT max(o_orderkey) FROM orders)"))
def q_top_primes_orders(spark, sf):
    return top_primes(table(spark, sf, "orders"), "o_orderkey", 100).select(
        F.col("o_orderkey").alias("value"))


@register("top_primes_lineitem", _sql_top_primes("lineitem", "l_orderkey",
                                                 "(SELECT max(l_orderkey) FROM lineitem)"))
def q_top_primes_lineitem(spark, sf):
    return top_primes(table(spark, sf, "lineitem"), "l_orderkey", 100).select(
        F.col("l_orderkey").alias("value"))


@register("top_primes_capped_partkey", _sql_top_primes("lineitem", "l_partkey", "400"))
def q_top_primes_capped(spark, sf):
    # explicit max_number: values above it pass when no odd prime <= 20 divides them
    return top_primes(table(spark, sf, "lineitem"), "l_partkey", 100, max_number=400).select(
        F.col("l_partkey").alias("value"))


@register("prime_filter_lineitem", """
WITH ds AS (
  SELECT d FROM generate_series(3, CAST(floor(sqrt((SELECT max(l_orderkey) FROM lineitem)))
                                         AS BIGINT), 2) t(d)
  WHERE NOT EXISTS (SELECT 1 FROM generate_series(3, CAST(floor(sqrt(d)) AS BIGINT), 2) u(e)
                    WHERE d % e = 0))
SELECT l_orderkey AS value, l_linenumber FROM lineitem n
WHERE l_orderkey = 2 OR (l_orderkey > 2 AND l_orderkey % 2 = 1
      AND NOT EXISTS (SELECT 1 FROM ds WHERE d < n.l_orderkey AND n.l_orderkey % d = 0))""")
def q_prime_filter_lineitem(spark, sf):
    # C3 over every row (duplicates kept): the order lines whose order key is prime
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return prime_filter(li, "l_orderkey").select(F.col("l_orderkey").alias("value"),
                                                 "l_linenumber")


@register("odd_primes_upto_max_orderkey", """
SELECT o_orderkey AS p FROM (SELECT DISTINCT o_orderkey FROM orders) o
WHERE o_orderkey >= 3 AND o_orderkey % 2 = 1
  AND NOT EXISTS (SELECT 1 FROM generate_series(3, CAST(floor(sqrt((SELECT max(o_orderkey) FROM orders))) AS BIGINT), 2) u(e)
                  WHERE e < o_orderkey AND o_orderkey % e = 0)""")
def q_primes_upto(spark, sf):
    # the order keys of the table that the prime table holds
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("p"))
    mx = keys.agg(F.max("p")).first()[0]
    return odd_primes_upto(spark, int(mx or 0)).join(keys, "p", "left_semi")


# --- G8, G1, G3 profile and counts -------------------------------------------

def _sql_profile(tbl: str, col: str) -> str:
    return f"""
WITH s AS (SELECT count({col}) AS n, avg({col}) AS mean, stddev_samp({col}) AS sd,
                  min({col}) AS mn, max({col}) AS mx,
                  quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS q2,
                  quantile_cont({col}, 0.75) AS q3 FROM {tbl})
SELECT statistic, round(value, 6) AS value FROM (
  SELECT 'count' AS statistic, CAST(n AS DOUBLE) AS value FROM s UNION ALL
  SELECT 'mean', mean FROM s UNION ALL SELECT 'stddev', sd FROM s UNION ALL
  SELECT 'min', CAST(mn AS DOUBLE) FROM s UNION ALL SELECT '25%', q1 FROM s UNION ALL
  SELECT '50%', q2 FROM s UNION ALL SELECT '75%', q3 FROM s UNION ALL
  SELECT 'max', CAST(mx AS DOUBLE) FROM s)"""


@register("profile_n_chars", _sql_profile("documents", "n_chars"))
def q_profile_n_chars(spark, sf):
    return profile(table(spark, sf, "documents"), "n_chars").select(
        "statistic", F.round("value", 6).alias("value"))


@register("profile_extendedprice", _sql_profile("lineitem", "l_extendedprice"))
def q_profile_price(spark, sf):
    return profile(table(spark, sf, "lineitem"), "l_extendedprice").select(
        "statistic", F.round("value", 6).alias("value"))


@register("count_by_lang", """
SELECT lang, count(*) AS count FROM documents GROUP BY lang ORDER BY count DESC, lang""")
def q_count_by_lang(spark, sf):
    return count_by(table(spark, sf, "documents"), "lang")


@register("count_by_lang_quality", """
SELECT d.lang, l.quality, count(*) AS count FROM documents d JOIN labels l USING (doc_id)
GROUP BY d.lang, l.quality ORDER BY d.lang""")
def q_count_by_lang_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return count_by(docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"),
                    "lang", "quality", order=False).orderBy("lang")


# --- D1-D10 k-medoids ----------------------------------------------------------

from lodestone.functions.sampling import hash_fraction  # noqa: E402
from lodestone.operators.kmedoids import (  # noqa: E402
    _distance_to, assign, medoid_rows, initial_assignment, k_medoids, pick_medoids, prepare_points,
    update_medoids)
from lodestone.operators.ranks import percent_rank_filter  # noqa: E402

# DuckDB: unit vectors of the embeddings (zero stays zero) and the md5 pick of k medoids.
_SQL_UNIT = """
units AS (
  SELECT vec_id, label, CASE WHEN nrm > 0 THEN list_transform(v, lambda x: x / nrm)
                        ELSE list_transform(v, lambda x: 0.0) END AS u
  FROM (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm
        FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)))"""


def _sql_pick(k: int, seed: int = 42) -> str:
    return f"""
picked AS (SELECT vec_id AS medoid_id, u AS mu FROM units
           ORDER BY md5(CAST(vec_id AS VARCHAR) || ':{seed}'), vec_id LIMIT {k})"""


def _points(spark, sf):
    return prepare_points(table(spark, sf, "embeddings"), "vec_id", "embedding")


def _picked(points, k, seed=42):
    return medoid_rows(pick_medoids(points, k, seed))


@register("kmedoids_pick", f"""
WITH {_SQL_UNIT}, {_sql_pick(5)} SELECT medoid_id AS vec_id FROM picked""")
def q_km_pick(spark, sf):
    return pick_medoids(_points(spark, sf), 5, 42).select(F.col("id").alias("vec_id"))


_SQL_ASSIGN = f"""
WITH {_SQL_UNIT}, {_sql_pick(10)},
d AS (SELECT units.vec_id, picked.medoid_id,
             round(1 - list_dot_product(units.u, picked.mu), 12) AS dist
      FROM units CROSS JOIN picked),
a AS (SELECT vec_id, arg_min(medoid_id, (dist, medoid_id)) AS medoid_id, min(dist) AS dist
      FROM d GROUP BY vec_id)"""


@register("kmedoids_assign", _SQL_ASSIGN + """
SELECT vec_id, medoid_id, round(dist, 6) + 0.0 AS dist FROM a""")
def q_km_assign(spark, sf):
    pts = _points(spark, sf)
    return assign(pts, _picked(pts, 10)).select(
        F.col("id").alias("vec_id"), "medoid_id", F.round("dist", 6).alias("dist"))


_SQL_PAIRWISE_BY_LABEL = f"""
WITH {_SQL_UNIT},
s AS (SELECT a.label, a.vec_id, sum(1 - list_dot_product(a.u, b.u)) AS s
      FROM units a JOIN units b ON a.label = b.label GROUP BY a.label, a.vec_id)
SELECT label, arg_min(vec_id, (round(s, 9), vec_id)) AS medoid_id, round(min(s), 6) AS s
FROM s GROUP BY label"""


@register("kmedoids_update_by_label", _SQL_PAIRWISE_BY_LABEL)
def q_km_update(spark, sf):
    pts = prepare_points(table(spark, sf, "embeddings"), "vec_id", "embedding", keep=("label",))
    return update_medoids(pts).select("label", "medoid_id", F.round("s", 6).alias("s"))


@register("kmedoids_one_pass", _SQL_ASSIGN + """,
j AS (SELECT a.medoid_id AS label, x.vec_id, x.u FROM a JOIN units x USING (vec_id)),
s AS (SELECT p.label, p.vec_id, sum(1 - list_dot_product(p.u, q.u)) AS s
      FROM j p JOIN j q ON p.label = q.label GROUP BY p.label, p.vec_id)
SELECT label, arg_min(vec_id, (round(s, 9), vec_id)) AS medoid_id, round(min(s), 6) AS s
FROM s GROUP BY label""")
def q_km_one_pass(spark, sf):
    pts = _points(spark, sf)
    return update_medoids(assign(pts, _picked(pts, 10))).select(
        "label", "medoid_id", F.round("s", 6).alias("s"))


@register("kmedoids_sample", """
SELECT vec_id FROM embeddings
WHERE substr(md5(CAST(vec_id AS VARCHAR) || ':42:1:reassign'), 1, 8) < '33333333'""")
def q_km_sample(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id"))
    return e.where(hash_fraction("vec_id", 0.2, 42, 1, "reassign"))


@register("kmedoids_initial_mod", f"""
WITH {_SQL_UNIT}, {_sql_pick(5)},
m AS (SELECT medoid_id, row_number() OVER (ORDER BY medoid_id) - 1 AS slot FROM picked)
SELECT units.vec_id, m.medoid_id FROM units JOIN m ON units.vec_id % 5 = m.slot""")
def q_km_initial_mod(spark, sf):
    pts = _points(spark, sf)
    return initial_assignment(pts, _picked(pts, 5), 5, "mod").select(
        F.col("id").alias("vec_id"), "medoid_id")


def _dist_to_label_first(spark, sf):
    """Distance (6 places) of each embedding to the first vector of its label."""
    pts = prepare_points(table(spark, sf, "embeddings"), "vec_id", "embedding", keep=("label",))
    # one reference vector per label: k rows back, size-checked, then a per-row lookup
    firsts = pts.groupBy("label").agg(F.min(F.struct("id", "v")).alias("m")).select(
        "label", "m.id", "m.v")
    refs = medoid_rows(firsts, label_col="label")
    return pts.select(F.col("id").alias("vec_id"), "label",
                      (F.round(_distance_to("v", "label", refs, spark, None), 6) + 0.0)
                      .alias("dist"))


_SQL_DIST_FIRST = f"""
WITH {_SQL_UNIT},
f AS (SELECT label, arg_min(u, vec_id) AS mu FROM units GROUP BY label),
d AS (SELECT units.vec_id, units.label, round(1 - list_dot_product(units.u, f.mu), 6) + 0.0 AS dist
      FROM units JOIN f USING (label))"""


@register("kmedoids_worst_points", _SQL_DIST_FIRST + """
SELECT vec_id, label, dist FROM (
  SELECT *, percent_rank() OVER (PARTITION BY label ORDER BY dist DESC) AS pr FROM d)
WHERE pr <= 0.2""")
def q_km_worst(spark, sf):
    return percent_rank_filter(_dist_to_label_first(spark, sf), ["label"], "dist", 0.2, True)


@register("kmedoids_core_points", _SQL_DIST_FIRST + """
SELECT vec_id, label, dist FROM (
  SELECT *, percent_rank() OVER (PARTITION BY label ORDER BY dist) AS pr FROM d)
WHERE pr <= 0.3""")
def q_km_core(spark, sf):
    return percent_rank_filter(_dist_to_label_first(spark, sf), ["label"], "dist", 0.3, False)


def _km_run(variant: str, k: int = 8):
    def run(spark, sf):
        res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", k, variant, seed=42)
        return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                      F.round("dist", 6).alias("dist"), F.lit(res.converged).alias("converged"))
    return run


for _v in ("base", "improved", "local", "sampling", "smart_sampling"):
    register(f"kmedoids_{_v}")(_km_run(_v))


# --- M1-M10 classifier ---------------------------------------------------------

from lodestone.operators.model import (  # noqa: E402
    evaluate, fit_and_score, fit_features, fold_of, hash_split, prediction_breakdown, string_index, tune)

# Stand-in for the census table: documents with their quality label.
_CATEGORICAL = ["lang", "source"]
_NUMERIC = ["n_chars"]
_LABEL = "quality"


def _labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


def _sql_index(col: str) -> str:
    return f"""
SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS {col}_index
FROM documents JOIN labels USING (doc_id) WHERE {col} IS NOT NULL GROUP BY {col}"""


@register("ml_index_lang", _sql_index("lang"))
def q_ml_index_lang(spark, sf):
    return string_index(_labelled(spark, sf), "lang")


@register("ml_index_source", _sql_index("source"))
def q_ml_index_source(spark, sf):
    return string_index(_labelled(spark, sf), "source")


@register("ml_hash_split", """
SELECT CASE WHEN substr(md5(CAST(doc_id AS VARCHAR) || ':42:split'), 1, 8) < 'cccccccc'
            THEN 'train' ELSE 'test' END AS part, count(*) AS count
FROM documents JOIN labels USING (doc_id) GROUP BY part""")
def q_ml_split(spark, sf):
    part = F.when(hash_fraction("doc_id", 0.8, 42, "split"), "train").otherwise("test")
    return _labelled(spark, sf).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("count"))


@register("ml_predictions")
def q_ml_predictions(spark, sf):
    train, test = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    _, ev = fit_and_score(train, test, _CATEGORICAL, _NUMERIC, _LABEL)
    return ev.predictions.select("doc_id", "quality", "label", F.round("score", 6).alias("score"), "prediction")


@register("ml_cv_breakdown_by_lang")
def q_ml_cv(spark, sf):
    train, test = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    model = tune(train, _CATEGORICAL, _NUMERIC, _LABEL, id_col="doc_id")
    return prediction_breakdown(model.transform(test), "lang")


@register("ml_cv_grid")
def q_ml_cv_grid(spark, sf):
    """Mean AUC over the folds of every grid point."""
    train, _ = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    grid = tune(train, _CATEGORICAL, _NUMERIC, _LABEL, id_col="doc_id").grid
    return spark.createDataFrame([(r, e, round(a, 4)) for r, e, a in grid], "reg_param double, elastic_net double, auc double")


_SQL_HEX8 = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42:{what}'), 1, 8) AS BIGINT)"


@register("ml_fold_sizes", f"""
SELECT CAST(floor({_SQL_HEX8.format(what='fold')} * 3 / 4294967296.0) AS INTEGER) AS fold, quality, count(*) AS count
FROM documents JOIN labels USING (doc_id)
WHERE substr(md5(CAST(doc_id AS VARCHAR) || ':42:split'), 1, 8) < 'cccccccc' GROUP BY fold, quality""")
def q_ml_folds(spark, sf):
    train, _ = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    return (train.groupBy(fold_of("doc_id").alias("fold"), "quality").agg(F.count(F.lit(1)).alias("count")))


@register("ml_index_url", """
SELECT url, CAST(row_number() OVER (ORDER BY count(*) DESC, url) - 1 AS DOUBLE) AS url_index
FROM pages WHERE url IS NOT NULL GROUP BY url""")
def q_ml_index_url(spark, sf):
    return string_index(table(spark, sf, "pages"), "url")


# one-hot slots and the numeric column, as (place, value) of every row's feature vector
@register("ml_features", """
WITH j AS (SELECT doc_id, lang, source, n_chars, quality FROM documents JOIN labels USING (doc_id)),
li AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS i FROM j WHERE lang IS NOT NULL GROUP BY lang),
si AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS i FROM j WHERE source IS NOT NULL GROUP BY source),
n AS (SELECT (SELECT count(*) FROM li) AS nl, (SELECT count(*) FROM si) AS ns),
f AS (SELECT doc_id, coalesce(li.i, nl) AS place, 1.0 AS value FROM j CROSS JOIN n LEFT JOIN li USING (lang)
  UNION ALL SELECT doc_id, nl + 1 + coalesce(si.i, ns), 1.0 FROM j CROSS JOIN n LEFT JOIN si USING (source)
  UNION ALL SELECT doc_id, nl + ns + 2, CAST(n_chars AS DOUBLE) FROM j CROSS JOIN n WHERE n_chars <> 0)
SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(value AS DOUBLE) AS value FROM f""")
def q_ml_features(spark, sf):
    rows = _labelled(spark, sf)
    ready = fit_features(rows, _CATEGORICAL, _NUMERIC, _LABEL).transform(rows)
    return (ready.select("doc_id", F.posexplode(vector_to_array("features")).alias("place", "value")).where("value <> 0"))


# Fixed-pass runs of the loop, whose result SQL can state. Two passes of the
# full re-assignment variants always run (the first test compares with
# +infinity, the second with the largest double); one pass of the sampling ones.

def _sql_nearest(src: str, med: str, out: str) -> str:
    """nearest medoid of each unit vector: label, medoid id, distance."""
    key = f"(round(1 - list_dot_product({src}.u, {med}.mu), 12), {med}.medoid_id)"
    return f"""
{out} AS (SELECT {src}.vec_id, arg_min({med}.lab, {key}) AS lab,
                 arg_min({med}.medoid_id, {key}) AS medoid_id,
                 min(round(1 - list_dot_product({src}.u, {med}.mu), 12)) AS dist
          FROM units {src} CROSS JOIN {med} GROUP BY {src}.vec_id)"""


def _sql_update(assigned: str, out: str) -> str:
    """pairwise medoid per cluster, with its vector."""
    return f"""
{out}_j AS (SELECT a.lab, x.vec_id, x.u FROM {assigned} a JOIN units x USING (vec_id)),
{out}_s AS (SELECT p.lab, p.vec_id, sum(1 - list_dot_product(p.u, q.u)) AS s
            FROM {out}_j p JOIN {out}_j q ON p.lab = q.lab GROUP BY p.lab, p.vec_id),
{out}_m AS (SELECT lab, arg_min(vec_id, (round(s, 9), vec_id)) AS medoid_id
            FROM {out}_s GROUP BY lab),
{out} AS (SELECT m.lab, m.medoid_id, x.u AS mu FROM {out}_m m JOIN units x ON x.vec_id = m.medoid_id)"""


_SQL_KM_FINAL = """
SELECT vec_id, lab AS label, medoid_id, round(dist, 6) + 0.0 AS dist FROM {src}"""


@register("kmedoids_improved_two_passes", f"""
WITH {_SQL_UNIT}, {_sql_pick(8)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu FROM picked),
{_sql_nearest('x', 'm0', 'a1')},
{_sql_update('a1', 'm1')},
{_sql_nearest('x', 'm1', 'a2')},
{_sql_update('a2', 'm2')},
{_sql_nearest('x', 'm2', 'a3')}
""" + _SQL_KM_FINAL.format(src="a3"))
def q_km_improved_two(spark, sf):
    res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, "improved",
                    max_iter=2, seed=42)
    return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                  (F.round("dist", 6) + 0.0).alias("dist"))


# first hex digit of md5(id:42:init) // 2 = floor(h * 8 / 2**32): the md5 bucket for k = 8
_SQL_SAMPLING_ONE = f"""
WITH {_SQL_UNIT}, {_sql_pick(8)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu,
              row_number() OVER (ORDER BY medoid_id) - 1 AS slot FROM picked),
init AS (SELECT x.vec_id, m0.lab, m0.medoid_id,
                round(1 - list_dot_product(x.u, m0.mu), 12) AS dist
         FROM units x JOIN m0 ON m0.slot = {{slot}}),
{_sql_nearest('x', 'm0', 'near')},
sel AS (SELECT vec_id FROM {{selected}}),
merged AS (
  SELECT i.vec_id,
         CASE WHEN s.vec_id IS NULL THEN i.lab ELSE n.lab END AS lab,
         CASE WHEN s.vec_id IS NULL THEN i.medoid_id ELSE n.medoid_id END AS medoid_id,
         CASE WHEN s.vec_id IS NULL THEN i.dist ELSE n.dist END AS dist
  FROM init i JOIN near n USING (vec_id) LEFT JOIN sel s USING (vec_id))
""" + _SQL_KM_FINAL.format(src="merged")


@register("kmedoids_sampling_one_pass", _SQL_SAMPLING_ONE.format(
    slot="(instr('0123456789abcdef', substr(md5(CAST(x.vec_id AS VARCHAR) || ':42:init'), 1, 1))"
         " - 1) // 2",
    selected="units WHERE substr(md5(CAST(vec_id AS VARCHAR) || ':42:1:reassign'), 1, 8)"
             " < '33333333'"))
def q_km_sampling_one(spark, sf):
    res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, "sampling",
                    max_iter=1, seed=42)
    return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                  (F.round("dist", 6) + 0.0).alias("dist"))


@register("kmedoids_smart_one_pass", _SQL_SAMPLING_ONE.format(
    slot="x.vec_id % 8",
    selected="(SELECT vec_id, percent_rank() OVER (PARTITION BY lab ORDER BY dist DESC) AS pr"
             " FROM init) WHERE pr <= 0.2"))
def q_km_smart_one(spark, sf):
    res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, "smart_sampling",
                    max_iter=1, seed=42)
    return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                  (F.round("dist", 6) + 0.0).alias("dist"))


_SQL_TRAIN = """(SELECT * FROM documents JOIN labels USING (doc_id)
  WHERE substr(md5(CAST(doc_id AS VARCHAR) || ':42:split'), 1, 8) < 'cccccccc')"""


@register("ml_profile_train_n_chars", _sql_profile(_SQL_TRAIN, "n_chars"))
def q_ml_profile_train(spark, sf):
    train, _ = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    return profile(train, "n_chars").select("statistic", F.round("value", 6).alias("value"))


@register("ml_count_train_by_source", f"""
SELECT source, count(*) AS count FROM {_SQL_TRAIN} t GROUP BY source""")
def q_ml_count_train(spark, sf):
    train, _ = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    return count_by(train, "source")


@register("ml_breakdown_by_n_chars")
def q_ml_breakdown_n_chars(spark, sf):
    train, test = hash_split(_labelled(spark, sf), "doc_id", 0.8, 42)
    _, ev = fit_and_score(train, test, _CATEGORICAL, _NUMERIC, _LABEL)
    return prediction_breakdown(ev.predictions, "n_chars")


@register("kmedoids_base_two_passes", f"""
WITH {_SQL_UNIT}, {_sql_pick(8)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu FROM picked),
{_sql_nearest('x', 'm0', 'a1')},
{_sql_update('a1', 'm1r')},
m1 AS (SELECT medoid_id AS lab, medoid_id, mu FROM m1r),
{_sql_nearest('x', 'm1', 'a2')},
{_sql_update('a2', 'm2r')},
m2 AS (SELECT medoid_id AS lab, medoid_id, mu FROM m2r),
{_sql_nearest('x', 'm2', 'a3')}
""" + _SQL_KM_FINAL.format(src="a3"))
def q_km_base_two(spark, sf):
    # base renames each cluster after its medoid every pass
    res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, "base",
                    max_iter=2, seed=42)
    return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                  (F.round("dist", 6) + 0.0).alias("dist"))


@register("kmedoids_local_one_pass", f"""
WITH {_SQL_UNIT}, {_sql_pick(8)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu FROM picked),
{_sql_nearest('x', 'm0', 'a1')},
{_sql_update('a1', 'm1')},
{_sql_nearest('x', 'm1', 'a2')}
""" + _SQL_KM_FINAL.format(src="a2"))
def q_km_local_one(spark, sf):
    # one pass always runs (the first test compares with +infinity)
    res = k_medoids(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, "local",
                    max_iter=1, seed=42)
    return res.assignments.select(F.col("id").alias("vec_id"), "label", "medoid_id",
                                  (F.round("dist", 6) + 0.0).alias("dist"))


# --- metrics of a rule SQL can state (M6, M7, M10) ------------------------------

_RULE = "CASE WHEN n_chars >= 1000 THEN 1.0 ELSE 0.0 END"


def _rule_predictions(spark, sf):
    """Score n_chars, prediction n_chars >= 1000, label quality."""
    return _labelled(spark, sf).select(
        "doc_id", "lang", F.col("quality").cast("double").alias("label"),
        F.col("n_chars").cast("double").alias("score"),
        F.when(F.col("n_chars") >= 1000, 1.0).otherwise(0.0).alias("prediction"))


@register("ml_metrics_of_length", f"""
WITH p AS (SELECT CAST(quality AS DOUBLE) AS label, n_chars, {_RULE} AS prediction
           FROM documents JOIN labels USING (doc_id)),
r AS (SELECT label, prediction, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS rk FROM p)
SELECT round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2)
             / (sum(label) * (count(*) - sum(label))), 6) AS auc,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM r""")
def q_ml_metrics(spark, sf):
    ev = evaluate(_rule_predictions(spark, sf))
    return spark.createDataFrame([(round(ev.auc, 6), round(ev.accuracy, 6))], "auc double, accuracy double")


@register("ml_breakdown_of_length", f"""
SELECT lang, {_RULE} AS prediction, count(*) AS count
FROM documents JOIN labels USING (doc_id) GROUP BY lang, prediction""")
def q_ml_breakdown_rule(spark, sf):
    return prediction_breakdown(_rule_predictions(spark, sf), "lang")


# --- refinement passes on whole tables, forced by a small limit ------------------

@register("profile_extendedprice_refined", _sql_profile("lineitem", "l_extendedprice"))
def q_profile_refined(spark, sf):
    return profile(table(spark, sf, "lineitem"), "l_extendedprice", exact_limit=50).select(
        "statistic", F.round("value", 6).alias("value"))


@register("worst_order_prices_refined", """
SELECT o_orderkey, o_orderpriority FROM (
  SELECT *, percent_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS pr FROM orders)
WHERE pr <= 0.2""")
def q_worst_prices(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return percent_rank_filter(orders, ["o_orderpriority"], "o_totalprice", 0.2, True, exact_limit=50).drop("o_totalprice")


# --- k-medoids on vectors whose medoids move: three numbers of each part ---------

_SQL_PART_UNIT = """
units AS (
  SELECT vec_id, list_transform(v, lambda x: x / nrm) AS u
  FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm
        FROM (SELECT p_partkey AS vec_id, [CAST(p_size AS DOUBLE), CAST(p_retailprice AS DOUBLE) / 50,
                                           CAST(p_partkey % 23 AS DOUBLE)] AS v FROM part)))"""

_SQL_PART_TWO = f"""
WITH {_SQL_PART_UNIT}, {_sql_pick(6)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu FROM picked),
{_sql_nearest('x', 'm0', 'a1')},
{_sql_update('a1', 'm1')},
{_sql_nearest('x', 'm1', 'a2')},
{_sql_update('a2', 'm2')}
"""


def _part_run(spark, sf, variant="improved"):
    part = table(spark, sf, "part").select("p_partkey", F.array(
        F.col("p_size").cast("double"), F.col("p_retailprice").cast("double") / 50,
        (F.col("p_partkey") % 23).cast("double")).alias("v"))
    return k_medoids(part, "p_partkey", "v", 6, variant, max_iter=2, seed=42)


@register("kmedoids_part_trace", _SQL_PART_TWO + """
SELECT 1 AS iteration, round(sum(s), 6) AS cost FROM (SELECT lab, min(s) AS s FROM m1_s GROUP BY lab)
UNION ALL SELECT 2, round(sum(s), 6) FROM (SELECT lab, min(s) AS s FROM m2_s GROUP BY lab)""")
def q_km_part_trace(spark, sf):
    return _part_run(spark, sf).trace.select("iteration", F.round("cost", 6).alias("cost"))


@register("kmedoids_part_medoids", _SQL_PART_TWO + "SELECT lab AS label, medoid_id FROM m2")
def q_km_part_medoids(spark, sf):
    return _part_run(spark, sf).medoids


# --- two passes of the sampling variants, whose medoids move on these vectors -----

def _sql_sampling_pass(it: int, variant: str) -> str:
    """State s<it-1> (vec_id, lab, medoid_id, dist) and medoids m<it-1> -> s<it>, m<it>, cost c<it>."""
    a, b = it - 1, it
    if variant == "sampling":
        now = f"n{b} AS (SELECT * FROM s{a})"
        selected = f"SELECT vec_id FROM n{b} WHERE substr(md5(CAST(vec_id AS VARCHAR) || ':42:{b}:reassign'), 1, 8) < '33333333'"
        core = f"SELECT * FROM s{b} WHERE substr(md5(CAST(vec_id AS VARCHAR) || ':42:{b}:update'), 1, 8) < '33333333'"
    else:
        now = f"""n{b} AS (SELECT s.vec_id, s.lab, m.medoid_id, round(1 - list_dot_product(x.u, m.mu), 12) AS dist
              FROM s{a} s JOIN m{a} m USING (lab) JOIN units x USING (vec_id))"""
        selected = f"""SELECT vec_id FROM (SELECT vec_id, percent_rank() OVER (PARTITION BY lab ORDER BY dist DESC) AS pr
              FROM n{b}) WHERE pr <= 0.2"""
        core = f"""SELECT vec_id, lab FROM (SELECT vec_id, lab, percent_rank() OVER (PARTITION BY lab ORDER BY dist) AS pr
              FROM s{b}) WHERE pr <= 0.3"""
    return f"""
{now},
{_sql_nearest('x', f'm{a}', f'near{b}')},
sel{b} AS ({selected}),
s{b} AS (SELECT n.vec_id, CASE WHEN l.vec_id IS NULL THEN n.lab ELSE r.lab END AS lab,
                CASE WHEN l.vec_id IS NULL THEN n.medoid_id ELSE r.medoid_id END AS medoid_id,
                CASE WHEN l.vec_id IS NULL THEN n.dist ELSE r.dist END AS dist
         FROM n{b} n JOIN near{b} r USING (vec_id) LEFT JOIN sel{b} l USING (vec_id)),
c{b} AS (SELECT sum(dist) AS cost FROM s{b}),
core{b} AS ({core}),
{_sql_update(f'core{b}', f'u{b}')},
m{b} AS (SELECT m.lab, coalesce(u.medoid_id, m.medoid_id) AS medoid_id, coalesce(u.mu, m.mu) AS mu
         FROM m{a} m LEFT JOIN u{b} u USING (lab))"""


def _sql_sampling_two(variant: str) -> str:
    slot = "floor(CAST('0x' || substr(md5(CAST(x.vec_id AS VARCHAR) || ':42:init'), 1, 8) AS BIGINT) / 4294967296.0 * 6)" \
        if variant == "sampling" else "x.vec_id % 6"
    return f"""
WITH {_SQL_PART_UNIT}, {_sql_pick(6)},
m0 AS (SELECT medoid_id AS lab, medoid_id, mu FROM picked),
places AS (SELECT *, row_number() OVER (ORDER BY medoid_id) - 1 AS slot FROM m0),
s0 AS (SELECT x.vec_id, p.lab, p.medoid_id, round(1 - list_dot_product(x.u, p.mu), 12) AS dist
       FROM units x JOIN places p ON p.slot = {slot}),
{_sql_sampling_pass(1, variant)},
{_sql_sampling_pass(2, variant)}
"""


_SQL_PASS_COSTS = """
SELECT 1 AS iteration, round(cost, 6) AS cost FROM c1 UNION ALL SELECT 2, round(cost, 6) FROM c2"""


def _sampling_two(variant: str) -> None:
    sql = _sql_sampling_two(variant)
    short = variant.replace("_sampling", "")

    @register(f"kmedoids_{short}_two_passes", sql + """
SELECT vec_id, lab AS label, medoid_id, round(dist, 6) + 0.0 AS dist FROM s2""")
    def rows(spark, sf):
        return _part_run(spark, sf, variant).assignments.select(
            F.col("id").alias("vec_id"), "label", "medoid_id", (F.round("dist", 6) + 0.0).alias("dist"))

    @register(f"kmedoids_{short}_two_pass_medoids", sql + "SELECT lab AS label, medoid_id FROM m2")
    def medoids(spark, sf):
        return _part_run(spark, sf, variant).medoids

    @register(f"kmedoids_{short}_two_pass_trace", sql + _SQL_PASS_COSTS)
    def trace(spark, sf):
        return _part_run(spark, sf, variant).trace.select("iteration", F.round("cost", 6).alias("cost"))


for _v in ("sampling", "smart_sampling"):
    _sampling_two(_v)


# --- sources and sinks: a table written, read back and returned (S1-S5, K1-K3, F12) ---------

from lodestone.operators.primes import parse_integers  # noqa: E402
from lodestone.sources import files  # noqa: E402
from lodestone.sources.shared import shared_path  # noqa: E402


@register("io_csv_round_trip", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def q_io_csv(spark, sf):
    path = shared_path(spark, "io-csv")
    files.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    return files.read_csv_ddl(spark, path, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string", trim=False)


@register("io_lines_round_trip", "SELECT o_orderkey AS value FROM orders")
def q_io_lines(spark, sf):
    path = shared_path(spark, "io-lines")
    files.write_lines(table(spark, sf, "orders").select("o_orderkey"), path)
    return parse_integers(files.read_lines(spark, path), "value", "long")


@register("io_json_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, text FROM documents")
def q_io_json(spark, sf):
    path = shared_path(spark, "io-json")
    docs = table(spark, sf, "documents")
    files.write_json_lines(docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), "text"), path)
    return files.read_json_documents(spark, path, multiline=False)


@register("io_tsv_round_trip", f"""
SELECT word, count(*) AS count FROM (
  SELECT unnest({_SQL_TOKENS.format(c='text')}) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def q_io_tsv(spark, sf):
    path = shared_path(spark, "io-tsv")
    files.write_tsv(word_count(table(spark, sf, "documents"), "text"), path)
    return spark.read.schema("word string, count long").option("sep", "\t").csv(path)


@register("io_vector_row_ids", """
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS id, CAST(p_partkey AS DOUBLE) AS a, CAST(p_size AS DOUBLE) AS b FROM part""")
def q_io_row_ids(spark, sf):
    path = shared_path(spark, "io-vectors")
    files.write_csv(table(spark, sf, "part").select("p_partkey", "p_size").repartitionByRange("p_partkey").sortWithinPartitions("p_partkey"), path)
    rows = files.read_vectors_csv(spark, path, "a double, b double")
    return rows.select("id", F.col("vector")[0].alias("a"), F.col("vector")[1].alias("b"))
