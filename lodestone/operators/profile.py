"""Column profile (G8), counts per key (G1, G3) with sort (T4)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators import ranks as R

# The statistics of a profile, in the order Spark's summary() lists them.
PROFILE_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)


def profile(df: DataFrame, col: str, exact: bool = True, exact_limit: int | None = None) -> DataFrame:
    """``(statistic string, value double)``: count, mean, sample stddev, min,
    quartiles, max of the non-null values of ``col``.

    ``exact=True``: one aggregate over the column (which also caches its slim
    copy), then the order statistics around each quartile position by range
    refinement over that copy, interpolated as ``percentile`` /
    ``quantile_cont`` do; the column is never gathered in one task.
    ``exact=False`` uses ``percentile_approx`` as ``DataFrame.summary()`` does.
    """
    spark = df.sparkSession
    slim = R._slim(df.select(F.lit(0).alias("_g"), col), ["_g"], col)
    kind = slim.schema["_v"].dataType
    try:
        # one aggregate: the plain statistics, and the ends that the order statistics start from
        base = slim.agg(
            F.mean("_v").alias("mean"), F.stddev_samp("_v").alias("stddev"), F.min("_v").alias("min"),
            F.max("_v").alias("max"), *R._ends(kind),
            *([] if exact else [F.percentile_approx("_v", list(QUARTILES), 10000).alias("q")])
        ).first()
        n = base["n"]
        quarts: list[float | None]
        if not exact:
            quarts = list(base["q"]) if base["q"] is not None else [None] * 3
        elif n == 0:
            quarts = [None] * 3
        else:
            # positions (n-1)p, 0-based; the values at floor and ceil (1-based ranks)
            ranks = sorted({math.floor((n - 1) * p) + d for p in QUARTILES for d in (1, 2)
                            if math.floor((n - 1) * p) + d <= n})
            kinds = T.StructType([T.StructField("tid", T.LongType()), T.StructField("r", T.LongType()),
                                  T.StructField("n", T.LongType()), T.StructField("lo", kind), T.StructField("hi", kind),
                                  *(T.StructField(c, T.LongType()) for c in ("low", "high", "nan"))])
            ends = [base[c] for c in ("n", "lo", "hi", "low", "high", "nan")]
            targets = spark.createDataFrame([(r, r, *ends) for r in ranks], kinds).withColumn("_g", F.lit(0))
            got = R._resolve(slim, ["_g"], R._state(targets, kind), R.BUCKETS,
                             R.EXACT_LIMIT if exact_limit is None else exact_limit).collect()
            at = {r.tid: float(r.value) for r in got}
            quarts = []
            for p in QUARTILES:
                pos = (n - 1) * p
                lo = math.floor(pos)
                frac = pos - lo
                quarts.append((1 - frac) * at[lo + 1] + frac * at[lo + 2] if frac > 0
                              else at[lo + 1])
    finally:
        slim.unpersist()
    values = [None if x is None else float(x) for x in
              (n, base["mean"], base["stddev"], base["min"], *quarts, base["max"])]
    return spark.createDataFrame(list(zip(PROFILE_STATS, values)), "statistic string, value double")


def count_by(df: DataFrame, *keys: str, order: bool = True) -> DataFrame:
    """``(keys..., count long)`` sorted by count desc then keys (G1/G3 + T4)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.col("count").desc(), *keys) if order else out
