"""Exact per-group order statistics without sorting a group in one task.

Window functions partitioned by a group sort the whole group in one task; when
one group holds a third of the rows that task is the job. Here an order
statistic is found by range refinement instead:

1. per target (group, rank r) keep an interval [lo, hi] known to hold the r-th
   smallest value, and ``below`` = rows of the group under lo;
2. while an interval holds more than ``exact_limit`` rows, count its rows in
   ``buckets`` buckets (a partial aggregate: at most ``buckets`` rows per
   interval leave each task), run a count over the buckets of each interval and
   move every target to the bucket that its rank falls in. Buckets are of equal
   width, in turn in the value and in its signed logarithm, so heavy tails shrink
   too; the largest and smallest value of an interval never share a bucket in the
   former, so every second pass gains;
3. an interval that holds one value is resolved; the rest, at most
   ``exact_limit`` rows each, are ranked by a window partitioned by interval.

Targets, intervals and histograms are DataFrames all along, written to the shared
folder once a pass; the driver only learns how many targets are open, so any
number of groups works. Intervals join the rows as a table whose size Spark
knows: broadcast while it is small, shuffled (and split where skewed) beyond.

Integers are refined as bigint, decimals in their own type, the rest as double;
infinities and NaN (larger than all, as Spark orders it) are counted beforehand
and take the ranks at the ends. Bucketing is monotone in the value, so running
counts are exact, and each pass shrinks an interval about ``buckets``-fold.
Targets of one group share intervals until they part, and intervals of a group
never overlap, so every row is read once per pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.sources.shared import write_shared

BUCKETS = 4096
EXACT_LIMIT = 100_000


def _join_groups(left: DataFrame, right: DataFrame, g: list[str], how: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Join on the group columns with null-safe equality (a null group is a
    group, as in a window partition); keeps the left side's key columns."""
    la, ra = left.alias("_l"), right.alias("_r")
    keys = [*g, *extra]
    cond = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in keys]
    rest = [F.col(f"_r.{c}") for c in right.columns if c not in keys]
    return la.join(ra, cond, how).select("_l.*", *rest)


def _values(df: DataFrame, g: list[str], value_col: str) -> DataFrame:
    kind = df.schema[value_col].dataType
    to = "bigint" if isinstance(kind, T.IntegralType) else kind if isinstance(kind, T.DecimalType) else "double"
    return df.select(*g, F.col(value_col).cast(to).alias("_v")).where(F.col("_v").isNotNull())


def _slim(df: DataFrame, g: list[str], value_col: str) -> DataFrame:
    return _values(df, g, value_col).persist(StorageLevel.MEMORY_AND_DISK)


def _finite(v, kind) -> Column:
    """v when finite (always, for exact types), else null."""
    v = F.col(v) if isinstance(v, str) else v
    return F.when(F.abs(v) < F.lit(float("inf")), v) if isinstance(kind, T.DoubleType) else v


def _ends(kind) -> list[Column]:
    """Aggregates of ``_v``: n, lo, hi (finite) and the counts of -inf, inf and NaN."""
    v = _finite("_v", kind)
    if isinstance(kind, T.DoubleType):
        inf = float("inf")
        odd = [F.count_if(F.col("_v") == -inf).alias("low"), F.count_if(F.col("_v") == inf).alias("high"),
               F.count_if(F.isnan("_v")).alias("nan")]
    else:
        odd = [F.lit(0).cast("long").alias(c) for c in ("low", "high", "nan")]
    return [F.count("_v").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), *odd]


def _group_stats(slim: DataFrame, g: list[str]) -> DataFrame:
    return slim.groupBy(*g).agg(*_ends(slim.schema["_v"].dataType))


def _state(targets: DataFrame, kind) -> DataFrame:
    """targets: group columns, tid, r and the group's stats. Adds below and cnt; a target that is
    resolved has lo = hi, one outside [1, n] has neither."""
    finite = F.col("n") - F.col("low") - F.col("high") - F.col("nan")
    valid = (F.col("r") >= 1) & (F.col("r") <= F.col("n"))
    first, last = F.col("r") <= F.col("low"), F.col("r") > F.col("low") + finite

    def bound(c: str) -> Column:
        if not isinstance(kind, T.DoubleType):
            return F.when(valid, F.col(c)).alias(c)
        end = F.when(F.col("r") <= F.col("low") + finite + F.col("high"), F.lit(float("inf"))).otherwise(F.lit(float("nan")))
        return F.when(valid, F.when(first, F.lit(-float("inf"))).when(last, end).otherwise(F.col(c))).alias(c)

    keep = [c for c in targets.columns if c not in ("r", "n", "lo", "hi", "low", "high", "nan")]
    return targets.select(*keep, (F.col("r") - F.coalesce("low", F.lit(0))).alias("r"), bound("lo"), bound("hi"),
                          F.lit(0).cast("long").alias("below"), finite.alias("cnt"))


def _bucket(buckets: int, log: bool, kind) -> Column:
    """Bucket of ``_v`` in [lo, hi], not decreasing in ``_v``."""
    def real(c):
        x = F.col(c).cast("double")
        return F.signum(x) * F.log1p(F.abs(x)) if log else x / 2       # halves: no overflow of hi - lo

    share = (real("_v") - real("lo")) / F.nullif(real("hi") - real("lo"), F.lit(0.0))
    b = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1)).cast("int")
    if log or isinstance(kind, T.DoubleType):
        return b
    # exact types: close bounds may be one double, so their difference is taken exactly
    near = F.col("hi").cast("double") - F.col("lo").cast("double") < 2.0 ** 50
    step = F.floor((F.col("hi") - F.col("lo")).cast("decimal(38,18)") / buckets) + 1
    exact = F.floor((F.col("_v") - F.col("lo")).cast("decimal(38,18)") / step).cast("int") \
        if isinstance(kind, T.IntegralType) else b
    return F.when(near, exact).otherwise(b)


def _resolve(values: DataFrame, g: list[str], state: DataFrame, buckets: int, exact_limit: int,
             rows: int | None = None) -> DataFrame:
    """state: group columns, tid, r, lo, hi, below, cnt -> group columns, tid, value, written.
    ``rows``: how many rows there are, if known; few enough need no pass."""
    kind = values.schema["_v"].dataType
    span = (*g, "lo", "hi")

    def rows_in(targets: DataFrame) -> DataFrame:
        intervals = targets.select(*span).distinct()
        return _join_groups(values, intervals, g, "inner").where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))

    def answers(targets: DataFrame, value: str) -> DataFrame:
        return targets.select(*g, "tid", F.col(value).alias("value"))

    open_, big = F.coalesce(F.col("lo") < F.col("hi"), F.lit(False)), F.col("cnt") > exact_limit
    done, passes = [], 0
    while True:
        if rows is not None and rows <= exact_limit:
            seen = {"open": 1, "big": 0}
        else:
            state, seen = write_shared(state, "rank-targets", open=F.count_if(open_), big=F.count_if(open_ & big))
        done.append(answers(state.where(~open_), "lo"))
        if seen["open"] > seen["big"]:
            small = state.where(open_ & ~big)
            place = F.row_number().over(Window.partitionBy(*span).orderBy("_v"))
            ranked = rows_in(small).select(*span, "_v", place.cast("long").alias("_rn"))
            wanted = small.withColumn("_rn", F.col("r") - F.col("below"))
            done.append(answers(_join_groups(wanted, ranked, g, "inner", ("lo", "hi", "_rn")), "_v"))
        if not seen["big"]:
            break
        passes += 1
        wide = state.where(open_ & big)
        hist = (rows_in(wide).groupBy(*span, _bucket(buckets, passes % 2 == 0, kind).alias("_b"))
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
        # at most ``buckets`` rows in a window
        upto = F.sum("_c").over(Window.partitionBy(*span).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
        hist = hist.withColumn("_upto", upto)
        rank = F.col("r") - F.col("below")
        state = (_join_groups(wide, hist, g, "inner", ("lo", "hi"))
                 .where((rank > F.col("_upto") - F.col("_c")) & (rank <= F.col("_upto")))
                 .select(*g, "tid", "r", F.col("_mn").alias("lo"), F.col("_mx").alias("hi"),
                         (F.col("below") + F.col("_upto") - F.col("_c")).alias("below"), F.col("_c").alias("cnt")))
    return write_shared(reduce(DataFrame.unionByName, done), "rank-values")[0]


def order_statistics(df: DataFrame, group_cols: list[str], value_col: str, targets: DataFrame,
                     buckets: int | None = None, exact_limit: int | None = None) -> DataFrame:
    """``targets(group_cols..., tid, r)`` -> ``(group_cols..., tid, value)``: the
    r-th smallest non-null ``value_col`` of each group (1-based, ties counted).
    Targets with r outside [1, n] get a null value."""
    g = list(group_cols)
    if not g:  # one global group: a constant key keeps every join an equi-join
        return order_statistics(df.withColumn("_g", F.lit(0)), ["_g"], value_col,
                                targets.withColumn("_g", F.lit(0)), buckets, exact_limit).drop("_g")
    slim = _slim(df, g, value_col)
    try:
        wanted = targets.select(*g, F.col("tid").cast("long").alias("tid"), F.col("r").cast("long").alias("r"))
        state = _state(_join_groups(wanted, _group_stats(slim, g), g, "left"), slim.schema["_v"].dataType)
        return _resolve(slim, g, state, buckets or BUCKETS, exact_limit or EXACT_LIMIT)
    finally:
        slim.unpersist()


def _cut_rank(fraction: float, descending: bool) -> Column:
    """Ascending rank of the cut-off value of ``n`` rows: percent_rank = c/(n-1) with
    c = rows strictly ahead; i* - 1 = the largest c with c/(n-1) <= fraction,
    in the same double arithmetic as the window function."""
    others = (F.col("n") - 1).cast("double")
    near = F.floor(F.lit(float(fraction)) * others)
    ahead = (F.when((near + 1) / others <= fraction, near + 1).when(near / others <= fraction, near).otherwise(near - 1))
    ahead = F.when(F.col("n") <= 1, F.lit(0)).otherwise(F.least(F.greatest(ahead, F.lit(0)), F.col("n") - 1))
    return (F.col("n") - ahead if descending else ahead + 1).cast("long")


def percent_rank_threshold(df: DataFrame, group_cols: list[str], value_col: str,
                           fraction: float, descending: bool = False,
                           stored: bool = False, exact_limit: int | None = None, rows: int | None = None) -> DataFrame:
    """``(group_cols..., _thr)``: per group, the cut-off value such that
    ``percent_rank() over (partition by group_cols order by value_col [desc])
    <= fraction`` holds exactly for rows with value >= _thr (desc) or
    <= _thr (asc). One row per group; nulls are not ranked.

    ``stored``: ``df`` reads a narrow table as it is; it is then scanned each pass
    instead of being cached. ``rows``: its number of rows, if known."""
    g = list(group_cols)
    if not g:
        return percent_rank_threshold(df.withColumn("_g", F.lit(0)), ["_g"], value_col, fraction,
                                      descending, stored, exact_limit, rows).drop("_g")
    values = _values(df, g, value_col) if stored else _slim(df, g, value_col)
    try:
        stats = _group_stats(values, g).withColumns({"tid": F.lit(0).cast("long"), "r": _cut_rank(fraction, descending)})
        state = _state(stats, values.schema["_v"].dataType)
        return _resolve(values, g, state, BUCKETS, exact_limit or EXACT_LIMIT, rows).select(*g, F.col("value").alias("_thr"))
    finally:
        if not stored:
            values.unpersist()


def percent_rank_flag(df: DataFrame, group_cols: list[str], value_col: str, fraction: float,
                      descending: bool = False, flag: str = "_sel",
                      stored: bool = False, exact_limit: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` plus boolean ``flag``: whether the row passes the percent_rank
    cut. The thresholds, one row per group, are joined as a written table: Spark
    broadcasts it while its size allows, so the rows themselves then never move."""
    g = list(group_cols)
    thr = percent_rank_threshold(df, g, value_col, fraction, descending, stored, exact_limit, rows)
    kind = thr.schema["_thr"].dataType
    v = F.col(value_col).cast(kind)
    if not g:
        cut = thr.first()
        t = F.lit(cut["_thr"] if cut else None).cast(kind)
        keep = (v >= t) if descending else (v <= t)
        return df.withColumn(flag, F.coalesce(keep, F.lit(False)))
    t = F.col("_thr")
    keep = (v >= t) if descending else (v <= t)
    return (_join_groups(df, thr, g, "left")
            .withColumn(flag, F.coalesce(keep, F.lit(False))).select(*df.columns, flag))


def percent_rank_filter(df: DataFrame, group_cols: list[str], value_col: str, fraction: float,
                        descending: bool = False, stored: bool = False,
                        exact_limit: int | None = None, rows: int | None = None) -> DataFrame:
    """Rows of ``df`` where ``percent_rank() over (partition by group_cols order
    by value_col [desc]) <= fraction`` (W4, W5), without a per-group sort.
    Rows with a null value are not ranked and not returned."""
    return (percent_rank_flag(df, group_cols, value_col, fraction, descending, "_keep", stored, exact_limit, rows)
            .where("_keep").drop("_keep"))
