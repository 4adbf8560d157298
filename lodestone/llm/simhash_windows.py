"""Benchmark decontamination: item-sized windows of the documents against the
benchmark's items, by SimHash with a multi-index over Hamming blocks, then exact
weighted-shingle similarity.

DataFrame functions only.
1. Windows are as long as an item and start at any word. A window of m shingles (five
   words; all words of a shorter item) can only reach similarity t with an item of
   m' when t (m + m') / (1 + t) of its shingles are shingles of items of that
   length, so windows with fewer are dropped beforehand, which loses none.
2. All other windows and the items get 128-bit SimHash fingerprints, each shingle weighing
   as often as it occurs: rows of a window's shingles are summed bit by bit, three
   counters to a 64-bit number. Fingerprints are cut in 8 blocks of 16 bits; the
   items are indexed under every block value within 3 bits. Two fingerprints
   within 31 bits agree to 3 bits in some block, so every such pair meets.
3. Pairs of equal nominal length within 31 bits are verified: the weighted
   Jaccard similarity of their shingle counts must be 0.8 or more.

At similarity 0.8 two fingerprints differ in 19 bits on average (deviation 4).
The lookup table is the benchmark's, written first, so that the planner knows
its size: it is broadcast only below the session's threshold and shuffled
otherwise. Null and empty texts and items match nothing; repeated rows give one
row; a null id is kept; of windows with equal similarity the earliest is given.
Texts of any length are read whole. Empty tables give no rows. Only ids and texts are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import free_name, stash

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 16, 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
LANE = 21                        # bits of a counter; three to a number
_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> Column:
    return F.filter(F.split(F.col(text), _SPACE), lambda w: w != "")


def _shingles(words: str, k: str) -> Column:
    """Word runs as strings; empty when there are fewer than k words."""
    return F.expr(f"if(size({words}) < {k}, cast(array() as array<string>), "
                  f"transform(sequence(1, size({words}) - {k} + 1), i -> array_join(slice({words}, i, {k}), ' ')))")


def _shingle_hashes(words: str, k: int) -> Column:
    """Hashes of the runs of k words: words are hashed once, then combined. (The hashes are a
    lambda's argument, so each row computes them once.)"""
    parts = ", ".join(f"a[i + {j}]" for j in range(k))
    return F.expr(f"transform(array(transform({words}, x -> xxhash64(x))), a -> "
                  f"transform(sequence(0, size(a) - {k}), i -> xxhash64({parts})))[0]")


def _fingerprints(rows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """keys, f1, f2: bit b of a half is set when the shingle occurrences with it are the majority."""
    each = rows.select(*keys, F.explode(shingles).alias("v")).select(*keys, *(F.xxhash64("v", F.lit(h)).alias(f"h{h}") for h in (1, 2)))
    sums = [F.expr(f"sum({' + '.join(f'shiftleft(shiftright(h{h}, {b + j}) & 1L, {LANE * j})' for j in range(3) if b + j < 64)})")
            .alias(f"c{h}_{b}") for h in (1, 2) for b in range(0, 64, 3)]
    counted = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), *sums)

    def half(h: int) -> Column:        # the counters are a lambda's argument, so the plan stays short
        lanes = ", ".join(f"c{h}_{b}" for b in range(0, 64, 3))
        return F.expr(f"transform(array(array({lanes})), cs -> aggregate(sequence(0, 63), 0L, (f, b) -> "
                      f"if(2 * (shiftright(cs[cast(b div 3 as int)], {LANE} * (b % 3)) & {2 ** LANE - 1}L) > m, "
                      f"f | shiftleft(1L, b), f)))[0]").alias(f"f{h}")

    return counted.select(*keys, half(1), half(2))


def _blocks() -> Column:
    """(block, value) of a fingerprint in columns f1, f2."""
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), b -> struct(b as block, cast(shiftrightunsigned("
                  f"if(b < 4, f1, f2), (b % 4) * {BLOCK_BITS}) & {2 ** BLOCK_BITS - 1}L as int) as value))")


def _masks() -> Column:
    """Every 16-bit pattern of at most ``BLOCK_RADIUS`` bits: 697 of them."""
    return F.expr(f"filter(sequence(0, {2 ** BLOCK_BITS - 1}), m -> bit_count(m) <= {BLOCK_RADIUS})")


def _starts(threshold: float) -> Column:
    """Starts of the windows of nominal length ``len`` with enough hits: ``ps`` are the sorted places
    of hits in a text of ``n`` words; a window with at least T of them reaches from some hit to
    the T-th from it."""
    return F.expr(f"""
        transform(array(struct(len - k + 1 as m, least(n, len) - k + 1 as w, greatest(0, n - len) as last,
                               cast(ceil({threshold} * (len - k + 1 + least(n, len) - k + 1) / (1 + {threshold}) - 1e-9) as int) as t)), c ->
          array_distinct(flatten(transform(sequence(0, greatest(size(ps) - c.t, 0)), i ->
            if(size(ps) >= c.t and ps[i + c.t - 1] - ps[i] < c.w and greatest(0, ps[i + c.t - 1] - c.w + 1) <= least(ps[i], c.last),
               sequence(greatest(0, ps[i + c.t - 1] - c.w + 1), least(ps[i], c.last)), cast(array() as array<int>))))))[0]""")


def _weights(rows: DataFrame, keys: list[str], shingles: str, name: str) -> DataFrame:
    """keys, shingle, how often it occurs."""
    return rows.select(*keys, F.explode(shingles).alias("sh")).groupBy(*keys, "sh").agg(F.count(F.lit(1)).alias(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, similarity, start (first word of the best window, the earliest of
    equals), n_words (its length): one row per document and item that reach the threshold."""
    items = (benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
             .select("item_id", _words("text").alias("w")).where("size(w) > 0")
             .withColumns({"len": F.size("w"), "k": F.least(F.size("w"), F.lit(SHINGLE)), "ik": F.xxhash64("item_id", "w")})
             .dropDuplicates(["ik"]).withColumn("s", _shingles("w", "k")))
    items = stash(items, "items")
    sizes = [r.k for r in items.select("k").distinct().orderBy("k").collect()]       # five at most
    if not sizes:
        return docs.select(F.col(id_col).alias("doc_id")).limit(0).select(
            "doc_id", F.lit(None).cast(dict(benchmark.dtypes)[item_col]).alias("item_id"),
            F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_words"))

    # places of item shingles, for each nominal length
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .select(F.xxhash64("doc_id", "text").alias("rk"), "doc_id", _words("text").alias("w")))
    hits = None
    for k in sizes:
        lookup = stash(items.where(F.col("k") == k).select("len", F.explode(_shingle_hashes("w", k)).alias("h")).distinct(),
                       "item-shingles")
        at = (rows.where(F.size("w") >= k)
              .select("rk", F.size("w").alias("n"), F.posexplode(_shingle_hashes("w", k)).alias("p", "h")))
        part = at.join(lookup, "h").select("rk", F.lit(k).alias("k"), "len", "n", "p")
        hits = part if hits is None else hits.unionByName(part)
    starts = (hits.groupBy("rk", "k", "len").agg(F.max("n").alias("n"), F.sort_array(F.collect_set("p")).alias("ps"))
              .select("rk", "k", "len", F.explode(_starts(threshold)).alias("start")))
    starts = stash(starts, "window-starts")

    # the windows' shingles, fingerprints and weights
    key = ["rk", "len", "start"]
    held = rows.join(starts.select("rk").distinct(), "rk", "left_semi").dropDuplicates(["rk"])
    windows = (starts.join(held, "rk").select("doc_id", *key, "k", F.expr("slice(w, start + 1, len)").alias("win"))
               .withColumn("s", _shingles("win", "k")).drop("win"))
    windows = stash(windows, "windows")
    prints = stash(_fingerprints(windows, key, "s"), "fingerprints")
    coded = _fingerprints(items, ["ik", "len"], "s")
    index = (coded.select("ik", "len", "f1", "f2", F.explode(_blocks()).alias("b"))
             .select("ik", "len", "f1", "f2", "b", F.explode(_masks()).alias("mask"))
             .select("ik", "len", F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("b.block").alias("block"),
                     F.col("b.value").bitwiseXOR(F.col("mask")).alias("value")))
    probes = prints.select(*key, "f1", "f2", F.explode(_blocks()).alias("b")).select(
        *key, "f1", "f2", F.col("b.block").alias("block"), F.col("b.value").alias("value"))
    # the index has 5,576 rows an item, which the planner cannot foresee: always by shuffle
    near = (probes.join(index.hint("merge"), ["len", "block", "value"])
            .where(F.bit_count(F.col("f1").bitwiseXOR(F.col("g1"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("g2"))) <= RADIUS)
            .select(*key, "ik").distinct())

    # exact similarity of the pairs that met
    mine = _weights(windows, key, "s", "c")
    theirs = _weights(items, ["ik"], "s", "d")
    common = (near.join(mine, key).join(theirs, ["ik", "sh"])
              .groupBy("ik", *key).agg(F.sum(F.least("c", "d")).alias("common")))
    best = F.max_by(F.struct("start", "len"), F.struct("similarity", -F.col("start")))
    return (common.join(windows.select(*key, "doc_id", F.size("s").alias("m")), key)
            .join(items.select("ik", "item_id", F.size("s").alias("q")), "ik")
            .withColumn("similarity", F.col("common") / (F.col("m") + F.col("q") - F.col("common")))
            .where(F.col("similarity") >= threshold).groupBy("doc_id", "item_id")
            .agg(F.max("similarity").alias("similarity"), best.alias("b"))
            .select("doc_id", "item_id", "similarity", F.col("b.start").cast("long").alias("start"),
                    F.col("b.len").cast("long").alias("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a window similar to an item. Rows are told apart
    by id and text, so null and repeated ids are judged by their own text."""
    key = F.xxhash64(id_col, text_col)
    found = contaminated(docs.select(key.alias("rk"), F.col(text_col).alias("text")), benchmark, "rk", threshold=threshold)
    name = free_name(docs, "_contaminated_row")
    bad = stash(found.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(bad, key == F.col(name), "left_anti")


#: The definition without fingerprints, for items of five words or more (the tables have no
#: shorter): every window of item length that shares a shingle with the item; the others have similarity 0.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rk, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT rk, len(w) AS n, unnest(range(len(w) - 4)) AS p, w FROM d WHERE len(w) >= 5),
dh AS (SELECT rk, n, p, array_to_string(w[p + 1:p + 5], ' ') AS s FROM ds),
ish AS (SELECT item_id, len(w) AS len, unnest(range(len(w) - 4)) AS j, w FROM i WHERE len(w) >= 5),
ic AS (SELECT item_id, len, array_to_string(w[j + 1:j + 5], ' ') AS s, count(*) AS c FROM ish GROUP BY ALL),
it AS (SELECT item_id, sum(c) AS t FROM ic GROUP BY ALL),
hit AS (SELECT rk, n, p, item_id, len, c, s FROM dh JOIN ic USING (s)),
win AS (SELECT rk, item_id, len, n, s, c, unnest(range(greatest(0, p - (len - 5)), least(p, greatest(0, n - len)) + 1)) AS start FROM hit),
ws AS (SELECT rk, item_id, len, n, start, s, c, count(*) AS m FROM win GROUP BY ALL),
cm AS (SELECT rk, item_id, len, n, start, sum(least(m, c)) AS m FROM ws GROUP BY ALL),
sim AS (SELECT doc_id, item_id, start, len, m::DOUBLE / (least(n, len) - 4 + t - m) AS similarity FROM cm JOIN it USING (item_id) JOIN d USING (rk)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM sim WHERE similarity >= 0.8)
SELECT doc_id, item_id, similarity, start::BIGINT AS start, len::BIGINT AS n_words FROM best WHERE r = 1
"""
