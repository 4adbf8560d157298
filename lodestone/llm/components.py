"""Connected components of an edge table, by alternating large-star and
small-star steps. Every step aggregates minima per node (combined before the
shuffle) and joins them back, so no node's neighbours meet in one task as a
collection; each step's edges are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import stash_counted


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours move to the smallest of its neighbourhood.
    Small star: the node and its smaller neighbours do. Edges are (u, v) with u > v."""
    if large:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v"))     # repeats go with the small star
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    # one pass over the join: a union of both sides would compute all before it twice
    moved = edges.join(low, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")),
                                                         F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
    return moved.where("u > v").distinct()


def _kept(edges: DataFrame):
    """The edges written, and a mark of their set that does not depend on order."""
    out, seen = stash_counted(edges, "edges", n=F.count(F.lit(1)), mark=F.bit_xor(F.xxhash64("u", "v")))
    return out, (seen["n"], seen["mark"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the smallest id of the component, for every id that has an edge.
    Null ends are ignored; an empty table gives an empty result."""
    now, mark = _kept(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                      .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while mark[0]:
        now, after = _kept(_star(_star(now, True), False))
        if after == mark:                    # both steps leave a forest of stars as it is
            break
        mark = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
