"""Word count (C1) and word search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import contains_word, tokens


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word string, count long)``: occurrences of every token over all rows.

    Plan: scan(text) -> generate(explode) -> filter -> partial count ->
    shuffle on word -> final count. Map-side partial aggregation collapses a
    hot word (``the``) to one row per task before the shuffle.
    """
    words = df.select(F.explode(tokens(text_col)).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_search(df: DataFrame, word: str, text_col: str = "text", id_col: str | None = "id",
                per: str = "id") -> DataFrame:
    """One row ``(count long)``: how many ids (``per="id"``) or records
    (``per="record"``) have ``word`` among their tokens. Zero matches give 0.

    The match is a per-row predicate evaluated before any shuffle; only the
    matching ids travel, deduplicated map-side.
    """
    hits = df.where(contains_word(text_col, word))
    if per == "record":
        return hits.agg(F.count(F.lit(1)).alias("count"))
    if per != "id":
        raise ValueError("per must be 'id' or 'record'")
    if id_col is None:
        raise ValueError("per='id' needs id_col")
    # a null id is one id, as in distinct() followed by count()
    return hits.select(id_col).distinct().agg(F.count(F.lit(1)).alias("count"))
