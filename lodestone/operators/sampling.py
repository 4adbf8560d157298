"""Row sampling (T5, T6): repeatable by key, or Spark's own sampler."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestone.functions.sampling import hash_fraction, hash_key


def sample_rows(df: DataFrame, fraction: float, seed: int = 42, id_col: str | None = None,
                *salt) -> DataFrame:
    """About ``fraction`` of the rows. With ``id_col``: rows whose
    md5(id:seed:salt...) falls under the fraction (same rows under any
    partitioning, after retries, and in SQL). Without: ``df.sample`` (Bernoulli,
    seeded, tied to the input partitioning)."""
    if id_col is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_fraction(id_col, fraction, seed, *salt))


def pick_rows(df: DataFrame, k: int, id_col: str, seed: int = 42) -> DataFrame:
    """k rows in md5(id:seed) order, ties by id: a bounded top-k, repeatable."""
    return df.orderBy(hash_key(id_col, seed), id_col).limit(k)
