"""Repeatable sampling expressions (T5, T6, T7) from md5 of a stable key.

Unlike ``rand()``, they give the same rows under any partitioning, on every
re-execution after a lost executor, and in any SQL engine with ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(id_col, *salt) -> Column:
    """md5 hex of ``"<id>:<salt1>:<salt2>..."``."""
    parts = [F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")]
    for s in salt:
        parts += [F.lit(":"), F.lit(str(s))]
    return F.md5(F.concat(*parts))


def hex_threshold(fraction: float) -> str:
    """Eight hex digits t with P(md5 prefix < t) = fraction (to 2**-32)."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return format(min(int(fraction * 2**32), 2**32 - 1), "08x") if fraction < 1.0 else "g"


def hash_fraction(id_col, fraction: float, *salt) -> Column:
    """True for about ``fraction`` of the ids, the same ones every time.
    Fixed-width lower-case hex compares as its number."""
    return F.substring(hash_key(id_col, *salt), 1, 8) < F.lit(hex_threshold(fraction))
