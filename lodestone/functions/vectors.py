"""Dense-vector expressions on ``array<double>`` columns.

All are higher-order array functions evaluated in the JVM; no Python UDF.
Vectors are normalised once, so cosine similarity is a plain dot product.
A per-row value needed inside a lambda is passed in as an array argument
(``zip_with`` with ``array_repeat``), never written inside the lambda body,
where Spark would evaluate it once per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(u, v) -> Column:
    """Sum of u[i] * v[i] (both of one length)."""
    return F.aggregate(F.zip_with(_col(u), _col(v), lambda a, b: a * b), F.lit(0.0),
                       lambda acc, x: acc + x)


def norm(u) -> Column:
    return F.sqrt(F.aggregate(_col(u), F.lit(0.0), lambda acc, x: acc + x * x))


def unit(u, dim: int | None = None) -> Column:
    """u / |u| as ``array<double>``; the zero vector stays zero (cosine
    similarity 0, distance 1 to everything, itself included). With ``dim``,
    a vector of another length fails the job."""
    u = _col(u).cast("array<double>")
    n = norm(u)
    # the norm goes into the lambda as a second array argument: an outer
    # expression written inside a lambda would be evaluated once per element
    out = F.when(n > 0, F.zip_with(u, F.array_repeat(n, F.size(u)), lambda x, nn: x / nn)
                 ).otherwise(F.transform(u, lambda x: F.lit(0.0)))
    bad = F.exists(u, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = F.when(bad, F.raise_error(F.lit("vector with a null, NaN or infinite component"))).otherwise(out)
    if dim is not None:
        out = F.when(F.size(u) == dim, out).otherwise(
            F.raise_error(F.concat(F.lit(f"vector length must be {dim}, got "),
                                   F.size(u).cast("string"))))
    return out


def cosine_similarity(u, v) -> Column:
    """Cosine similarity of raw vectors; 0 when either norm is 0."""
    nu, nv = norm(u), norm(v)
    return F.when((nu > 0) & (nv > 0), dot(u, v) / (nu * nv)).otherwise(F.lit(0.0))


def cosine_distance_unit(u_hat, v_hat) -> Column:
    """1 - u.v for vectors already normalised by ``unit``."""
    return F.lit(1.0) - dot(u_hat, v_hat)


def double_array_literal(values) -> Column:
    """A constant ``array<double>`` from one string literal (folded by the
    optimizer); ``repr`` round-trips every double exactly."""
    vals = [float(v) for v in values]
    if not vals:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(v) for v in vals)), ",").cast("array<double>")
