"""Integer expressions: parsing and trial-division primality."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_integer(c, int_type: str = "int", on_error: str = "raise") -> Column:
    """Text -> integer. ``on_error="raise"`` fails the job on malformed text
    (whatever the session's ANSI setting); ``"drop"`` yields null, which the
    caller filters. Null input stays null."""
    parsed = F.try_cast(_col(c), int_type) if hasattr(F, "try_cast") else _col(c).try_cast(int_type)
    if on_error == "drop":
        return parsed
    if on_error != "raise":
        raise ValueError("on_error must be 'raise' or 'drop'")
    return F.when(parsed.isNull() & _col(c).isNotNull(),
                  F.raise_error(F.concat(F.lit("not an integer: "), _col(c).cast("string")))
                  ).otherwise(parsed)


def long_array_literal(values) -> Column:
    """A constant ``array<bigint>`` built from one string literal.

    Cast(split(literal)) is folded to a single array literal by the optimizer,
    so the driver issues one expression instead of one per element.
    """
    text = ",".join(str(int(v)) for v in values)
    if not text:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(text), ",").cast("array<bigint>")


def is_prime_by_division(n, divisors: Column, small_divisors: tuple[int, ...] = ()) -> Column:
    """Trial division by a sorted array of odd divisors (the odd primes up to
    sqrt(max_number)).

    n is prime when n = 2, or n > 2 is odd and no divisor d < n divides it.
    Only the prefix of divisors that can be <= sqrt(n) is scanned: its length
    is bounded above by pi(x) < 1.25506 x / ln x (Rosser-Schoenfeld), so the
    cut never drops a divisor that matters, and the answer equals the scan of
    the whole array. ``small_divisors`` (a prefix of ``divisors``) are also
    tested up front as plain arithmetic.
    """
    n = _col(n)
    s = F.sqrt(n.cast("double"))
    # the first few divisors as plain arithmetic: most composites stop here,
    # before the array scan
    quick = F.lit(True)
    for d in small_divisors:
        quick = quick & ((n <= d) | ((n % d) != 0))
    bound = (F.ceil(F.lit(1.26) * s / F.log(F.greatest(s, F.lit(3.0)))) + 2).cast("int")
    prefix = F.slice(divisors, 1, F.least(F.size(divisors), bound))
    has_divisor = F.exists(prefix, lambda d: (d < n) & ((n % d) == 0))
    return (n == 2) | ((n > 2) & ((n % 2) == 1) & quick & ~has_divisor)


def prime_mask(n: np.ndarray, divisors: np.ndarray) -> np.ndarray:
    """Vectorised twin of ``is_prime_by_division`` over an int64 array.

    Candidates are tested divisor by divisor and leave the working set as soon
    as d*d > n (no larger divisor can decide them: a divisor d > sqrt(n) of n
    pairs with a cofactor < sqrt(n) whose odd prime factors come earlier in
    the list; and when n exceeds max_number every listed d is below sqrt(n)),
    or as soon as a divisor d < n divides them."""
    res = (n == 2) | ((n > 2) & (n % 2 == 1))
    cand = np.flatnonzero(res)
    vals = n[cand]
    for d in divisors:
        d = int(d)
        live = vals >= d * d
        if not live.all():
            cand, vals = cand[live], vals[live]
            if cand.size == 0:
                break
        hit = (vals % d == 0) & (vals > d)
        if hit.any():
            res[cand[hit]] = False
            cand, vals = cand[~hit], vals[~hit]
    return res


def is_prime_kernel(n, divisors: list[int], spark) -> Column:
    """Arrow-batched ``prime_mask``: whole batches per numpy call."""
    from lodestone.functions.vector_kernels import _ship

    get = _ship(np.asarray(divisors, dtype=np.int64), spark)

    @F.arrow_udf("boolean")
    def _is_prime(v: pa.Array) -> pa.Array:
        valid = np.asarray(v.is_valid())
        vals = np.asarray(v.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        out = prime_mask(vals, get())
        return pa.array(out, mask=~valid)
    return _is_prime(_col(n).cast("long"))


# Bases for which the strong-pseudoprime test is exact below 3.3e24.
STRONG_BASES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)


def is_strong_prime(n: int) -> bool:
    """Deterministic Miller-Rabin for any 64-bit n."""
    if n < 2:
        return False
    for p in STRONG_BASES:
        if n % p == 0:
            return n == p
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in STRONG_BASES:
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def _split(n: int) -> int:
    """A proper factor of an odd composite n: Pollard's walk, differences multiplied 64 at a time."""
    root = math.isqrt(n)
    if root * root == n:
        return root
    c = 0
    while True:
        c += 1
        y, q, g, r = 2, 1, 1, 1
        while g == 1:
            x = y
            for _ in range(r):
                y = (y * y + c) % n
            k = 0
            while k < r and g == 1:
                back = y
                for _ in range(min(64, r - k)):
                    y = (y * y + c) % n
                    q = q * abs(x - y) % n
                g = math.gcd(q, n)
                k += 64
            r *= 2
        if g == n:                        # too many steps at once: one by one
            g = 1
            while g == 1:
                back = (back * back + c) % n
                g = math.gcd(abs(x - back), n)
        if g != n:
            return g


def least_factor(n: int) -> int:
    """The smallest prime factor of n > 1 (64-bit)."""
    for p in STRONG_BASES:
        if n % p == 0:
            return p
    if is_strong_prime(n):
        return n
    f = _split(n)
    return min(least_factor(f), least_factor(n // f))


def is_strong_prime_kernel(n, spark, max_number: int | None = None) -> Column:
    """Arrow-batched trial division by all odd primes up to sqrt(max_number), without a list of
    them: 64-bit primes pass, and so do composites above ``max_number`` whose smallest factor is
    larger than its root (all others have one that is not). Without ``max_number`` this is
    primality. Only candidates that pass the caller's first divisors get here."""
    from lodestone.session import ship_package
    ship_package(spark)
    root = None if max_number is None else math.isqrt(max_number)

    def passes(x: int) -> bool:
        return is_strong_prime(x) or (root is not None and x > max_number and least_factor(x) > root)

    @F.arrow_udf("boolean")
    def _is_prime(v: pa.Array) -> pa.Array:
        return pa.array([None if x is None else passes(x) for x in v.to_pylist()], pa.bool_())
    return _is_prime(_col(n).cast("long"))
