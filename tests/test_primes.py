import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.operators.primes import odd_primes_upto, parse_integers, prime_filter, top_primes


def _sieve(m):
    is_p = [True] * (m + 1)
    is_p[0:2] = [False, False][: m + 1]
    for i in range(2, int(m ** 0.5) + 1):
        if is_p[i]:
            is_p[i * i:: i] = [False] * len(is_p[i * i:: i])
    return [i for i in range(3, m + 1) if is_p[i]]


@pytest.mark.parametrize("method", ["segments", "join"])
@pytest.mark.parametrize("m", [0, 2, 3, 4, 8, 9, 10, 25, 100, 5000])
def test_odd_primes_upto(spark, m, method):
    assert sorted(r.p for r in odd_primes_upto(spark, m, method).collect()) == _sieve(m)


@pytest.mark.parametrize("method", ["segments", "join"])
@pytest.mark.parametrize("seg", [1, 2, 7, 64])
def test_sieve_crosses_segments(spark, monkeypatch, method, seg):
    import lodestone.operators.primes as P
    monkeypatch.setattr(P, "SIEVE_SEGMENT", seg)
    assert sorted(r.p for r in P.odd_primes_upto(spark, 3001, method).collect()) == _sieve(3001)


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_top_primes_fixture(spark, engine):
    # FIXTURES 2.3
    df = spark.createDataFrame([(v,) for v in [-7, 0, 1, 2, 3, 4, 9, 25, 49, 97, 97, None]],
                               "value int")
    assert [r.value for r in top_primes(df, "value", 3, engine=engine).collect()] == [97, 97, 3]
    assert [r.value for r in top_primes(df, "value", 3, max_number=9, engine=engine).collect()] \
        == [97, 97, 49]
    got = sorted(r.value for r in prime_filter(df, "value", max_number=4, engine=engine).collect())
    assert got == [2, 3, 9, 25, 49, 97, 97]          # no divisors: every odd n > 2 passes
    assert [r.value for r in top_primes(df, "value", 3, distinct=True, engine=engine).collect()] \
        == [97, 3, 2]


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_prime_filter_exact_on_longs(spark, engine):
    vals = list(range(-5, 3000)) + [2**31 - 1, 2**31 + 11, 10**10 + 19, 10**10 + 21]
    df = spark.createDataFrame([(v,) for v in vals], "value long")
    got = sorted(r.value for r in prime_filter(df, "value", engine=engine).collect())

    def is_prime(n):
        if n < 2:
            return False
        i = 2
        while i * i <= n:
            if n % i == 0:
                return False
            i += 1
        return True
    assert got == sorted(v for v in vals if is_prime(v))


def test_parse_integers(spark):
    df = spark.createDataFrame([("7",), ("x",), ("7.9",), ("3000000000",), (None,)], "value string")
    assert [r.value for r in parse_integers(df, on_error="drop").collect()] == [7]
    assert sorted(r.value for r in parse_integers(df, int_type="bigint", on_error="drop").collect()) \
        == [7, 3000000000]
    with pytest.raises(PySparkException):
        parse_integers(df, on_error="raise").collect()


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_top_primes_widens_until_found(spark, monkeypatch, engine):
    # the top windows hold only even numbers; the primes sit at the very bottom
    vals = [2 * i for i in range(2, 4000)] + [3, 5, None]
    df = spark.createDataFrame([(v,) for v in vals], "value long")
    assert [r.value for r in top_primes(df, "value", 3, engine=engine).collect()] == [5, 3]
    assert top_primes(df.where("value > 100"), "value", 3, engine=engine).count() == 0
    import lodestone.operators.primes as P
    monkeypatch.setattr(P, "MAX_WINDOW", 500)          # past the cap: whole-column test
    assert [r.value for r in P.top_primes(df, "value", 3, engine=engine).collect()] == [5, 3]


def _reference_rule(n, divisors):
    # the reference's rule, read off its description: n = 2, or odd n > 2 with
    # no listed divisor d < n that divides it
    if n == 2:
        return True
    if n < 2 or n % 2 == 0:
        return False
    return not any(n > d and n % d == 0 for d in divisors)


@pytest.mark.parametrize("max_number", [4, 9, 50, 400, 10**6])
def test_prime_mask_equals_rule(max_number):
    import numpy as np
    from lodestone.functions.numbers import prime_mask
    ds = [p for p in _sieve(int(max_number ** 0.5))]
    rng = np.random.default_rng(max_number)
    ns = np.concatenate([np.arange(-5, 3000), rng.integers(0, 2 * max_number + 5000, 3000)])
    got = prime_mask(ns.astype(np.int64), np.array(ds, dtype=np.int64))
    assert [bool(x) for x in got] == [_reference_rule(int(n), ds) for n in ns]


def test_top_primes_beyond_the_window(spark):
    df = spark.range(2, 60000).select(F.col("id").alias("value"))
    sieve = [n for n in range(2, 60000) if all(n % d for d in range(2, int(n ** 0.5) + 1))]
    for kw in ({}, {"max_number": 60000}):
        got = [r.value for r in top_primes(df, "value", 5000, **kw).collect()]
        assert got == sieve[::-1][:5000]


def test_values_beyond_the_divisor_list(spark):
    values = [10**13 + 37, 10**13 + 39, 2**63 - 25, 2**63 - 1, 3037000493**2, 97, 91, 2, 1, -7, None]
    df = spark.createDataFrame([(v,) for v in values], "value long")
    want = [2**63 - 25, 10**13 + 37, 97, 2]
    assert [r.value for r in top_primes(df, "value", 10).collect()] == want
    assert sorted(r.value for r in prime_filter(df, "value").collect()) == sorted(want)
    assert sorted(r.value for r in prime_filter(df, "value", max_number=2**63 - 1).collect()) == sorted(want)


def test_least_factor():
    import random
    from lodestone.functions.numbers import least_factor
    for n in [*range(2, 3000), 2 ** 61 - 1, (2 ** 31 - 1) ** 2, 4294967291 * 4294967279, 1000003 ** 3, 3037000493 ** 2]:
        d = least_factor(n)
        assert n % d == 0 and (n > 10 ** 7 or d == next(k for k in range(2, n + 1) if n % k == 0))
    rng = random.Random(1)
    primes = [p for p in range(10 ** 6, 10 ** 6 + 3000) if least_factor(p) == p]
    for _ in range(200):
        a, b, c = rng.choices(primes, k=3)
        assert least_factor(a * b) == min(a, b) and least_factor(a * b * c) == min(a, b, c)


def test_large_max_number_with_larger_values(spark):
    # divisors up to 3e6 only: composites above with larger factors pass, as by trial division
    mx = 9 * 10 ** 12
    p, q, r = 2999999, 3000017, 3000029              # around the root of mx: the first is below it
    rows = [p * q, q * r, q * q, p * p, mx - 1, 2 ** 61 - 1, (2 ** 31 - 1) ** 2, 2, 3, 9, 7 * q * 1000003, 4 * q, -7, None]
    from lodestone.operators.primes import too_many_divisors
    assert too_many_divisors(mx)
    want = sorted(n for n in rows if n is not None and (n == 2 or (n > 2 and n % 2 == 1 and all(n % d or n == d for d in [3, 5, 7, 11, 2999999, 1000003]) and n not in (mx - 1,))))
    df = spark.createDataFrame([(n,) for n in rows], "value long")
    got = sorted(x.value for x in prime_filter(df, "value", mx).collect())
    assert got == want
    assert [x.value for x in top_primes(df, "value", 2, mx).collect()] == sorted(want, reverse=True)[:2]
