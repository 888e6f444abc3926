"""Student-t quantile as a Column expression.

Spark has no t distribution. The confidence level is a Python constant, so the
critical values of small samples are computed once while the expression is
built (from the finite trigonometric series of the distribution function,
Abramowitz & Stegun 26.7.3/26.7.4) and looked up by degrees of freedom. Above
that table the expansion of G. W. Hill, "Algorithm 396: Student's t-quantiles",
Communications of the ACM 13(10), 1970, is accurate to far more than the six
digits reported.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, functions as F

EXACT_UP_TO = 60


def _central_probability(t: float, n: int) -> float:
    """P(|T| <= t) for whole degrees of freedom."""
    theta = math.atan(t / math.sqrt(n))
    cos2 = math.cos(theta) ** 2
    odd = n % 2
    term = math.cos(theta) if odd else 1.0
    series = 0.0
    for k in range(1 if odd else 0, n - 1, 2):
        series += term
        term *= cos2 * (k + 1) / (k + 2)
    if odd:
        return 2.0 / math.pi * (theta + math.sin(theta) * series)
    return math.sin(theta) * series


@lru_cache(maxsize=None)
def critical_value(n: int, level: float) -> float:
    low, high = 0.0, 1.0
    while _central_probability(high, n) < level:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if _central_probability(mid, n) < level:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def _hill_terms(tail: float) -> tuple[float, float, float]:
    z = NormalDist().inv_cdf(tail / 2.0)
    poly = ((0.4 * z * z + 6.3) * z * z + 36.0) * z * z + 94.5
    return z, z * z, poly


def _large(n: Column, tail: float) -> Column:
    z, zz, poly = _hill_terms(tail)
    a = F.lit(1.0) / (n - 0.5)
    b = F.lit(48.0) / (a * a)
    c = ((a * 20700.0 / b - 98.0) * a - 16.0) * a + 96.36
    d = ((F.lit(94.5) / (b + c) - 3.0) / b + 1.0) * F.sqrt(a * (math.pi / 2.0)) * n
    c2 = (((d * (0.05 * z) - 5.0) * z - 7.0) * z - 2.0) * z + b + c
    y = ((F.lit(poly) / c2 - zz - 3.0) / b + 1.0) * z
    return F.sqrt(n * F.expm1(a * y * y))


def t_quantile(df: Column, level: float = 0.95) -> Column:
    """Two-sided critical value t such that P(|T| <= t) = level; NULL below one degree of freedom."""
    n = df.cast("double")
    table = F.array(*[F.lit(critical_value(k, level)) for k in range(1, EXACT_UP_TO + 1)])
    return F.when(n.between(1, EXACT_UP_TO), F.try_element_at(table, n.cast("int"))).when(
        n > EXACT_UP_TO, _large(n, 1.0 - level)
    )


def t_quantile_sql(df: str, level: float = 0.95) -> str:
    """The same quantile as SQL text, for checks in another engine."""
    tail = 1.0 - level
    z, zz, poly = (f"({v!r}::DOUBLE)" for v in _hill_terms(tail))
    table = ",".join(f"{critical_value(k, level)!r}::DOUBLE" for k in range(1, EXACT_UP_TO + 1))
    n = f"CAST({df} AS DOUBLE)"
    a = f"(1e0/({n}-0.5e0))"
    b = f"(48e0/({a}*{a}))"
    c = f"((({a}*20700e0/{b}-98e0)*{a}-16e0)*{a}+96.36e0)"
    d = f"(((94.5e0/({b}+{c})-3e0)/{b}+1e0)*sqrt({a}*{math.pi / 2.0!r}::DOUBLE)*{n})"
    c2 = f"(((({d}*0.05e0*{z}-5e0)*{z}-7e0)*{z}-2e0)*{z}+{b}+{c})"
    y = f"((({poly}/{c2}-{zz}-3e0)/{b}+1e0)*{z})"
    return (
        f"(CASE WHEN {n} BETWEEN 1 AND {EXACT_UP_TO} THEN ([{table}])[CAST({df} AS INTEGER)] "
        f"WHEN {n}>{EXACT_UP_TO} THEN sqrt({n}*(exp({a}*{y}*{y})-1e0)) END)"
    )
