"""Student-t tail probabilities and quantiles, for the one-row results of the tests."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    result = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * result


def two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|)."""
    return _incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def critical_value(level: float, dof: float) -> float:
    """The t with P(|T| <= t) = level, by bisection."""
    low, high = 0.0, 1.0
    while 1.0 - two_sided_p(high, dof) < level:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if 1.0 - two_sided_p(mid, dof) < level else (low, mid)
    return (low + high) / 2.0


def noncentral_cdf(t: float, dof: float, shift: float) -> float:
    """P(T <= t) of the noncentral t distribution, by its series in the incomplete beta function."""
    if t < 0:
        return 1.0 - noncentral_cdf(-t, dof, -shift)
    normal = 0.5 * math.erfc(shift / math.sqrt(2.0))
    x, half = t * t / (dof + t * t), shift * shift / 2.0
    even = math.exp(-half)
    odd = shift * math.exp(-half) / (math.sqrt(2.0) * math.gamma(1.5))
    total, j = 0.0, 0
    while True:
        total += even * _incomplete_beta(j + 0.5, dof / 2.0, x) + odd * _incomplete_beta(j + 1.0, dof / 2.0, x)
        j += 1
        even *= half / j
        odd *= half / (j + 0.5)
        if j > half and even + abs(odd) < 1e-17:
            return normal + 0.5 * total


def two_sample_power(n: float, effect: float, alpha: float) -> float:
    """Power of the two-sided t test of two groups of ``n`` rows for a difference of ``effect`` deviations."""
    dof, shift = 2.0 * n - 2.0, effect * math.sqrt(n / 2.0)
    limit = critical_value(1.0 - alpha, dof)
    return 1.0 - noncentral_cdf(limit, dof, shift) + noncentral_cdf(-limit, dof, shift)


def rows_for_power(effect: float, alpha: float, power: float) -> float:
    """Rows per group at which the test reaches the power, by bisection; at least 2."""
    low, high = 2.0, 4.0
    if two_sample_power(low, effect, alpha) >= power:
        return low
    while two_sample_power(high, effect, alpha) < power:
        low, high = high, 2.0 * high
    for _ in range(60):
        mid = (low + high) / 2.0
        low, high = (mid, high) if two_sample_power(mid, effect, alpha) < power else (low, mid)
    return high


@F.pandas_udf(DoubleType())
def needed_rows(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """``rows_for_power`` of (effect, alpha, power)."""
    for columns in batches:
        yield pd.Series([
            None if any(pd.isna(v) for v in row) or not row[0] else rows_for_power(abs(row[0]), *row[1:])
            for row in zip(*columns)
        ], dtype="float64")


@F.pandas_udf(DoubleType())
def p_value(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Two-sided p-value of (t, degrees of freedom)."""
    for t, dof in batches:
        yield pd.Series([
            None if pd.isna(a) or pd.isna(b) or b <= 0 else two_sided_p(a, b) for a, b in zip(t, dof)
        ], dtype="float64")


@F.pandas_udf(DoubleType())
def critical_95(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Two-sided 95 % critical value of the degrees of freedom."""
    for dof in batches:
        yield pd.Series([
            None if pd.isna(b) or b <= 0 else critical_value(0.95, b) for b in dof
        ], dtype="float64")
