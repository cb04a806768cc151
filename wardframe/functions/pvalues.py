"""Tail probabilities for test statistics.

Applied to result rows (one per test), never to data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            c = 1.0 + numerator / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def student_two_sided(t: float, dof: float) -> float:
    if any(v is None or math.isnan(v) for v in (t, dof)) or dof <= 0:
        return math.nan
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def chi_square_tail(x: float, dof: float) -> float:
    """Upper tail for a whole number of degrees of freedom (finite sum)."""
    if any(v is None or math.isnan(v) for v in (x, dof)) or dof < 1:
        return math.nan
    half, steps = x / 2.0, int(dof)
    if steps % 2 == 0:
        term, total = math.exp(-half), 0.0
        for i in range(steps // 2):
            total += term
            term *= half / (i + 1)
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range(steps // 2):
        total += term
        term *= half / (i + 1.5)
    return min(1.0, total)


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([student_two_sided(a, b) for a, b in zip(t, dof, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(a, b) for a, b in zip(x, dof, strict=True)], dtype="float64")
