"""Column expressions: momentum, ratios, closed-form trends, normal tails, severity ranks."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Severity order and the weights of the composite score; fixed values.
SEVERITY_RANK = {"LOW": 1, "MODERATE": 2, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
SEVERITY_WEIGHT = {"CRITICAL": 1.0, "HIGH": 0.7, "MODERATE": 0.4, "LOW": 0.2}


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lookup(x: Column | str, table: dict, default=None) -> Column:
    """A CASE over a small fixed table."""
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(col(x) == k, F.lit(v)).otherwise(out)
    return out


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def number(x: Column | str) -> Column:
    """A double, or null where the value is missing, NaN or not a number."""
    y = col(x).try_cast("double")
    return F.when(F.isnan(y), None).otherwise(y)


def momentum_score(growth: Column | str) -> Column:
    return F.round(100 / (1 + F.exp(-3.0 * col(growth))), 1)


def momentum_label(score: Column | str) -> Column:
    return F.when(col(score) >= 66, "high").when(col(score) <= 40, "declining").otherwise("normal")


def risk_level(score: Column | str) -> Column:
    return F.when(col(score) >= 66, "high").when(col(score) >= 40, "medium").otherwise("low")


def norm_slope(n: int, sy: Column, siy: Column) -> Column:
    """Least-squares slope of n values on 0..n-1, over their mean; 0 where the mean is not positive."""
    si, sii = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    slope = (n * siy - si * sy) / (n * sii - si * si)
    return F.when(sy > 0, slope / (sy / n)).otherwise(0.0)


def variation(n: int, sy: Column, syy: Column) -> Column:
    """Population deviation of n values over their mean; 0 where the mean is not positive."""
    mean = sy / n
    return F.when(sy > 0, F.sqrt(F.greatest(syy / n - mean * mean, F.lit(0.0))) / mean).otherwise(0.0)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0: a rational approximation by Chebyshev fitting, relative error below 1.2e-7."""
    t = 1 / (1 + x / 2)
    c = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    poly = F.lit(c[-1])
    for a in reversed(c[:-1]):
        poly = poly * t + a
    return t * F.exp(-x * x + poly)


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value."""
    return erfc(F.abs(z) / math.sqrt(2))
