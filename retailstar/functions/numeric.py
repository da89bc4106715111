"""Numeric helpers for reports.

Measures are kept as decimals so that sums are exact; every reported value is
cast to double at the end, so results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATIO = "decimal(6,4)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str) -> Column:
    """Sum of a decimal measure, reported as double."""
    return F.sum(_c(c)).cast("double")


def rounded_sum(c: Column | str, digits: int) -> Column:
    """``ROUND(SUM(x), n)`` rounded on the exact decimal (half away from zero)."""
    return F.round(F.sum(_c(c)), digits).cast("double")


def mean(c: Column | str) -> Column:
    """``AVG(x)`` as double: exact sum divided by the non-null count."""
    return F.sum(_c(c)).cast("double") / F.count(_c(c))


def rounded_mean(c: Column | str, digits: int, scale: float = 1.0) -> Column:
    m = mean(c)
    if scale != 1.0:
        m = m * F.lit(scale)
    return F.round(m, digits)


def growth_pct(cur: Column | str, prev: Column | str, digits: int = 2) -> Column:
    """``ROUND((cur - prev) / prev * 100, n)``; null when prev is null or 0."""
    p = _c(prev)
    return F.round((_c(cur) - p) / F.nullif(p, F.lit(0.0)) * 100, digits)


def margin_amount(revenue: Column | str, margin: Column | str) -> Column:
    """Revenue * gross_margin."""
    return _c(revenue) * _c(margin)
