"""Arithmetic that gives the same bits whatever the partitioning (SC16-SC21).

Sums run at ``decimal(28,10)`` (exact to ten decimals and order-free, up to 18
integer digits) and come back as a double; averages are that sum divided by
the count; rounding goes
through ``decimal(28,10)`` so half-way cases round away from zero on the
decimal text, not on the binary double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.text import _c

EXACT = "decimal(28,10)"  # summed into decimal(38,10)


def round_half_up(col, digits: int) -> Column:
    """SC17 ``round(x, n)`` half away from zero, result double."""
    return F.round(_c(col).cast("decimal(28,10)"), digits).cast("double")


def sum_money(col, scale_type: str = EXACT) -> Column:
    """Exact sum of an amount (fractions of a cent included), as double."""
    return F.sum(_c(col).cast(scale_type)).cast("double")


def avg_money(col, scale_type: str = EXACT) -> Column:
    """Exact average: decimal sum as double divided by the non-NULL count."""
    c = _c(col)
    return F.sum(c.cast(scale_type)).cast("double") / F.nullif(F.count(c), F.lit(0))


def avg_exact(col) -> Column:
    """Average of an integer column: long sum as double over the count."""
    c = _c(col)
    return F.sum(c.cast("long")).cast("double") / F.nullif(F.count(c), F.lit(0))


def safe_ratio_pct(numerator, denominator, digits: int = 2) -> Column:
    """AG12/SC4: ``round(num / nullif(den, 0) * 100, 2)``; NULL when den = 0."""
    ratio = _c(numerator).cast("double") / F.nullif(_c(denominator), F.lit(0)) * 100
    return round_half_up(ratio, digits)


def volumetric_weight(length, width, height) -> Column:
    """SC21 ``round(L*W*H / 5000 * 1000, 2)``; NULL if any side is NULL."""
    return round_half_up(_c(length) * _c(width) * _c(height) / 5000.0 * 1000, 2)
