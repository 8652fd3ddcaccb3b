"""Exact decimal arithmetic: money, ratios and means that do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Totals up to 20 digits before the point; the quotient of two keeps 14 digits after it, or 12 when the
# numerator is first multiplied by up to 100.
_TOTAL = "decimal(24,4)"
_SCALED_TOTAL = "decimal(26,4)"


def money(col: Column) -> Column:
    """A floating-point amount as a two-digit decimal, so that its sums are exact."""
    return col.cast("decimal(18,2)")


def ratio(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """``scale * num / den`` rounded half up to ``digits``; NULL when ``den`` is zero.

    The multiplication comes before the division and the rounding last.
    """
    total = num.cast(_TOTAL)
    if scale != 1:
        total = (total * F.lit(scale).cast("decimal(3,0)")).cast(_SCALED_TOTAL)
    quotient = F.try_divide(total, den.cast(_TOTAL))
    return F.round(quotient, digits).cast(f"decimal(20,{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, scale=100)


def mean(total: Column, count: Column, digits: int) -> Column:
    return ratio(total, count, digits)
