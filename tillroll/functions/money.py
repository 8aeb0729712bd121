"""Exact money arithmetic.

Prices carry two decimal places by contract. Summing doubles gives an answer
that depends on row order (and so on partitioning), which can also break rank
ties between equal revenues. Summing the cents as a decimal is exact and
repeatable; the total is turned back into a double at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 2
MONEY_TYPE = f"decimal(18,{MONEY_SCALE})"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _not_nan(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def money(c, scale: int = MONEY_SCALE) -> Column:
    """A money value as an exact decimal rounded to ``scale`` places (cents by
    default; the cast rounds, so pass the scale the data really has); NaN is
    NULL."""
    return _not_nan(c).cast(MONEY_TYPE if scale == MONEY_SCALE else f"decimal({16 + scale},{scale})")


def exact_sum(c, empty_as_zero: bool = True, scale: int = MONEY_SCALE) -> Column:
    """Sum of a money column as double; an all-null group sums to 0.0."""
    s = F.sum(money(c, scale)).cast("double")
    return F.coalesce(s, F.lit(0.0)) if empty_as_zero else s


def exact_mean(c, scale: int = MONEY_SCALE) -> Column:
    """Mean over the non-null, non-NaN values (null when there are none)."""
    return F.try_divide(F.sum(money(c, scale)).cast("double"), F.count(_not_nan(c)))


def round_half_even(c, places: int = MONEY_SCALE) -> Column:
    """Round to ``places`` decimals, ties to even (0.125 -> 0.12)."""
    return F.bround(_c(c), places)


def money_total(c) -> Column:
    """A money total (already a sum) as a wide exact decimal, for re-summing."""
    return _c(c).cast("decimal(38,2)")
