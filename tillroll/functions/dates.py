"""Date and time expressions.

All of them work on zone-less timestamps (timestamp_ntz) and give the same
answer whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# English day names, Sunday first (Spark's dayofweek gives 1 for Sunday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Tenure buckets on whole calendar days since signup.
#   days < 30 -> New, < 365 -> Developing, < 730 -> Established, otherwise Loyal
TENURE_BOUNDS = [(30, "New"), (365, "Developing"), (730, "Established")]
TENURE_OTHERWISE = "Loyal"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def elapsed_days(start, end) -> Column:
    """Whole days from ``start`` to ``end``, floored toward minus infinity.

    -1 hour gives -1 and -2 days 1 hour gives -3 (a plain day difference
    would truncate toward zero). Microsecond differences below 2**53 are
    exact in a double and one microsecond is far above its rounding error,
    so the floor is exact. Result is bigint.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")


def calendar_days(start, end) -> Column:
    """Difference of the calendar dates of two timestamps (bigint)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def day_name(ts) -> Column:
    """Full English day name ("Wednesday"), independent of locale and zone."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.dayofweek(F.to_date(_c(ts))))


def tenure_category(days) -> Column:
    """Bucket a day count; null days fall through to the last bucket."""
    days = _c(days)
    expr = None
    for bound, label in TENURE_BOUNDS:
        expr = F.when(days < bound, label) if expr is None else expr.when(days < bound, label)
    return expr.otherwise(TENURE_OTHERWISE)
