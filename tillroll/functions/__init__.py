"""Column expressions (JVM-side, codegen'd) shared by the stages."""

from tillroll.functions.dates import (
    calendar_days, day_name, elapsed_days, hour_of_day, tenure_category,
)
from tillroll.functions.ids import prefixed_id, zero_pad
from tillroll.functions.money import exact_mean, exact_sum, money, money_total, round_half_even
from tillroll.functions.values import nan_to_null, not_nan_nonneg, storage_type

__all__ = [
    "calendar_days", "day_name", "elapsed_days", "hour_of_day", "tenure_category",
    "prefixed_id", "zero_pad",
    "exact_mean", "exact_sum", "money", "money_total", "round_half_even",
    "nan_to_null", "not_nan_nonneg", "storage_type",
]
