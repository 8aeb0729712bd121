"""The best row by a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arg_max(df: DataFrame, value: str, cols: Sequence[str], tie_break: Sequence[Column] = ()) -> DataFrame:
    """The row with the largest ``value`` (ties broken by ``tie_break``), as
    one row of ``cols``; empty input gives no row."""
    order = [F.col(value).desc_nulls_last(), *tie_break]
    return df.where(F.col(value).isNotNull()).orderBy(*order).limit(1).select(*cols)
