"""Value normalisation and storage types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL (floating columns only)."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def not_nan_nonneg(c) -> Column:
    """``c >= 0`` with NaN and NULL counted as invalid (Spark alone says NaN >= 0)."""
    c = _c(c)
    return F.coalesce((c >= 0) & ~F.isnan(c), F.lit(False))


def storage_type(dt: T.DataType) -> T.DataType:
    """The stored type of a column: six families, refuse the rest.

    integral -> bigint, floating/decimal -> double, boolean, timestamp (any)
    -> timestamp_ntz, date, string.
    """
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(dt, T.BooleanType):
        return T.BooleanType()
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if isinstance(dt, T.DateType):
        return T.DateType()
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return T.StringType()
    raise TypeError(f"no storage type for {dt.simpleString()}")
