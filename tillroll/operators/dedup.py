"""Keyed de-duplication with an explicit order (keep the first row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``. NULL keys are one key.

    ``row_number() = 1`` lets Catalyst plan a partial ``WindowGroupLimit``
    below the shuffle: every map task keeps only its first row per key, so a
    key holding a third of the rows is already one row per task when it
    reaches the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RN, F.row_number().over(w)).where(F.col(RN) == 1).drop(RN)
