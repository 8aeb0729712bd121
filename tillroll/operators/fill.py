"""Null filling."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a literal, per column (other columns untouched, order kept)."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])


def fill_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """Replace NULL in ``target`` by the value of ``source`` on the same row."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))
