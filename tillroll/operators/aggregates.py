"""Aggregate building blocks (all partially aggregated map-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.dedup import keep_first
from tillroll.session import stored


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_null(df: DataFrame, key: str, value: str, order: Sequence) -> DataFrame:
    """(key, value): the first non-null ``value`` of each key in ``order``.

    A top-1 per key on the few columns it needs: each task keeps one row per
    key before the shuffle, and no wide rows are sorted.
    """
    narrow = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(
        key, value, *[_c(o).alias(f"__o{i}") for i, o in enumerate(order)])
    return keep_first(narrow, [key], [F.col(f"__o{i}") for i in range(len(order))]).select(key, value)


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value of ``col`` (nulls dropped, as a value count does)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def value_counts_map(df: DataFrame, col: str, out: str) -> DataFrame:
    """One row, one ``map<value, bigint>`` column: an entry per distinct value,
    so it is for columns with few values (a tier, a status)."""
    return value_counts(df, col, "__n").agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct(F.col(col), F.col("__n"))))).alias(out))


def share_of_total(df: DataFrame, part: str, out: str, total_of: Column | None = None,
                   materialize: bool = True) -> DataFrame:
    """``out = part / sum(part over all rows)``; NULL when the total is 0.

    The grand total is a scalar subquery, not a window over all rows (which
    would put every row in one task) and not a join. ``df`` is usually an
    aggregate; ``materialize`` stores it first so the rows and their
    total come from one computation of the upstream plan (after column
    pruning the two would otherwise differ and be computed twice).
    ``total_of`` overrides the summed expression (e.g. an exact decimal).
    """
    if materialize:
        df = stored(df, "parts")
    expr = total_of if total_of is not None else F.col(part)
    total = df.agg(F.sum(expr).cast("double").alias("__total")).scalar()
    return df.withColumn(out, F.try_divide(F.col(part), F.when(total != 0, total)))
