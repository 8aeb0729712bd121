"""Row-selective updates, copies and samples used to shape source data.

Predicates are expressions of the row (key arithmetic), never ``rand()``:
a recomputed partition must make the same choice, or a retried task could
duplicate or lose rows downstream of a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.ids import FINE_MOD, fine_scatter


def mask_to_null(df: DataFrame, col: str, predicate: Column) -> DataFrame:
    """Set ``col`` to NULL where ``predicate`` holds."""
    return df.withColumn(col, F.when(predicate, F.lit(None)).otherwise(F.col(col)))


def negate_where(df: DataFrame, col: str, predicate: Column) -> DataFrame:
    """Flip the sign of ``col`` where ``predicate`` holds."""
    return df.withColumn(col, F.when(predicate, -F.col(col)).otherwise(F.col(col)))


def copy_where(df: DataFrame, predicate: Column, copies: int = 1, copy_col: str | None = None) -> DataFrame:
    """Emit every row once more (``copies`` times) where ``predicate`` holds.

    Same result as ``df.unionByName(df.where(predicate))`` but in one pass:
    the source is scanned (and its joins run) once instead of twice.
    ``copy_col`` keeps the number of the copy (0 for the row itself).
    """
    name = copy_col or "__copy"
    n = F.when(predicate, F.lit(copies)).otherwise(F.lit(0))
    out = df.withColumn(name, F.explode(F.sequence(F.lit(0), n)))
    return out if copy_col else out.drop(name)


def append_picked(df: DataFrame, picked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` and once more its rows whose key is in ``picked`` (few, distinct
    keys, which are broadcast): one pass over ``df``."""
    marked = df.join(F.broadcast(picked.withColumn("__again", F.lit(True))), list(keys), "left")
    return copy_where(marked, F.coalesce("__again", F.lit(False))).select(*df.columns)


def sample_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, without replacement, repeatable.

    ``order`` should scatter the rows (key arithmetic) and end with a unique
    key. ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own best ``n``, so only ``n x tasks`` rows are merged.
    """
    return df.orderBy(*order).limit(n)


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str]) -> DataFrame:
    """Bernoulli sample of about ``fraction`` of the rows, by integer keys: a
    row's choice depends on its keys alone, not on the partitioning."""
    return df.where(fine_scatter(*[F.col(k) for k in keys]) < F.lit(int(fraction * FINE_MOD)))
