"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` is the fact-to-dimension join of the pipeline (sales to
customers, rows to their rank). Whether a side is broadcast is left to Spark,
which goes by bytes. On top of that:

* a key that holds at least ``1 / HOT_SHARE`` of the fact rows is hot. By
  counting, at most HOT_SHARE keys can be, whatever the size of the data. NULL
  and NaN count as keys here, though they match nothing;
* the dimension rows of hot keys are broadcast and joined to the hot fact rows
  where these lie, without a shuffle, so even equal rows stay spread. If they
  are more than DIM_ROWS, the fact rows of a hot key are dealt over salts, one
  for each ``hot_rows`` of them, and its dimension rows are repeated for every
  salt: no task gets more than about ``hot_rows`` rows of a hot key;
* all other fact rows go through the ordinary join, where no key holds more
  than ``1 / HOT_SHARE`` of the rows.

Facts that are neither stored nor given with ``key_rows`` are not run a second
time just to be counted: they take the ordinary join, in which Spark's
adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import is_stored, stored

HOT_SHARE = 1000
# Keys with fewer rows than this fit a task anyway.
HOT_ROWS = 1_000_000
# Dimension rows of hot keys that are broadcast at most; more are salted.
DIM_ROWS = 100_000


def _hot_counts(rows: DataFrame, keys: Sequence[str], hot_rows: int, share: int) -> list[Row]:
    """Hot keys with their rows ``__n``, ``share`` at most: one aggregation over
    the key columns (a hot key is one row per map task before the shuffle), of
    which each task hands on its ``share`` largest; a count of the rows only if
    some key reaches ``hot_rows``."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= hot_rows)
    top = counts.orderBy(F.desc("__n")).limit(share).collect()
    if not top:
        return []
    total = rows.count()
    return [r for r in top if r["__n"] * share >= total]


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS,
             share: int = HOT_SHARE) -> DataFrame:
    """Keys with at least ``hot_rows`` rows and ``1 / share`` of all rows: at
    most ``share`` keys, with their rows ``__n``."""
    narrow = rows.select(*keys)
    return _key_frame(narrow, _hot_counts(narrow, keys, hot_rows, share))


def _key_frame(narrow: DataFrame, counts: list[Row]) -> DataFrame:
    schema = T.StructType([*narrow.schema.fields, T.StructField("__n", T.LongType())])
    return narrow.sparkSession.createDataFrame(counts, schema)


def salted(facts: DataFrame, dim: DataFrame, hot: DataFrame, keys: Sequence[str],
           hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """The fact rows of hot keys with a ``__salt``, and the dimension rows of
    hot keys once for every salt of theirs.

    A fact row's salt is its place in the stored files, which is the same
    however often a task runs; equal rows get different salts.
    """
    salts = F.broadcast(hot.withColumn("__salts", F.ceil(F.col("__n") / hot_rows).cast("int")).drop("__n"))
    place = F.xxhash64(F.monotonically_increasing_id())
    left = (facts.withColumn("__place", place).join(salts.toDF(*[f"__{k}" for k in keys], "__salts"),
                                                    reduce(lambda a, b: a & b, [
                                                        F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]))
            .withColumn("__salt", F.pmod("__place", "__salts").cast("int"))
            .drop("__place", "__salts", *[f"__{k}" for k in keys]))
    right = (dim.join(salts, list(keys))
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts"))
    return left, right


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left",
                key_rows: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fact-to-dimension equi-join, balanced under key skew (see module doc).

    ``how`` is ``left`` or ``inner``. ``key_rows`` is a cheaper frame to count
    the keys on (rows more than the facts do no harm).

    Output columns: fact columns, then dimension columns minus the keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join does left and inner joins, not {how!r}")
    keys = list(keys)
    if key_rows is None and not is_stored(facts):
        return facts.join(dim, keys, how)
    counted = (facts if key_rows is None else key_rows).select(*keys)
    counts = _hot_counts(counted, keys, hot_rows, HOT_SHARE)
    if not counts:
        return facts.join(dim, keys, how)
    hot = _key_frame(counted, counts)
    few = F.broadcast(hot.select(*keys))
    hot_dim = stored(dim.join(few, keys, "left_semi"), "hot")
    facts = facts if is_stored(facts) else stored(facts, "facts")
    columns = [*facts.columns, *[c for c in dim.columns if c not in keys]]
    if hot_dim.count() <= DIM_ROWS:
        there = facts.join(few, _same(facts, few, keys), "left_semi").join(F.broadcast(hot_dim), keys, how)
    else:
        left, right = salted(facts, hot_dim, hot, keys, hot_rows)
        there = left.join(right, [*keys, "__salt"], how)
    rest = facts.join(few, _same(facts, few, keys), "left_anti").join(dim, keys, how)
    return there.select(*columns).unionAll(rest.select(*columns))
