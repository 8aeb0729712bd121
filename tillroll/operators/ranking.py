"""Global ranks and positions without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` sends every row to one task.
Here the sort keys are dealt into ranges by ``repartitionByRange``, the range
number is stored with each row (so every later job and every retried task sees
the same ranges), and the totals of the ranges, one row each, give every range
the weight of all ranges before it. Inside a range a running sum finishes the
job. The number of ranges follows from the number of keys; there is one path
for every size.

Average ranks (ties share the mean of their positions) first collapse equal
values into one row with their multiplicity, a partially aggregated
``groupBy``: a value held by a third of the rows is one row per map task
before any shuffle, and one row in its range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.joins import HOT_ROWS, lookup_join
from tillroll.session import stored_with

KEYS_PER_RANGE = 1_000_000


def running_total_before(df: DataFrame, key: Sequence[Column], weight: Column, out: str, rows: int,
                         keys_per_range: int = KEYS_PER_RANGE) -> tuple[DataFrame, int]:
    """Add ``out`` = sum of ``weight`` over all rows whose ``key`` is smaller;
    also return the greatest weight.

    ``key`` is a list of ascending-orderable expressions (encode a descending
    or nulls-last order in them) that no two rows share; ``rows`` is the number
    of rows of ``df`` or a bound of it. ``df`` is stored once, by range, in one
    job (and one that samples the keys, if there are several ranges).
    """
    names = [f"__k{i}" for i in range(len(key))]
    keyed = df.withColumns(dict(zip(names, key)) | {"__w": weight})
    ranges = max(1, math.ceil(rows / keys_per_range))
    dealt = keyed.repartitionByRange(ranges, *[F.col(n) for n in names]) if ranges > 1 else keyed.repartition(1)
    ranged, seen = stored_with(dealt.withColumn("__range", F.spark_partition_id()), "ranges",
                               most=F.coalesce(F.max("__w"), F.lit(0)).cast("long"))
    upto = Window.partitionBy("__range").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so a window over them is one small task
    totals = ranged.groupBy("__range").agg(F.sum("__w").alias("__total"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    return (ranged.join(offsets, "__range")
            .withColumn(out, F.col("__offset") + F.coalesce(F.sum("__w").over(upto), F.lit(0)))
            .drop("__range", "__w", "__offset", *names)), seen.get("most", 0)


def _valid(df: DataFrame, value: str) -> Column:
    c = F.col(value)
    if isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def average_rank(df: DataFrame, value: str, out: str, descending: bool = True,
                 keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
    """Add ``out``: rank of ``value`` (1 = largest when ``descending``), ties
    get the mean of their positions, NULL/NaN keep a NULL rank. Double.

    ``df`` is stored first (in the session's shared checkpoint folder): the
    rank needs a few passes over it and should not recompute the upstream plan
    for each. Counts are taken as the rows are written, so building the rank
    runs two jobs (three with several ranges).
    """
    rows, seen = stored_with(df, "rank", valid=F.count_if(_valid(df, value)),
                             invalid=F.count_if(~_valid(df, value)))
    total = seen.get("valid", 0)
    values = rows.where(_valid(rows, value)).groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    placed, most = running_total_before(values, [F.col("__v")], F.col("__n"), "__before", total, keys_per_range)
    ascending = F.col("__before") + (F.col("__n") + 1) / 2.0
    # descending rank = N + 1 - ascending rank (exact: integers and halves);
    # no negated key, so any orderable type works and no value can overflow
    rank = (F.lit(total + 1) - ascending) if descending else ascending
    ranked = placed.select(F.col("__v").alias(value), rank.cast("double").alias(out))
    # no value frequent enough to be split: no need to look for one (a null or
    # NaN matches nothing, and the rows without a value count as one more)
    if max(most, seen.get("invalid", 0)) < HOT_ROWS:
        return rows.join(ranked, value, "left").select(*df.columns, out)
    return lookup_join(rows, ranked, [value], "left").select(*df.columns, out)


def positions(df: DataFrame, order: Sequence[Column], out: str,
              keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (bigint).

    ``order`` must be a total order (end it with a unique key) written as
    ascending expressions; e.g. nulls last is ``(c.isNull(), c)``.
    """
    rows, seen = stored_with(df, "positions", n=F.count(F.lit(1)))
    d, _ = running_total_before(rows, order, F.lit(1).cast("bigint"), "__before", seen.get("n", 0), keys_per_range)
    return d.withColumn(out, (F.col("__before") + 1).cast("bigint")).drop("__before")
