"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import hashing
from tillroll.session import checkpoint_dir

# A key holding at least 1/HOT_SHARE of all rows is "hot"; by counting, at
# most HOT_SHARE keys can be.
HOT_SHARE = 1000


def store(df: DataFrame, label: str, codec: str = "zstd", options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) into the shared
    checkpoint folder and read it back.

    This cuts the lineage without a machine-local copy: the files outlive any
    executor, and what reads them sees one fixed version of the rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tillroll-{label}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes of rows that Spark hands to a Python worker at a time (one row at least).
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Python workers receive rows in batches of BATCH_BYTES, not of 10,000 whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def returns_memory(work: Callable) -> Callable:
    """A worker's function over batches that gives freed memory back to the
    system when its task ends: Spark keeps the worker for the next task, and
    what it holds would add to the tasks of other stages."""
    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            hashing.forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim is not None:
                trim(0)

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def internal(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Number the rows (not gapless), so that equal rows stay apart.

    The number comes from a row's place in its partition, and that place changes
    between jobs, on a plain scan too: the cuts of a scan depend on the cores
    registered just then. So the numbered rows are stored, and every later pass
    reads the same numbers.
    """
    return store(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def text_or_empty(col: str | Column) -> Column:
    """The column as a string, null as the empty text."""
    c = F.col(f"`{col}`") if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def sized_slices(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut 0..len(sizes) into runs of at most ``limit`` in total (one item at least)."""
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if i > start and total + s > limit:
            yield start, i
            start, total = i, 0
        total += int(s)
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(column: pa.Array) -> tuple[bytes, "object"]:
    """The bytes of a string or binary array without nulls, and its offsets (numpy)."""
    import numpy as np

    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    body = memoryview(data)[int(offsets[0]):int(offsets[-1])] if data is not None and len(column) else b""
    return body, offsets - (offsets[0] if len(offsets) else 0)


def lookup_split(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], count: str, total: int,
                 spread: Column) -> DataFrame:
    """Left join of ``rows`` to ``keyed`` (one row per key), with hot keys split.

    ``keyed[count]`` is the number of ``rows`` of a key and ``total`` the number
    of rows. Keys with ``1 / HOT_SHARE`` of the rows, of which there cannot be
    more than HOT_SHARE, are broadcast. Their rows then take part in the
    shuffled join under a key that matches nothing, dealt out by ``spread``; so
    do rows with a null key, which match nothing either.
    The columns of ``keyed`` besides the keys must not occur in ``rows``.
    """
    values = [c for c in keyed.columns if c not in keys]
    hot_, rest_, salt = internal(rows, "__hot_value", "__rest_value", "__salt")
    packed = F.struct(*[F.col(v) for v in values])
    is_hot = F.col(count) * HOT_SHARE >= F.lit(total)
    hot = F.broadcast(keyed.where(is_hot).select(*keys, packed.alias(hot_)))
    rest = keyed.where(~is_hot).select(*keys, F.lit(0).alias(salt), packed.alias(rest_))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    joined = (rows.join(hot, list(keys), "left")
              .withColumn(salt, F.when(F.col(hot_).isNull() & known, F.lit(0)).otherwise(
                  F.pmod(spread, F.lit(1_000_000)).cast("int") + 1))
              .join(rest, [*keys, salt], "left"))
    both = F.coalesce(F.col(hot_), F.col(rest_))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns],
                         *[both[v].alias(v) for v in values])
