"""Tables of vectors: which rows take part, and packed blocks of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PACKED = "block long, n int, ids binary, vectors binary"


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id long, v array<double>) of rows with an id and a vector of finite numbers."""
    v = F.col(f"`{vector}`").cast("array<double>")
    return (df.where(F.col(f"`{vector}`").isNotNull() & F.col(f"`{vec_id}`").isNotNull())
            .select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v"))
            .where((F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)
                                                 | (F.abs(x) == float("inf")))))


def main_dimension(vectors: DataFrame) -> int:
    """The commonest number of components (the smaller of a tie; 0 without rows)."""
    row = (vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), "d").first())
    return int(row["d"]) if row else 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def numbered(rows: DataFrame) -> DataFrame:
    """(id, v) with the number that ``blocks`` names its blocks by."""
    return rows.select("id", "v", F.monotonically_increasing_id().alias("at"))


def blocks(batches: Iterator[pa.RecordBatch], dim: int, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``size`` consecutive ``numbered`` rows, each a row of PACKED."""
    ids, vectors, count, first = [], [], 0, 0

    def one() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([first]), pa.array([count], pa.int32()), binary(np.concatenate(ids)),
             binary(np.concatenate(vectors))], names=["block", "n", "ids", "vectors"])

    for b in batches:
        x, i, number = matrix(b.column("v"), dim), b.column("id").to_numpy(), b.column("at").to_numpy()
        done = 0
        while done < len(i):
            first = first if count else int(number[done])
            take = min(size - count, len(i) - done)
            ids.append(i[done:done + take])
            vectors.append(x[done:done + take])
            count, done = count + take, done + take
            if count == size:
                yield one()
                ids, vectors, count = [], [], 0
    if count:
        yield one()


def binary(x: np.ndarray) -> pa.Array:
    """The bytes of an array as the one value of a column, not copied."""
    x = np.ascontiguousarray(x)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, x.nbytes], np.int32)),
                                                  pa.py_buffer(x)])


def pack(rows: DataFrame, dim: int, size: int) -> DataFrame:
    """Blocks of at most ``size`` consecutive rows of a partition of (id, v)."""
    return numbered(rows).mapInArrow(lambda batches: blocks(batches, dim, size), PACKED)


def unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(-1, dim)


def best_rows(lists: DataFrame, k: int) -> DataFrame:
    """The k best rows per query: largest score first, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
