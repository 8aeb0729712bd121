"""Exact top-k search by inner product over integer vectors.

Candidates are put in order of descending length and cut into blocks. All
vectors are also rotated by the eigenvectors of the sum of ``x x^T`` over the
candidates (the right singular vectors of their matrix), which moves most of a
product into the leading coordinates. A query goes through a block from long
to short vectors. With the score of its k-th best so far as threshold it stops
where ``|q| * |x|`` falls below it; before that it sums the leading rotated
coordinates and drops every candidate whose partial sum plus the
Cauchy-Schwarz bound of the rest, ``|q_rest| * |x_rest|``, is below it. What
is left gets its exact integer product. The rotated floats only ever discard,
with a margin for rounding.

Spark orders the candidates (a range partitioning on length and id, so that
vectors of one length spread), pairs query blocks with the candidate blocks
whose longest vector can matter, and merges each query's lists. The first
thresholds come from the block of the longest vectors. Queries and candidates
may both grow: a task holds one block of each.

Rows: vectors that are null, or hold null or non-finite components, take no
part, nor do vectors of another number of components than the commonest. Equal
scores go to the smaller id; equal vectors are ordinary candidates; a repeated
id is a candidate as often as it occurs, but one query (its smallest vector in
array order). No rows give no rows. Other columns are not read. A component is
``floor(scale * x)`` in double; a product that may pass 63 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import store, table
from tillroll.llm.vectors import best_rows, main_dimension, matrix, pack, unpack, usable

BLOCK = 8192          # candidates in a block
CHUNK = 1024          # of them looked at before the thresholds are renewed
QUERY_BLOCK = 256
LEAD = 16             # leading rotated coordinates summed first
NONE = np.iinfo(np.int64).min


def _gram(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of x x^T over all vectors: dim * dim numbers from each task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column("v"), dim)
            total += x.T @ x
        at = np.arange(dim, dtype=np.int32)
        yield pa.RecordBatch.from_pydict({"i": np.repeat(at, dim), "j": np.tile(at, dim),
                                          "s": total.ravel()})

    gram = np.zeros((dim, dim))
    for r in (vectors.select("v").mapInArrow(partial, "i int, j int, s double")
              .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()):
        gram[r.i, r.j] = r.s
    return gram


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of x with q (float64 holding integers)."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if most < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    if most < 2.0 ** 63:
        return x.astype(np.int64) @ q.astype(np.int64)
    raise ArithmeticError("an inner product may not fit 64 bits")


class Best:
    """The k best (score, id) of one query: larger score first, then smaller id."""

    def __init__(self, k: int, floor: int = NONE):
        self.k, self.floor = k, floor
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)

    def threshold(self) -> int:
        return max(self.floor, int(self.score[-1])) if len(self.score) == self.k else self.floor

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((i, -s))[:self.k]
        self.score, self.id = s[order], i[order]


def search_block(q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, c_ids: np.ndarray,
                 x: np.ndarray, rotation: np.ndarray, k: int, lead: int = LEAD,
                 chunk: int = CHUNK) -> list[Best]:
    """The k best of each query among ``x``, whose rows descend in length.
    Scores below a query's floor need not be found."""
    best = [Best(k, int(f)) for f in floors]
    q_rot = q @ rotation
    q_len = np.sqrt((q * q).sum(1))
    q_rest = np.sqrt((q_rot[:, lead:] ** 2).sum(1))
    x_len = np.sqrt((x * x).sum(1))
    for start in range(0, len(x), chunk):
        part = x[start:start + chunk]
        ids = c_ids[start:start + chunk]
        limit = np.array([float(b.threshold()) for b in best])
        margin = 1e-9 * (1.0 + q_len * x_len[start])
        going = np.flatnonzero(q_len * x_len[start] + margin >= limit)
        if not len(going):
            break  # shorter vectors follow
        rot = part @ rotation
        rest = np.sqrt((rot[:, lead:] ** 2).sum(1))
        bound = q_rot[going, :lead] @ rot[:, :lead].T + q_rest[going, None] * rest
        keep = (bound + margin[going, None] >= limit[going, None]) & (ids != q_ids[going, None])
        for row, j in zip(keep, going):
            at = np.flatnonzero(row)
            if len(at):
                best[j].add(products(part[at], q[j]), ids[at])
    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id",
          vector: str = "embedding", scale: float = 1024.0, lead: int = LEAD,
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k
    largest integer inner products with the other rows of ``vectors``.

    Both tables have the columns ``vec_id`` and ``vector``; a query's own id is
    no candidate of it.
    """
    def integers(df: DataFrame) -> DataFrame:
        return usable(df, vec_id, vector).select(
            "id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).cast("array<double>").alias("v"))

    candidates = integers(vectors)
    dim = main_dimension(candidates)
    if not dim:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    candidates = candidates.where(F.size("v") == dim)
    asked = integers(queries).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    size, vectors_of = np.linalg.eigh(_gram(candidates, dim))
    rotation = np.ascontiguousarray(vectors_of[:, np.argsort(-size)])
    lead = min(lead, dim)

    # The id takes part in the order: vectors of equal length, copies among
    # them, are dealt over several partitions.
    short = F.aggregate("v", F.lit(0.0), lambda a, x: a - x * x)
    parts = max(1, -(-candidates.count() // block))
    ordered = (candidates.withColumn("short", short).repartitionByRange(parts, "short", "id")
               .sortWithinPartitions("short", "id"))
    blocks = store(pack(ordered, dim, block), "topk-blocks").select(
        F.col("block").alias("c_block"), F.col("ids").alias("c_ids"),
        F.col("vectors").alias("c_vectors"))
    first = F.broadcast(blocks.orderBy("c_block").limit(1))  # one block, the longest vectors
    query_parts = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = pack(asked.repartition(query_parts, "id"), dim, QUERY_BLOCK).drop("n", "block")

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            q_ids, q = unpack(r["ids"], r["vectors"], dim)
            c_ids, x = unpack(r["c_ids"], r["c_vectors"], dim)
            best = search_block(q_ids, q, np.full(len(q), NONE), c_ids, x, rotation, k, lead)
            floors = np.array([b.threshold() for b in best], np.int64)
            yield pa.RecordBatch.from_pydict({
                "ids": [r["ids"]], "vectors": [r["vectors"]], "floors": [floors.tobytes()],
                "least": [float(floors.min())], "reach": [float(np.sqrt((q * q).sum(1).max()))]})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            q_ids, q = unpack(r["ids"], r["vectors"], dim)
            c_ids, x = unpack(r["c_ids"], r["c_vectors"], dim)
            best = search_block(q_ids, q, np.frombuffer(r["floors"], np.int64), c_ids, x, rotation, k, lead)
            yield pa.RecordBatch.from_pydict({
                "query_id": np.repeat(q_ids, [len(b.id) for b in best]),
                "vec_id": np.concatenate([b.id for b in best]),
                "score": np.concatenate([b.score for b in best])})

    seeded = store(packed.crossJoin(first).mapInArrow(
        seed, "ids binary, vectors binary, floors binary, least double, reach double"), "topk-queries")
    longest = _longest(blocks, dim)
    # Blocks against blocks: a pair is left out when its longest vectors
    # cannot reach the lowest threshold.
    pairs = seeded.join(longest, F.col("reach") * F.col("longest") * (1 + 1e-9) + 1 >= F.col("least"))
    found = pairs.drop("least", "reach", "longest").mapInArrow(search, "query_id long, vec_id long, score long")
    return best_rows(found, k)


def _longest(blocks: DataFrame, dim: int) -> DataFrame:
    """Blocks with the length of their first, longest vector."""
    @F.arrow_udf("double")
    def length(column: pa.Array) -> pa.Array:
        return pa.array([float(np.sqrt((np.frombuffer(v.as_py(), np.float64, dim) ** 2).sum()))
                         for v in column], pa.float64())

    return blocks.withColumn("longest", length("c_vectors"))


def nearest_products(spark, sf_dir: str, k: int = 10) -> DataFrame:
    """The rows of ``embeddings`` whose id is divisible by 100, against all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k)
