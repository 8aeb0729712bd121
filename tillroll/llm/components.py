"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import lookup_split, store


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component.

    Alternating stars: a node links its larger neighbours to its smallest one,
    then its smaller neighbours. The rounds grow with the logarithm of a
    component's size. The edges of a node with very many neighbours are not
    sent to one task (``lookup_split``). Each round is stored, so no plan grows and a lost executor costs one round.
    """
    now = store(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        large = _star(now, True)
        now = store(_star(large, False).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                       F.bit_xor(F.xxhash64("b", "a"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours to the smallest of a node's neighbours and
    itself. Small star: smaller neighbours (and the node) to the smallest."""
    both = edges.union(edges.select("b", "a")) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")).select(
        "a", F.least("a", "least").alias("m"), "n")
    # a node with very many neighbours is a hot key of this join
    joined = lookup_split(both, least, ["a"], "n", both.count(), F.xxhash64("b"))
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b")
