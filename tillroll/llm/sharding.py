"""Two-pass external shuffle into shards.

Pass 1 scatters the records over memory-sized buckets by a seeded hash of
their content. Pass 2 loads one bucket at a time, brings it into a canonical
order, shuffles it by Fisher-Yates with a seed of its own, and hands it on with
global positions: the buckets one after another. Shard ``s`` of ``n`` takes a
consecutive range of the positions, ranges at most one apart in length (the
law ``rows``), so a bucket is written straight into its one or few shards and
no record is moved a second time.

The bucket of a record and the order inside a bucket depend on the records and
the seed only, so a task that runs again gives the same rows.

Rows: nulls in any column are ordinary values. Records that are equal in every
column are interchangeable; where their copies weigh more than an eighth of a
bucket they are numbered and scattered by their number, so no group of copies
fills a bucket. Copies of a text under other ids scatter like any rows. A very
long text is a record like any other and makes its bucket larger by its own
size. An empty table gives an empty table. Columns pass through; the columns
``shard`` and ``slot`` replace input columns of those names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import internal, lookup_split, shuffle_partitions, store

BUCKET_BYTES = 8 << 20
TASK_BYTES = 64 << 20     # of buckets, one after another in a task
COPIES = 4096             # equal records that one row is unfolded to at a time
HEAVY_ROWS = 1_000_000    # kinds of heavy copies (24 bytes each) that are broadcast
SPAN = 4096               # buckets in a range of the running count


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0..n-1 (numpy's generator shuffles by Fisher-Yates)."""
    order = np.arange(n)
    np.random.default_rng(seed).shuffle(order)
    return order


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, size: str | None = None,
                        bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot``
    (its place in the shard, gapless from 0).

    ``size`` names a column with a row's bytes; without it the bytes of the
    string and binary columns plus 16 count. One narrow pass over ``df`` counts
    records and bytes by content; a second one moves the records.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    bucket, order, check, number, before, count, dealt = internal(
        df, "__bucket", "__order", "__check", "__number", "__before", "__count", "__dealt")
    cols = [F.col(f"`{c}`") for c in df.columns]
    if size is None:
        heavy = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields
                 if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        weight = sum((F.coalesce(h, F.lit(0)) for h in heavy), F.lit(16)).cast("long")
    else:
        weight = F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0))
    hashed = df.withColumn(order, F.xxhash64(F.lit(seed), *cols)) \
               .withColumn(check, F.xxhash64(F.lit(seed + 2), *cols))
    copies = store(hashed.withColumn(count, weight).groupBy(order, check)
                   .agg(F.count(F.lit(1)).alias("n"), F.sum(count).alias("bytes")), "shard-copies")
    n_bytes, n_rows = copies.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-int(n_bytes) // bucket_bytes))
    parts = max(min(buckets, shuffle_partitions(spark)), -(-int(n_bytes) // TASK_BYTES))
    is_heavy = (F.col("n") > 1) & (F.col("bytes") * 8 > bucket_bytes)

    def scattered(rows: DataFrame) -> DataFrame:
        return rows.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), order, number), F.lit(buckets)))

    def numbered(rows: DataFrame, n: str) -> DataFrame:
        """Each row ``n`` times, with numbers from 0; no task unfolds more than COPIES of a row."""
        return (rows.withColumn(number, F.explode(F.sequence(F.lit(0), F.col(n) - 1, F.lit(COPIES))))
                .repartition(parts, order, number)
                .withColumn(number, F.explode(F.sequence(
                    F.col(number), F.least(F.col(number) + COPIES, F.col(n)) - 1))))

    light = hashed.withColumn(number, F.lit(0).cast("long"))
    kinds = copies.where(is_heavy).select(order, check, F.col("n").alias(count))
    n_kinds = kinds.count()
    held = scattered(copies.where(~is_heavy).withColumn(number, F.lit(0).cast("long"))).select(bucket, "n")
    if n_kinds:
        if n_kinds <= HEAVY_ROWS:
            marked = hashed.join(F.broadcast(kinds), [order, check], "left")
        else:
            marked = lookup_split(hashed, kinds.withColumn(dealt, F.col(count)), [order, check], dealt,
                                  int(n_rows), F.col(check)).drop(dealt)
        light = marked.where(F.col(count).isNull()).drop(count).withColumn(number, F.lit(0).cast("long"))
        # equal records shrink to one and a count where they lie, then unfold by number
        one, many = internal(marked, "__record", "__many")
        folded = (marked.where(F.col(count).isNotNull()).groupBy(order, check)
                  .agg(F.first(F.struct(*cols)).alias(one), F.count(F.lit(1)).alias(many)))
        light = light.unionByName(numbered(folded, many).select(
            *[F.col(f"{one}.`{c}`").alias(c) for c in df.columns], order, check, number))
        held = held.unionByName(scattered(numbered(kinds, count)).select(bucket, F.lit(1).cast("long").alias("n")))
    starts = _running(held.groupBy(bucket).agg(F.sum("n").alias("n")), bucket, before)
    wanted = T.StructType([*df.schema.fields, T.StructField("shard", T.IntegerType()),
                           T.StructField("slot", T.LongType())])
    total, kept = int(n_rows), df.columns

    def one_bucket(records: pa.Table) -> pa.Table:
        records = records.combine_chunks()
        b, start = records[bucket][0].as_py(), records[before][0].as_py()
        canonical = np.lexsort((records[check].to_numpy(), records[order].to_numpy()))
        shuffled = canonical[fisher_yates(len(records), seed * 1_000_003 + b)]
        place = start + np.arange(len(records), dtype=np.int64)
        shard = _shard_of(place, total, shards)
        slot = place - _shard_start(shard, total, shards)
        out = records.select(kept).take(pa.array(shuffled))
        return out.append_column("shard", pa.array(shard.astype(np.int32))) \
                  .append_column("slot", pa.array(slot))

    return (scattered(light).drop(number).repartition(parts, bucket)
            .join(starts.repartition(parts, bucket), bucket)
            .groupBy(bucket).applyInArrow(one_bucket, wanted))


def _running(counts: DataFrame, bucket: str, before: str) -> DataFrame:
    """(bucket, before): the records of all buckets with smaller numbers. Sums run
    inside ranges of SPAN buckets; one task sees a row per range."""
    def earlier(window, what: str):
        return F.coalesce(F.sum(what).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    counts = counts.withColumn("span", F.floor(F.col(bucket) / SPAN))
    spans = counts.groupBy("span").agg(F.sum("n").alias("held")) \
        .withColumn("base", earlier(Window.orderBy("span"), "held"))
    inside = counts.withColumn("inside", earlier(Window.partitionBy("span").orderBy(bucket), "n"))
    return inside.join(spans, "span").select(bucket, (F.col("base") + F.col("inside")).cast("long").alias(before))


def _shard_start(shard: np.ndarray, total: int, shards: int) -> np.ndarray:
    """First position of a shard; the first ``total % shards`` shards are one longer."""
    small, longer = divmod(total, shards)
    return shard * small + np.minimum(shard, longer)


def _shard_of(place: np.ndarray, total: int, shards: int) -> np.ndarray:
    small, longer = divmod(total, shards)
    edge = longer * (small + 1)
    late = longer + (place - edge) // max(small, 1)
    return np.where(place < edge, place // (small + 1), late)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the result of :func:`shuffle_into_shards` as one folder per shard.

    Rows leave a bucket in shuffled order and each bucket lies in one shard, or
    in a few neighbouring ones, so nothing is shuffled again. ``slot`` is kept
    in the files, for readers that want the order over several files.
    """
    sharded.write.partitionBy("shard").parquet(path)


def assignments(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sharded = shuffle_into_shards(docs, shards, seed)
    return sharded.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
