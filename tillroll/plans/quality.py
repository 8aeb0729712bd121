"""Per-stage run metadata (ingest receipts), as one-row DataFrames.

The cleaning, enrichment and summary figures live next to their stages
(``clean.cleaning_metrics``, ``enrich.enrichment_metrics``,
``metrics.summary_metrics``, ``metrics.top_product``,
``metrics.customer_summary``); this module adds the ingest receipts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_metrics(raw: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row: row_count, column_count, columns, duplicate_count.

    Duplicates are counted, not assumed: rows minus distinct keys, NULL being
    one key. One partially aggregated pass (a hot key is one row per task).
    """
    per_key = raw.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.lit(len(raw.columns)).cast("bigint").alias("column_count"),
        F.lit(",".join(raw.columns)).alias("columns"),
        F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicate_count"))


def ingest_of(spark: SparkSession, rows: int, columns: Sequence[str], duplicates: int) -> DataFrame:
    """The row of ``ingest_metrics`` from a write's receipt and the copies that
    the de-duplication by the same key has removed."""
    return spark.createDataFrame([(rows, len(columns), ",".join(columns), duplicates)],
                                 "row_count long, column_count long, columns string, duplicate_count long")


def row_count(df: DataFrame) -> DataFrame:
    """One row: row_count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
