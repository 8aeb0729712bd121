"""Stage 1: cleaned sales.

Order of steps matters and is kept: de-duplicate, fill missing customer ids,
drop invalid prices, fix types, derive columns. De-duplicating before the
price filter means a transaction whose surviving copy has a bad price is
dropped entirely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import day_name, hour_of_day
from tillroll.functions.money import exact_mean, exact_sum
from tillroll.functions.values import not_nan_nonneg
from tillroll.operators.dedup import keep_first
from tillroll.operators.fill import fill_literals
from tillroll.session import is_stored, stored

# Fixed value.
UNKNOWN_CUSTOMER = "UNKNOWN"
DEDUP_KEYS = ["transaction_id"]

CLEANED_COLUMNS = ["transaction_id", "customer_id", "product_id", "quantity", "unit_price",
                   "transaction_date", "region", "total_amount", "transaction_date_only",
                   "hour_of_day", "day_of_week"]


def dedup_order() -> list[Column]:
    """Total order deciding which copy of a transaction is kept (ascending)."""
    return [F.col("transaction_date"), F.col("product_id"),
            F.col("customer_id").asc_nulls_last(), F.col("quantity"),
            F.col("unit_price"), F.col("region")]


def dedup_transactions(raw: DataFrame) -> DataFrame:
    return keep_first(raw, DEDUP_KEYS, dedup_order())


def fill_missing_customer(df: DataFrame) -> DataFrame:
    return fill_literals(df, {"customer_id": UNKNOWN_CUSTOMER})


def filter_valid_price(df: DataFrame) -> DataFrame:
    return df.where(not_nan_nonneg("unit_price"))


def cast_types(df: DataFrame) -> DataFrame:
    """Fix the column types. A NULL quantity is an error, as a failed integer
    cast would be (Spark's cast alone would let it through)."""
    q = F.col("quantity")
    return (df.withColumn("transaction_date", F.col("transaction_date").cast("timestamp_ntz"))
            .withColumn("quantity", F.when(q.isNull(), F.raise_error(F.lit("quantity is NULL")))
                        .otherwise(q.cast("bigint")).cast("bigint"))
            .withColumn("unit_price", F.col("unit_price").cast("double")))


def derive_sale_columns(df: DataFrame) -> DataFrame:
    ts = F.col("transaction_date")
    return (df.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))
            .withColumn("transaction_date_only", F.to_date(ts))
            .withColumn("hour_of_day", hour_of_day(ts))
            .withColumn("day_of_week", day_name(ts)))


def _after_dedup(kept: DataFrame) -> DataFrame:
    df = fill_missing_customer(kept)
    df = filter_valid_price(df)
    df = cast_types(df)
    return derive_sale_columns(df).select(*CLEANED_COLUMNS)


def cleaned_sales(raw: DataFrame) -> DataFrame:
    return _after_dedup(dedup_transactions(raw))


def cleaned_with_figures(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``cleaned_sales(raw)``, and its figures as a by-product of writing it.

    They are observed behind the shuffle of the de-duplication, so in the tasks
    that write: Spark counts each of those once, however often one is run. What
    lies before a shuffle is not observed; a lost executor would count it twice.
    """
    figures = Observation("cleaning")
    kept = dedup_transactions(raw)
    return _after_dedup(kept.observe(figures, *_figures())), figures


def _figures() -> list[Column]:
    """Additive figures of the rows that the de-duplication keeps."""
    valid = not_nan_nonneg("unit_price")
    amount = F.when(valid, F.col("quantity").cast("bigint") * F.col("unit_price"))
    return [F.count(F.lit(1)).alias("kept"),
            F.count_if(valid).cast("bigint").alias("final_rows"),
            F.count_if(F.col("customer_id").isNull()).cast("bigint").alias("missing_values_filled"),
            F.count_if(~valid).cast("bigint").alias("invalid_prices_removed"),
            exact_sum(amount).alias("total_revenue"),
            exact_mean(amount).alias("avg_transaction_value")]


METRICS_SCHEMA = ("initial_rows long, final_rows long, duplicates_removed long, missing_values_filled long, "
                  "invalid_prices_removed long, total_revenue double, avg_transaction_value double")


def metrics_of(spark: SparkSession, initial_rows: int, figures: dict) -> DataFrame:
    """The row of ``cleaning_metrics`` from the rows read and the figures observed."""
    return spark.createDataFrame([(
        initial_rows, figures["final_rows"], initial_rows - figures["kept"], figures["missing_values_filled"],
        figures["invalid_prices_removed"], figures["total_revenue"], figures["avg_transaction_value"])],
        METRICS_SCHEMA)


def cleaning_metrics(raw: DataFrame) -> DataFrame:
    """One row: initial_rows, final_rows, duplicates_removed,
    missing_values_filled, invalid_prices_removed, total_revenue,
    avg_transaction_value.

    The copies are counted as rows before minus rows after the keyed
    de-duplication, which keeps one row per key in each task, so no row is
    carried through a second aggregation. ``invalid_prices_removed`` is the
    number of rows the price filter removed. A ``raw`` that is neither a table
    nor stored is stored first, so its joins run once.
    """
    raw = raw if is_stored(raw) else stored(raw, "raw")
    initial = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    figures = dedup_transactions(raw).agg(*_figures())
    return figures.select(
        initial.alias("initial_rows"), "final_rows", (initial - F.col("kept")).alias("duplicates_removed"),
        "missing_values_filled", "invalid_prices_removed", "total_revenue", "avg_transaction_value")
