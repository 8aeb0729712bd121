"""Stage 2: enriched sales (sales left-joined to customers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions.dates import calendar_days, elapsed_days, tenure_category
from tillroll.functions.money import money
from tillroll.operators.aggregates import value_counts_map
from tillroll.operators.fill import fill_from, fill_literals
from tillroll.operators.joins import HOT_ROWS, lookup_join

JOIN_KEY = "customer_id"
# Fixed values.
CUSTOMER_DEFAULTS = {
    "customer_name": "Unknown Customer",
    "email": "unknown@example.com",
    "tier": "Bronze",
}


def suffix_overlaps(left: DataFrame, right: DataFrame, keys, suffixes=("_sale", "_customer")):
    """Rename non-key columns present on both sides: ``x`` -> ``x_sale`` /
    ``x_customer``. Returns the two renamed frames."""
    common = (set(left.columns) & set(right.columns)) - set(keys)
    for c in sorted(common):
        left = left.withColumnRenamed(c, c + suffixes[0])
        right = right.withColumnRenamed(c, c + suffixes[1])
    return left, right


def left_join_customers(sales: DataFrame, customers: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every sale once per matching customer row (none: NULL customer fields).

    Output: the sales columns in their order, then the customer columns
    without the key.
    """
    sales, customers = suffix_overlaps(sales, customers, [JOIN_KEY])
    right = [c for c in customers.columns if c != JOIN_KEY]
    joined = lookup_join(sales, customers, [JOIN_KEY], "left", hot_rows=hot_rows)
    return joined.select(*sales.columns, *right)


def fill_customer_defaults(df: DataFrame) -> DataFrame:
    """Fill customer fields of unmatched (or incomplete) rows; a missing signup
    date becomes the transaction time."""
    return fill_from(fill_literals(df, CUSTOMER_DEFAULTS), "signup_date", "transaction_date")


def add_tenure(df: DataFrame) -> DataFrame:
    return (df.withColumn("customer_tenure_days", elapsed_days("signup_date", "transaction_date"))
            .withColumn("days_since_signup", calendar_days("signup_date", "transaction_date"))
            .withColumn("customer_category", tenure_category("days_since_signup")))


def enriched_sales(cleaned: DataFrame, customers: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Cleaned sales with customer fields, defaults and tenure. Customers (the
    fill id among them) with ``hot_rows`` sales or more are joined without a
    shuffle when ``cleaned`` is a stored table (``operators.joins``)."""
    return add_tenure(fill_customer_defaults(left_join_customers(cleaned, customers, hot_rows)))


def enriched_with_figures(cleaned: DataFrame, customers: DataFrame) -> tuple[DataFrame, Observation]:
    """``enriched_sales``, and its additive figures as a by-product of writing
    it: taken behind the join, in the tasks that write (see ``clean``)."""
    figures = Observation("enrichment")
    joined = left_join_customers(cleaned, customers).observe(
        figures, F.count(F.lit(1)).alias("rows_enriched"),
        F.count_if(F.col("customer_name").isNull()).cast("bigint").alias("missing_customers_filled"),
        F.coalesce(F.sum(money("total_amount")).cast("double"), F.lit(0.0)).alias("total_revenue"))
    return add_tenure(fill_customer_defaults(joined)), figures


def metrics_of(cleaned: DataFrame, enriched: DataFrame, figures: dict) -> DataFrame:
    """The row of ``enrichment_metrics`` from the figures observed and the two
    written tables (one narrow column of each)."""
    tiers = value_counts_map(enriched, "tier", "tier_distribution")
    unique = cleaned.where(F.col(JOIN_KEY).isNotNull()).select(JOIN_KEY).distinct() \
        .agg(F.count(F.lit(1)).alias("n")).scalar()
    return tiers.select(F.lit(figures["rows_enriched"]).cast("bigint").alias("rows_enriched"),
                        F.lit(figures["missing_customers_filled"]).cast("bigint").alias("missing_customers_filled"),
                        unique.alias("unique_customers"),
                        F.lit(figures["total_revenue"]).cast("double").alias("total_revenue"), "tier_distribution")


def enrichment_metrics(cleaned: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: rows_enriched, missing_customers_filled (rows whose customer
    name was NULL after the join), unique_customers, total_revenue,
    tier_distribution (map from tier, after the fill, to rows)."""
    joined = left_join_customers(cleaned, customers)
    # few groups, so the second level is small; no row is expanded
    tiers = (joined.withColumn("tier", F.coalesce("tier", F.lit(CUSTOMER_DEFAULTS["tier"])))
             .groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                  F.count_if(F.col("customer_name").isNull()).alias("unnamed"),
                                  F.sum(money("total_amount")).alias("revenue")))
    unique = cleaned.where(F.col(JOIN_KEY).isNotNull()).select(JOIN_KEY).distinct() \
        .agg(F.count(F.lit(1)).alias("n")).scalar()
    zero = F.lit(0).cast("bigint")
    return tiers.agg(
        F.coalesce(F.sum("n"), zero).alias("rows_enriched"),
        F.coalesce(F.sum("unnamed"), zero).cast("bigint").alias("missing_customers_filled"),
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", "n")))).alias("tier_distribution"),
    ).select("rows_enriched", "missing_customers_filled", unique.alias("unique_customers"),
             "total_revenue", "tier_distribution")


def map_text(column: str):
    """A map as sorted text, ``key=value`` joined by commas."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


def tier_distribution(enriched: DataFrame) -> DataFrame:
    """One row, ``tier_distribution: map<string, bigint>``."""
    return value_counts_map(enriched, "tier", "tier_distribution")
