"""Stage 3: daily, product, regional and customer metrics.

Groups with a NULL key are left out (a group-by over a data frame drops them
in the original pipeline). Money sums are exact (``functions.money``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import elapsed_days
from tillroll.functions.money import exact_mean, exact_sum, money
from tillroll.operators.aggregates import first_non_null, share_of_total
from tillroll.operators.ranking import average_rank, positions
from tillroll.session import is_stored, stored

# The columns of the published tables.
DAILY_COLUMNS = ["transaction_date_only", "total_revenue", "transaction_count",
                 "avg_order_value", "unique_customers", "date"]
PRODUCT_COLUMNS = ["product_id", "total_quantity_sold", "total_revenue", "transaction_count",
                   "avg_price", "rank_by_revenue"]
REGION_COLUMNS = ["region", "total_revenue", "transaction_count", "avg_order_value",
                  "unique_customers", "revenue_share"]
CUSTOMER_COLUMNS = ["customer_id", "total_revenue", "transaction_count", "avg_order_value",
                    "total_items", "first_transaction", "last_transaction", "customer_tier",
                    "customer_category", "customer_lifetime_days", "purchase_frequency",
                    "value_rank"]


def _grouped(df: DataFrame, key: str):
    return df.where(F.col(key).isNotNull()).groupBy(key)


def distinct_count(col: str, approx: bool = False):
    """Exact distinct count, or HyperLogLog++ (about 1% error, no second
    aggregation level) as an opt-in for very large inputs."""
    return F.approx_count_distinct(col, 0.01) if approx else F.count_distinct(col)


# Buckets of a stored customer sketch, as a power of two: a standard error of 0.6 %.
SKETCH_BITS = 15


def customer_sketches(enriched: DataFrame) -> DataFrame:
    """One row per day and region: a HyperLogLog sketch of its customers, to be
    stored next to the daily rows. Sketches of any days and regions merge, which
    distinct counts do not; each has a bounded size."""
    return (enriched.where(F.col("region").isNotNull() & F.col("transaction_date_only").isNotNull())
            .groupBy("transaction_date_only", "region")
            .agg(F.hll_sketch_agg("customer_id", F.lit(SKETCH_BITS)).alias("customers")))


def merged_customers(sketches: DataFrame, *by: str) -> DataFrame:
    """``by`` and ``unique_customers_estimate`` from stored sketches: a union of
    the sketches, never a second look at the sales."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias(
        "unique_customers_estimate"))


def region_customers_checked(enriched: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """region, unique_customers (exact), within_tolerance: whether the estimate
    merged from the daily sketches is that close."""
    sales = enriched.select("region", "transaction_date_only", "customer_id")
    if not is_stored(sales):
        sales = stored(sales, "sketch-sales")
    exact = _grouped(sales, "region").agg(F.count_distinct("customer_id").alias("unique_customers"))
    merged = merged_customers(stored(customer_sketches(sales), "sketches"), "region")
    close = F.abs(F.col("unique_customers_estimate") / F.col("unique_customers") - 1) <= tolerance
    return exact.join(merged, "region", "left").select(
        "region", "unique_customers",
        F.when(F.col("unique_customers") == 0, F.coalesce("unique_customers_estimate", F.lit(0)) == 0)
        .otherwise(F.coalesce(close, F.lit(False))).alias("within_tolerance"))


def daily_sales(enriched: DataFrame, approx_distinct: bool = False) -> DataFrame:
    return (_grouped(enriched, "transaction_date_only").agg(
        exact_sum("total_amount").alias("total_revenue"),
        F.count("transaction_id").alias("transaction_count"),
        exact_mean("total_amount").alias("avg_order_value"),
        distinct_count("customer_id", approx_distinct).alias("unique_customers"))
        .withColumn("date", F.col("transaction_date_only").cast("timestamp_ntz"))
        .select(*DAILY_COLUMNS))


def product_aggregates(enriched: DataFrame) -> DataFrame:
    return _grouped(enriched, "product_id").agg(
        F.sum("quantity").cast("bigint").alias("total_quantity_sold"),
        exact_sum("total_amount").alias("total_revenue"),
        F.count("transaction_id").alias("transaction_count"),
        exact_mean("unit_price").alias("avg_price"))


def product_performance(enriched: DataFrame) -> DataFrame:
    """Product totals with ``rank_by_revenue`` (1 = best, ties averaged)."""
    ranked = average_rank(product_aggregates(enriched), "total_revenue", "rank_by_revenue")
    return ranked.select(*PRODUCT_COLUMNS)


def sorted_products(products: DataFrame) -> DataFrame:
    """Products in rank order with their 1-based ``position`` (rank ascending,
    NULL ranks last, product id breaking ties)."""
    r = F.col("rank_by_revenue")
    return positions(products, [r.isNull(), r, F.col("product_id")], "position")


def top_product(products: DataFrame) -> DataFrame:
    """One row (none for no products): the product with the largest revenue,
    the smallest id among equals, i.e. the best rank. Needs no rank column:
    a top-1 (each task keeps its best row) instead of a global ranking."""
    rev = F.col("total_revenue")
    return (products.where(rev.isNotNull() & ~F.isnan(rev))
            .orderBy(rev.desc(), F.col("product_id")).limit(1)
            .select(F.col("product_id").alias("top_product"),
                    F.col("total_revenue").alias("top_product_revenue")))


def regional_performance(enriched: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Region totals and each region's share of all revenue."""
    regions = _grouped(enriched, "region").agg(
        F.sum(money("total_amount")).alias("__revenue_exact"),
        F.count("transaction_id").alias("transaction_count"),
        exact_mean("total_amount").alias("avg_order_value"),
        distinct_count("customer_id", approx_distinct).alias("unique_customers"))
    regions = regions.withColumn(
        "total_revenue", F.coalesce(F.col("__revenue_exact").cast("double"), F.lit(0.0)))
    shared = share_of_total(regions, "total_revenue", "revenue_share",
                            total_of=F.col("__revenue_exact"))
    return shared.select(*REGION_COLUMNS)


def customer_aggregates(enriched: DataFrame) -> DataFrame:
    """Totals per customer by hash aggregation (fixed-width values only); the
    first tier and category come from a top-1 per customer on narrow rows."""
    needed = ["customer_id", "total_amount", "transaction_id", "quantity", "transaction_date", "tier",
              "customer_category"]
    sales = enriched.select(*needed)
    if not is_stored(sales):
        sales = stored(sales, "customer-sales")  # read three times
    first_order = [F.col("transaction_date"), F.col("transaction_id")]
    agg = _grouped(sales, "customer_id").agg(
        exact_sum("total_amount").alias("total_revenue"),
        F.count("transaction_id").alias("transaction_count"),
        exact_mean("total_amount").alias("avg_order_value"),
        F.sum("quantity").cast("bigint").alias("total_items"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"))
    agg = (agg.join(first_non_null(sales, "customer_id", "tier", first_order)
                    .withColumnRenamed("tier", "customer_tier"), "customer_id", "left")
           .join(first_non_null(sales, "customer_id", "customer_category", first_order), "customer_id", "left"))
    lifetime = elapsed_days("first_transaction", "last_transaction")
    return (agg.withColumn("customer_lifetime_days", lifetime)
            .withColumn("purchase_frequency",
                        F.col("transaction_count") / (F.col("customer_lifetime_days") + 1).cast("double")))


def customer_insights(enriched: DataFrame) -> DataFrame:
    """Per-customer value, lifetime and frequency, with ``value_rank``."""
    ranked = average_rank(customer_aggregates(enriched), "total_revenue", "value_rank")
    return ranked.select(*CUSTOMER_COLUMNS)


def summary_metrics(enriched: DataFrame) -> DataFrame:
    """One row: total_revenue, total_transactions, unique_customers,
    days_analyzed, products_ranked, regions_analyzed.

    Each distinct count is a distinct of one narrow column, not one aggregate
    that expands every row once per column.
    """
    keys = {"unique_customers": "customer_id", "days_analyzed": "transaction_date_only",
            "products_ranked": "product_id", "regions_analyzed": "region"}
    sales = enriched.select("total_amount", *keys.values())
    if not is_stored(sales):
        sales = stored(sales, "summary-sales")
    totals = sales.agg(exact_sum("total_amount").alias("total_revenue"),
                       F.count(F.lit(1)).alias("total_transactions"))
    distinct = [sales.where(F.col(c).isNotNull()).select(c).distinct()
                .agg(F.count(F.lit(1)).alias("n")).scalar().alias(out) for out, c in keys.items()]
    return totals.select("total_revenue", "total_transactions", *distinct)


def customer_summary(customers: DataFrame, unknown_id: str = "UNKNOWN") -> DataFrame:
    """One row: total_customers, total_revenue, top_customer_value (the true
    maximum), and the best known customer (not the fill id) with its value;
    equal values go to the smallest id."""
    known = F.col("customer_id") != unknown_id
    rev = F.col("total_revenue")
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum(money(rev)).cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.max(rev).alias("top_customer_value"),
        F.min_by("customer_id", F.when(known & rev.isNotNull(),
                                       F.struct(-rev, F.col("customer_id")))).alias("top_known_customer"),
        F.max(F.when(known, rev)).alias("top_known_customer_value"))
