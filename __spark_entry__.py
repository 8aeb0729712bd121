"""

``queries()[name](spark, sf_dir)`` builds the Spark result from the Parquet
tables in ``sf_dir``; ``oracle_sql()[name]`` is the same computation in
plain SQL for DuckDB over the same tables (registered as views). Column names
match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import money_total, round_half_even
from tillroll.operators.aggregates import first_non_null, share_of_total, value_counts
from tillroll.operators.masking import sample_fraction
from tillroll.operators.ranking import average_rank
from tillroll.operators.topk import arg_max
from tillroll.plans import clean, enrich, metrics, quality, publish as publish_plan
from tillroll.session import apply_pipeline_conf, stored, widen_shuffles
from tillroll.sources import fixtures
from tillroll.sources.warehouse import (
    nan_to_null_all, publish, read_table, receipt_frame, sanitize_columns, storage_projection,
)

try:
    from tillroll.llm import queries as _corpus
except ImportError:  # the subpackage is optional, and so is what only it needs
    _corpus = None

FLAGSHIP_SF = "/root/testdata/sf0.001"
# Scratch databases (under the session's warehouse folder) for the table queries.
CHECK_DB = "tillroll_check"
PIPELINE_DB = "tillroll_pipeline"
SAMPLE_N = 50


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _raw(spark, sf):
    return fixtures.raw_sales(spark, sf)


def _cleaned(spark, sf):
    return clean.cleaned_sales(_raw(spark, sf))


def _enriched(spark, sf):
    return enrich.enriched_sales(_cleaned(spark, sf), fixtures.raw_customers(spark, sf))


def entry(spark: SparkSession, sf_dir: str = FLAGSHIP_SF) -> DataFrame:
    """Flagship: daily revenue from raw sales (clean -> enrich -> daily)."""
    apply_pipeline_conf(spark)
    widen_shuffles(spark, fixtures.input_bytes(spark, sf_dir))
    return metrics.daily_sales(_enriched(spark, sf_dir))


def _roundtrip(s, d):
    publish(_cleaned(s, d), CHECK_DB, "table_roundtrip")
    return read_table(s, CHECK_DB, "table_roundtrip")


def _write_receipt(s, d):
    return receipt_frame(s, [publish(_enriched(s, d), CHECK_DB, "write_receipt")])


def _preview_top10(s, d):
    publish(metrics.daily_sales(_enriched(s, d)), CHECK_DB, ["Preview", "Daily"])
    return s.sql(f"SELECT * FROM {CHECK_DB}.preview_daily ORDER BY transaction_date_only LIMIT 10")


def _text_of(name: str, kind: str):
    """A column as text that another engine can make too."""
    c = F.col(name)
    if kind == "double":  # thousandths, by the same floating-point steps
        text = F.floor(c * 1000 + 0.5).cast("bigint").cast("string")
    elif kind == "timestamp_ntz":
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("~"))


def _published_pipeline(s, d):
    """Runs the whole pipeline and reads every table back: rows and a checksum of each."""
    out = None
    for receipt in publish_plan.run_all(s, d, PIPELINE_DB):
        t = read_table(s, PIPELINE_DB, receipt.table.split(".")[1])
        row = F.concat_ws("|", *[_text_of(f.name, f.dataType.simpleString()) for f in t.schema.fields])
        one = t.agg(F.lit(receipt.table.split(".")[1]).alias("table"), F.count(F.lit(1)).alias("row_count"),
                    F.coalesce(F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")),
                               F.lit(0)).alias("checksum"))
        out = one if out is None else out.unionAll(one)
    return out


def _sanitize(s, d):
    daily = metrics.daily_sales(_enriched(s, d))
    messy = daily.toDF("Date Only", "Total Revenue ($)", "txn-count", "avg.order value",
                       "unique customers", "date")
    return sanitize_columns(messy)


def _nan_to_null(s, d):
    li = fixtures.table(s, d, "lineitem")
    planted = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 13 == 0,
                     F.lit("NaN").cast("double")).otherwise(F.col("l_extendedprice"))
    return nan_to_null_all(li.select("l_orderkey", "l_linenumber", planted.alias("price")))


def _storage_types(s, d):
    li = fixtures.table(s, d, "lineitem")
    return storage_projection(li.withColumns({
        "is_returned": F.col("l_returnflag") == "R", "ship_day": F.col("l_shipdate").cast("date"),
        "small_float": F.col("l_linenumber").cast("float") / F.lit(4).cast("float"),
        "price_decimal": F.col("l_extendedprice").cast("decimal(18,2)")}).withColumn(
        "small_float", F.col("small_float").cast("float")))


def _ingest_metrics(s, d):
    return quality.ingest_metrics(_raw(s, d))


def _join_suffixes(s, d):
    j = enrich.left_join_customers(_cleaned(s, d), fixtures.raw_customers(s, d, with_region=True))
    return j.select("transaction_id", "customer_id", "region_sale", "region_customer")


def _cast_types(s, d):
    b = fixtures.with_faults(fixtures.base_sales(s, d))
    text = b.select("transaction_id",
                    (F.col("quantity") + F.lit(0.75)).alias("quantity"),
                    F.col("unit_price").cast("string").alias("unit_price"),
                    F.col("transaction_date").cast("string").alias("transaction_date"))
    return clean.cast_types(text)


def _round_price(s, d):
    li = fixtures.table(s, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     round_half_even(F.col("l_quantity") / 8).alias("price_rounded"))


def _customers_agg(s, d):
    return metrics.customer_aggregates(_enriched(s, d))


def _rank_ties(s, d, **kw):
    ranked = average_rank(_customers_agg(s, d), "transaction_count", "count_rank", **kw)
    return ranked.select("customer_id", "transaction_count", "count_rank")


def _revenue_share(s, d):
    p = metrics.product_aggregates(_enriched(s, d))
    out = share_of_total(p, "total_revenue", "revenue_share", total_of=money_total("total_revenue"))
    return out.select("product_id", "total_revenue", "revenue_share")


def _first_per_customer(s, d):
    sales = stored(_enriched(s, d).select("customer_id", "transaction_date", "transaction_id", "tier",
                                          "customer_category"), "first")
    order = [F.col("transaction_date"), F.col("transaction_id")]
    return (first_non_null(sales, "customer_id", "tier", order).withColumnRenamed("tier", "customer_tier")
            .join(first_non_null(sales, "customer_id", "customer_category", order), "customer_id", "full"))


def _top_customer(s, d):
    return arg_max(_customers_agg(s, d), "total_revenue", ["customer_id", "total_revenue"],
                   [F.col("customer_id")])


def _mask_to_null(s, d):
    b = fixtures.with_faults(fixtures.base_sales(s, d))
    return b.select("transaction_id", "customer_id")


def _mask_negate(s, d):
    b = fixtures.with_faults(fixtures.base_sales(s, d))
    return b.select("transaction_id", "unit_price")


def _configured(query):
    """The query in a session with the pipeline's settings, whoever made it."""
    def run(spark, sf_dir):
        apply_pipeline_conf(spark)
        widen_shuffles(spark, fixtures.input_bytes(spark, sf_dir))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        # sources, sinks, storage
        "raw_sales": lambda s, d: _raw(s, d),
        "raw_customers": lambda s, d: fixtures.raw_customers(s, d),
        "table_roundtrip": _roundtrip,
        "storage_types": _storage_types,
        "sanitize_columns": _sanitize,
        "nan_to_null": _nan_to_null,
        "write_receipt": _write_receipt,
        "preview_top10": _preview_top10,
        "ingest_metrics": _ingest_metrics,
        "customer_receipt": lambda s, d: quality.row_count(fixtures.raw_customers(s, d)),
        # fills, filters, derived columns
        "fill_missing_customer": lambda s, d: clean.fill_missing_customer(
            clean.dedup_transactions(_raw(s, d))),
        "fill_customer_defaults": lambda s, d: enrich.fill_customer_defaults(
            enrich.left_join_customers(_cleaned(s, d), fixtures.raw_customers(s, d))),
        "filter_valid_price": lambda s, d: clean.filter_valid_price(_raw(s, d)),
        "cleaning_metrics": lambda s, d: clean.cleaning_metrics(_raw(s, d)),
        "derive_sale_columns": lambda s, d: clean.derive_sale_columns(_raw(s, d)),
        "tenure_category": lambda s, d: _enriched(s, d).select(
            "transaction_id", "customer_id", "days_since_signup", "customer_category"),
        "tenure_days": lambda s, d: _enriched(s, d).select(
            "transaction_id", "customer_id", "signup_date", "transaction_date",
            "customer_tenure_days", "days_since_signup"),
        "mask_to_null": _mask_to_null,
        "mask_negate": _mask_negate,
        "join_suffixes": _join_suffixes,
        "cast_types": _cast_types,
        "round_price": _round_price,
        # join
        "left_join_customers": lambda s, d: enrich.left_join_customers(
            _cleaned(s, d), fixtures.raw_customers(s, d)),
        # aggregations
        "dedup_transactions": lambda s, d: clean.dedup_transactions(_raw(s, d)),
        "daily_sales": lambda s, d: metrics.daily_sales(_enriched(s, d)),
        "product_performance": lambda s, d: metrics.product_performance(_enriched(s, d)),
        "regional_performance": lambda s, d: metrics.regional_performance(_enriched(s, d)),
        "customer_insights": lambda s, d: metrics.customer_insights(_enriched(s, d)),
        "customer_sketches": lambda s, d: metrics.region_customers_checked(_enriched(s, d)),
        "first_per_customer": _first_per_customer,
        "summary_metrics": lambda s, d: metrics.summary_metrics(_enriched(s, d)),
        "tier_distribution": lambda s, d: value_counts(_enriched(s, d), "tier", "tier_count"),
        "enrichment_metrics": lambda s, d: enrich.enrichment_metrics(
            _cleaned(s, d), fixtures.raw_customers(s, d)).withColumn(
            "tier_distribution", enrich.map_text("tier_distribution")),
        # ranks, shares, order
        "rank_average_ties": lambda s, d: _rank_ties(s, d),
        "distributed_rank": lambda s, d: _rank_ties(s, d, keys_per_range=8),
        "revenue_share": _revenue_share,
        "sorted_products": lambda s, d: metrics.sorted_products(
            metrics.product_performance(_enriched(s, d))),
        "top_product": lambda s, d: metrics.top_product(metrics.product_aggregates(_enriched(s, d))),
        "top_customer": _top_customer,
        "customer_summary": lambda s, d: metrics.customer_summary(_customers_agg(s, d)),
        # copies and samples
        "append_duplicates": lambda s, d: fixtures.appended_sales(s, d, SAMPLE_N),
        "bernoulli_rows": lambda s, d: sample_fraction(
            fixtures.table(s, d, "lineitem"), 0.05, fixtures.LINE_KEY).select(*fixtures.LINE_KEY, "l_quantity"),
        "sample_n": lambda s, d: fixtures.sample_customers(s, d, SAMPLE_N),
        # composite stages
        "cleaned_sales": lambda s, d: _cleaned(s, d),
        "enriched_sales": lambda s, d: _enriched(s, d),
        "published_pipeline": _published_pipeline,
    }
    return {k: _configured(f) for k, f in own.items()} | (_corpus.queries() if _corpus else {})


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# --------------------------------------------------------------------------

# Same fixed values as tillroll.sources.fixtures.
_BASE = """
base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         printf('TXN-%06d-%d-%d-%d', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS transaction_id,
         CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 20 = 0 THEN NULL
              ELSE printf('CUST-%03d', o.o_custkey) END AS customer_id,
         printf('PROD-%03d', l.l_partkey) AS product_id,
         CAST(trunc(l.l_quantity) AS BIGINT) AS quantity,
         CASE WHEN (l.l_orderkey * 11 + l.l_linenumber * 3) % 50 = 0 THEN -l.l_extendedprice
              ELSE l.l_extendedprice END AS unit_price,
         l.l_shipdate + to_hours(CAST((l.l_orderkey * 13 + l.l_linenumber * 5) % 24 AS BIGINT))
           AS transaction_date,
         r.r_name AS region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_SALES_COLS = "transaction_id, customer_id, product_id, quantity, unit_price, transaction_date, region"

_RAW = _BASE + f""",
raw_sales AS (
  SELECT {_SALES_COLS} FROM base
  UNION ALL
  SELECT {_SALES_COLS} FROM base WHERE l_orderkey % 20 = 3
  UNION ALL
  SELECT {_SALES_COLS.replace("quantity", "quantity + 1 AS quantity")} FROM base WHERE l_orderkey % 50 = 7
)"""

_CUSTOMERS = """
raw_customers AS (
  SELECT printf('CUST-%03d', c_custkey) AS customer_id,
         c_name AS customer_name,
         lower(replace(c_name, '#', '')) || '@example.com' AS email,
         TIMESTAMP '1994-06-01 00:00:00'
           + to_days(CAST((c_custkey * 37) % 1095 AS INTEGER))
           + to_hours(CAST((c_custkey * 5) % 24 AS BIGINT)) AS signup_date,
         CASE WHEN c_custkey % 20 < 10 THEN 'Bronze'
              WHEN c_custkey % 20 < 17 THEN 'Silver' ELSE 'Gold' END AS tier
  FROM customer WHERE c_custkey % 40 <> 7
)"""

_DEDUP = _RAW + """,
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY transaction_id
      ORDER BY transaction_date ASC NULLS FIRST, product_id ASC NULLS FIRST,
               customer_id ASC NULLS LAST, quantity ASC NULLS FIRST,
               unit_price ASC NULLS FIRST, region ASC NULLS FIRST) AS rn
    FROM raw_sales) WHERE rn = 1
)"""

_CLEANED = _DEDUP + """,
cleaned AS (
  SELECT transaction_id, coalesce(customer_id, 'UNKNOWN') AS customer_id, product_id,
         CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
         transaction_date, region,
         quantity * unit_price AS total_amount,
         CAST(transaction_date AS DATE) AS transaction_date_only,
         CAST(hour(transaction_date) AS BIGINT) AS hour_of_day,
         dayname(transaction_date) AS day_of_week
  FROM dedup WHERE unit_price >= 0 AND NOT isnan(unit_price)
)"""

_ENRICHED = _CLEANED + "," + _CUSTOMERS + """,
joined AS (
  SELECT s.*, c.customer_name, c.email, c.signup_date, c.tier
  FROM cleaned s LEFT JOIN raw_customers c ON s.customer_id = c.customer_id
),
filled AS (
  SELECT * REPLACE (
           coalesce(customer_name, 'Unknown Customer') AS customer_name,
           coalesce(email, 'unknown@example.com') AS email,
           coalesce(signup_date, transaction_date) AS signup_date,
           coalesce(tier, 'Bronze') AS tier)
  FROM joined
),
enriched AS (
  SELECT *,
         CAST(floor((epoch_us(transaction_date) - epoch_us(signup_date)) / 86400000000) AS BIGINT)
           AS customer_tenure_days,
         date_diff('day', CAST(signup_date AS DATE), CAST(transaction_date AS DATE))
           AS days_since_signup,
         CASE WHEN date_diff('day', CAST(signup_date AS DATE), CAST(transaction_date AS DATE)) < 30 THEN 'New'
              WHEN date_diff('day', CAST(signup_date AS DATE), CAST(transaction_date AS DATE)) < 365 THEN 'Developing'
              WHEN date_diff('day', CAST(signup_date AS DATE), CAST(transaction_date AS DATE)) < 730 THEN 'Established'
              ELSE 'Loyal' END AS customer_category
  FROM filled
)"""


def _money_sum(c: str) -> str:
    return f"coalesce(CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE), 0.0)"


def _money_mean(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c})"


def _avg_rank_desc(v: str) -> str:
    """Average rank, 1 = largest, ties averaged, NULL stays NULL."""
    return (f"CASE WHEN {v} IS NULL THEN NULL ELSE "
            f"CAST(rank() OVER (ORDER BY {v} DESC NULLS LAST) AS DOUBLE) "
            f"+ (count(*) OVER (PARTITION BY {v}) - 1) / 2.0 END")


_DAILY = f"""
daily AS (
  SELECT transaction_date_only,
         {_money_sum('total_amount')} AS total_revenue,
         count(transaction_id) AS transaction_count,
         {_money_mean('total_amount')} AS avg_order_value,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(transaction_date_only AS TIMESTAMP) AS date
  FROM enriched WHERE transaction_date_only IS NOT NULL
  GROUP BY transaction_date_only
)"""

_PRODUCTS = f"""
product_agg AS (
  SELECT product_id,
         CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
         {_money_sum('total_amount')} AS total_revenue,
         count(transaction_id) AS transaction_count,
         {_money_mean('unit_price')} AS avg_price
  FROM enriched WHERE product_id IS NOT NULL GROUP BY product_id
),
products AS (
  SELECT *, {_avg_rank_desc('total_revenue')} AS rank_by_revenue FROM product_agg
)"""

_REGIONS = f"""
region_agg AS (
  SELECT region,
         sum(CAST(total_amount AS DECIMAL(18,2))) AS revenue_exact,
         count(transaction_id) AS transaction_count,
         {_money_mean('total_amount')} AS avg_order_value,
         count(DISTINCT customer_id) AS unique_customers
  FROM enriched WHERE region IS NOT NULL GROUP BY region
),
regions AS (
  SELECT region,
         coalesce(CAST(revenue_exact AS DOUBLE), 0.0) AS total_revenue,
         transaction_count, avg_order_value, unique_customers,
         coalesce(CAST(revenue_exact AS DOUBLE), 0.0)
           / nullif(CAST((SELECT sum(revenue_exact) FROM region_agg) AS DOUBLE), 0) AS revenue_share
  FROM region_agg
)"""

_CUSTOMER_INSIGHTS = f"""
customer_agg AS (
  SELECT customer_id,
         {_money_sum('total_amount')} AS total_revenue,
         count(transaction_id) AS transaction_count,
         {_money_mean('total_amount')} AS avg_order_value,
         CAST(sum(quantity) AS BIGINT) AS total_items,
         min(transaction_date) AS first_transaction,
         max(transaction_date) AS last_transaction,
         arg_min(tier, CASE WHEN tier IS NOT NULL THEN (transaction_date, transaction_id) END)
           AS customer_tier,
         arg_min(customer_category,
                 CASE WHEN customer_category IS NOT NULL THEN (transaction_date, transaction_id) END)
           AS customer_category
  FROM enriched WHERE customer_id IS NOT NULL GROUP BY customer_id
),
customers_out AS (
  SELECT *,
         CAST(floor((epoch_us(last_transaction) - epoch_us(first_transaction)) / 86400000000) AS BIGINT)
           AS customer_lifetime_days,
         transaction_count / CAST(
           CAST(floor((epoch_us(last_transaction) - epoch_us(first_transaction)) / 86400000000) AS BIGINT) + 1
           AS DOUBLE) AS purchase_frequency,
         {_avg_rank_desc('total_revenue')} AS value_rank
  FROM customer_agg
)"""


_PRICE_OK = "coalesce(unit_price >= 0 AND NOT isnan(unit_price), false)"
_VALID_AMOUNT = f"CASE WHEN {_PRICE_OK} THEN quantity * unit_price END"

_CLEANING = f"""
    SELECT (SELECT count(*) FROM raw_sales) AS initial_rows,
           count(*) FILTER (WHERE {_PRICE_OK}) AS final_rows,
           (SELECT count(*) FROM raw_sales) - count(*) AS duplicates_removed,
           count(*) FILTER (WHERE customer_id IS NULL) AS missing_values_filled,
           count(*) FILTER (WHERE NOT {_PRICE_OK}) AS invalid_prices_removed,
           {_money_sum(_VALID_AMOUNT)} AS total_revenue,
           {_money_mean(_VALID_AMOUNT)} AS avg_transaction_value
    FROM dedup"""

_ENRICHMENT = f"""
    SELECT count(*) AS rows_enriched,
           count(*) FILTER (WHERE customer_name IS NULL) AS missing_customers_filled,
           count(DISTINCT customer_id) AS unique_customers,
           {_money_sum('total_amount')} AS total_revenue,
           (SELECT string_agg(tier || '=' || n, ',' ORDER BY tier)
            FROM (SELECT tier, count(*) AS n FROM enriched GROUP BY tier)) AS tier_distribution
    FROM joined"""

_SUMMARY = f"""
    SELECT {_money_sum('total_amount')} AS total_revenue,
           count(*) AS total_transactions,
           count(DISTINCT customer_id) AS unique_customers,
           count(DISTINCT transaction_date_only) AS days_analyzed,
           count(DISTINCT product_id) AS products_ranked,
           count(DISTINCT region) AS regions_analyzed
    FROM enriched"""

_CUSTOMER_SUMMARY = """
    SELECT count(*) AS total_customers,
           coalesce(CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS total_revenue,
           max(total_revenue) AS top_customer_value,
           (SELECT customer_id FROM customer_agg
            WHERE customer_id <> 'UNKNOWN' AND total_revenue IS NOT NULL
            ORDER BY total_revenue DESC, customer_id LIMIT 1) AS top_known_customer,
           max(total_revenue) FILTER (WHERE customer_id <> 'UNKNOWN') AS top_known_customer_value
    FROM customer_agg"""

_INGEST = f"""
    SELECT count(*) AS row_count, CAST(7 AS BIGINT) AS column_count,
           '{",".join(fixtures.SALES_COLUMNS)}' AS columns,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT transaction_id FROM raw_sales))
             AS duplicate_count
    FROM raw_sales"""

_SORTED_PRODUCTS = """
    SELECT *, row_number() OVER (ORDER BY rank_by_revenue ASC NULLS LAST, product_id) AS position
    FROM products"""

_TOP_PRODUCT = """
    SELECT product_id AS top_product, total_revenue AS top_product_revenue FROM products
    WHERE rank_by_revenue IS NOT NULL ORDER BY rank_by_revenue, product_id LIMIT 1"""

_CLEANED_COLS = ("transaction_id, customer_id, product_id, quantity, unit_price, transaction_date, "
                 "region, total_amount, transaction_date_only, hour_of_day, day_of_week")
_ENRICHED_COLS = _CLEANED_COLS + (", customer_name, email, signup_date, tier, customer_tenure_days, "
                                  "days_since_signup, customer_category")

# Published table -> (its rows, its columns in order).
_PUBLISHED = {
    "raw_sales_data": ("SELECT * FROM raw_sales", _SALES_COLS),
    "raw_customers_data": ("SELECT * FROM raw_customers", ", ".join(fixtures.CUSTOMER_COLUMNS)),
    "cleaned_sales_data": ("SELECT * FROM cleaned", _CLEANED_COLS),
    "enriched_sales_data": ("SELECT * FROM enriched", _ENRICHED_COLS),
    "sales_metrics": ("SELECT * FROM daily", ", ".join(metrics.DAILY_COLUMNS)),
    "product_performance": (_SORTED_PRODUCTS, ", ".join(metrics.PRODUCT_COLUMNS) + ", position"),
    "regional_performance": ("SELECT * FROM regions", ", ".join(metrics.REGION_COLUMNS)),
    "customer_insights": ("SELECT * FROM customers_out", ", ".join(metrics.CUSTOMER_COLUMNS)),
    "raw_sales_data_metadata": (_INGEST, "row_count, column_count, columns, duplicate_count"),
    "raw_customers_data_metadata": ("SELECT count(*) AS row_count FROM raw_customers", "row_count"),
    "cleaned_sales_data_metadata": (_CLEANING, "initial_rows, final_rows, duplicates_removed, missing_values_filled, "
                                               "invalid_prices_removed, total_revenue, avg_transaction_value"),
    "enriched_sales_data_metadata": (_ENRICHMENT, "rows_enriched, missing_customers_filled, unique_customers, "
                                                  "total_revenue, tier_distribution"),
    "enriched_sales_data_tiers": ("SELECT tier, count(*) AS tier_count FROM enriched GROUP BY tier", "tier, tier_count"),
    "sales_metrics_metadata": (_SUMMARY, "total_revenue, total_transactions, unique_customers, days_analyzed, "
                                         "products_ranked, regions_analyzed"),
    "product_performance_metadata": (_TOP_PRODUCT, "top_product, top_product_revenue"),
    "customer_insights_metadata": (_CUSTOMER_SUMMARY, "total_customers, total_revenue, top_customer_value, "
                                                      "top_known_customer, top_known_customer_value"),
}
_DOUBLES = {"unit_price", "total_amount", "total_revenue", "avg_order_value", "avg_price", "rank_by_revenue",
            "revenue_share", "purchase_frequency", "value_rank", "avg_transaction_value", "top_product_revenue",
            "top_customer_value", "top_known_customer_value"}
_TIMES = {"transaction_date", "signup_date", "date", "first_transaction", "last_transaction"}


def _published_sql() -> str:
    """Rows and checksum of every published table (see ``_published_pipeline``)."""
    parts = []
    for name, (rows, columns) in _PUBLISHED.items():
        texts = []
        for c in columns.split(", "):
            text = (f"CAST(CAST(floor({c} * 1000 + 0.5) AS BIGINT) AS VARCHAR)" if c in _DOUBLES
                    else f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in _TIMES else f"CAST({c} AS VARCHAR)")
            texts.append(f"coalesce({text}, '~')")
        parts.append(f"""
            SELECT '{name}' AS "table", count(*) AS row_count,
                   CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {", ".join(texts)})), 1, 8) AS BIGINT)), 0)
                        AS BIGINT) AS checksum
            FROM ({rows})""")
    return _with(_ENRICHED, _DAILY, _PRODUCTS, _REGIONS, _CUSTOMER_INSIGHTS) + " UNION ALL ".join(parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def oracle_sql() -> dict[str, str]:
    cleaned_cols = ("transaction_id, customer_id, product_id, quantity, unit_price, transaction_date, "
                    "region, total_amount, transaction_date_only, hour_of_day, day_of_week")
    enriched_cols = ",".join([
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "transaction_date",
        "region", "total_amount", "transaction_date_only", "hour_of_day", "day_of_week",
        "customer_name", "email", "signup_date", "tier", "customer_tenure_days",
        "days_since_signup", "customer_category"])
    scatter_sales = ("((0 * 31 + (CAST(l_orderkey AS BIGINT) % 1000003) * 7919) % 1000003 * 31 "
                     "+ (CAST(l_linenumber AS BIGINT) % 1000003) * 112648) % 1000003")
    scatter_line = "0"
    for i, k in enumerate(fixtures.LINE_KEY):
        scatter_line = (f"(({scatter_line}) * 31 + (CAST({k} AS BIGINT) % 1000003) * {7919 + 104729 * i}) % 1000003")
    tail = "0"
    for i, k in enumerate(fixtures.LINE_KEY):
        r = f"(CAST({k} AS BIGINT) % 999983)"
        tail = f"(({tail}) * 37 + {r} * ({r} + {15485 + 86243 * i})) % 999983"
    fine_line = f"(({scatter_line}) * 999983 + {tail})"
    scatter_cust = "((0 * 31 + (CAST(c_custkey AS BIGINT) % 1000003) * 7919) % 1000003)"
    price_ok = "coalesce(unit_price >= 0 AND NOT isnan(unit_price), false)"
    valid_amount = f"CASE WHEN {price_ok} THEN quantity * unit_price END"
    own = {
        # sources, sinks, storage
        "raw_sales": _with(_RAW) + " SELECT * FROM raw_sales",
        "raw_customers": _with(_CUSTOMERS) + " SELECT * FROM raw_customers",
        "table_roundtrip": _with(_CLEANED) + f" SELECT {cleaned_cols} FROM cleaned",
        "storage_types": """
            SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber), l_returnflag = 'R' AS is_returned,
                   CAST(l_shipdate AS DATE) AS ship_day, CAST(l_linenumber / 4.0 AS DOUBLE) AS small_float,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price_decimal
            FROM lineitem""",
        "sanitize_columns": _with(_ENRICHED, _DAILY) + """
            SELECT transaction_date_only AS Date_Only, total_revenue AS Total_Revenue____,
                   transaction_count AS txn_count, avg_order_value AS avg_order_value,
                   unique_customers AS unique_customers, date FROM daily""",
        "nan_to_null": """
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN NULL
                        ELSE l_extendedprice END AS price
            FROM lineitem""",
        "write_receipt": _with(_ENRICHED) + f"""
            SELECT '{CHECK_DB}.write_receipt' AS "table", count(*) AS row_count,
                   '{enriched_cols}' AS columns FROM enriched""",
        "preview_top10": _with(_ENRICHED, _DAILY)
        + " SELECT * FROM daily ORDER BY transaction_date_only LIMIT 10",
        "customer_receipt": _with(_CUSTOMERS) + " SELECT count(*) AS row_count FROM raw_customers",
        "ingest_metrics": _with(_RAW) + f"""
            SELECT count(*) AS row_count, CAST(7 AS BIGINT) AS column_count,
                   '{",".join(fixtures.SALES_COLUMNS)}' AS columns,
                   count(*) - (SELECT count(*) FROM (SELECT DISTINCT transaction_id FROM raw_sales))
                     AS duplicate_count
            FROM raw_sales""",
        # fills, filters, derived columns
        "fill_missing_customer": _with(_DEDUP)
        + " SELECT * REPLACE (coalesce(customer_id, 'UNKNOWN') AS customer_id) FROM dedup",
        "fill_customer_defaults": _with(_ENRICHED) + " SELECT * FROM filled",
        "filter_valid_price": _with(_RAW) + f" SELECT * FROM raw_sales WHERE {price_ok}",
        "cleaning_metrics": _with(_DEDUP) + " SELECT * FROM (" + _CLEANING + ")",
        "derive_sale_columns": _with(_RAW) + """
            SELECT *, quantity * unit_price AS total_amount,
                   CAST(transaction_date AS DATE) AS transaction_date_only,
                   CAST(hour(transaction_date) AS BIGINT) AS hour_of_day,
                   dayname(transaction_date) AS day_of_week
            FROM raw_sales""",
        "tenure_category": _with(_ENRICHED)
        + " SELECT transaction_id, customer_id, days_since_signup, customer_category FROM enriched",
        "tenure_days": _with(_ENRICHED) + """
            SELECT transaction_id, customer_id, signup_date, transaction_date,
                   customer_tenure_days, days_since_signup FROM enriched""",
        "mask_to_null": _with(_BASE) + " SELECT transaction_id, customer_id FROM base",
        "mask_negate": _with(_BASE) + " SELECT transaction_id, unit_price FROM base",
        "join_suffixes": _with(_CLEANED, _CUSTOMERS) + """,
            home AS (
              SELECT printf('CUST-%03d', c.c_custkey) AS customer_id, r.r_name AS region
              FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
              JOIN region r ON n.n_regionkey = r.r_regionkey
            ),
            cust AS (SELECT rc.*, h.region FROM raw_customers rc JOIN home h USING (customer_id))
            SELECT s.transaction_id, s.customer_id, s.region AS region_sale, c.region AS region_customer
            FROM cleaned s LEFT JOIN cust c ON s.customer_id = c.customer_id""",
        "cast_types": _with(_BASE) + """
            SELECT transaction_id,
                   CAST(trunc(quantity + 0.75) AS BIGINT) AS quantity,
                   CAST(CAST(unit_price AS VARCHAR) AS DOUBLE) AS unit_price,
                   CAST(CAST(transaction_date AS VARCHAR) AS TIMESTAMP) AS transaction_date
            FROM base""",
        "round_price": """
            SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) AS price_rounded
            FROM lineitem""",
        # join
        "left_join_customers": _with(_ENRICHED) + " SELECT * FROM joined",
        # aggregations
        "dedup_transactions": _with(_DEDUP) + " SELECT * FROM dedup",
        "daily_sales": _with(_ENRICHED, _DAILY) + " SELECT * FROM daily",
        "product_performance": _with(_ENRICHED, _PRODUCTS) + " SELECT * FROM products",
        "regional_performance": _with(_ENRICHED, _REGIONS) + " SELECT * FROM regions",
        "customer_sketches": _with(_ENRICHED) + """
            SELECT region, count(DISTINCT customer_id) AS unique_customers, true AS within_tolerance
            FROM enriched WHERE region IS NOT NULL GROUP BY region""",
        "customer_insights": _with(_ENRICHED, _CUSTOMER_INSIGHTS) + " SELECT * FROM customers_out",
        "first_per_customer": _with(_ENRICHED, _CUSTOMER_INSIGHTS)
        + " SELECT customer_id, customer_tier, customer_category FROM customer_agg",
        "summary_metrics": _with(_ENRICHED) + " SELECT * FROM (" + _SUMMARY + ")",
        "tier_distribution": _with(_ENRICHED)
        + " SELECT tier, count(*) AS tier_count FROM enriched WHERE tier IS NOT NULL GROUP BY tier",
        "enrichment_metrics": _with(_ENRICHED) + " SELECT * FROM (" + _ENRICHMENT + ")",
        # ranks, shares, order
        "rank_average_ties": _with(_ENRICHED, _CUSTOMER_INSIGHTS) + f"""
            SELECT customer_id, transaction_count, {_avg_rank_desc('transaction_count')} AS count_rank
            FROM customer_agg""",
        "distributed_rank": _with(_ENRICHED, _CUSTOMER_INSIGHTS) + f"""
            SELECT customer_id, transaction_count, {_avg_rank_desc('transaction_count')} AS count_rank
            FROM customer_agg""",
        "revenue_share": _with(_ENRICHED, _PRODUCTS) + """
            SELECT product_id, total_revenue,
                   total_revenue / nullif(CAST((SELECT sum(CAST(total_revenue AS DECIMAL(38,2)))
                                                FROM product_agg) AS DOUBLE), 0) AS revenue_share
            FROM product_agg""",
        "sorted_products": _with(_ENRICHED, _PRODUCTS) + """
            SELECT *, row_number() OVER (ORDER BY rank_by_revenue ASC NULLS LAST, product_id) AS position
            FROM products""",
        "top_product": _with(_ENRICHED, _PRODUCTS) + """
            SELECT product_id AS top_product, total_revenue AS top_product_revenue FROM products
            WHERE rank_by_revenue IS NOT NULL ORDER BY rank_by_revenue, product_id LIMIT 1""",
        "top_customer": _with(_ENRICHED, _CUSTOMER_INSIGHTS) + """
            SELECT customer_id, total_revenue FROM customer_agg WHERE total_revenue IS NOT NULL
            ORDER BY total_revenue DESC, customer_id LIMIT 1""",
        "customer_summary": _with(_ENRICHED, _CUSTOMER_INSIGHTS) + " SELECT * FROM (" + _CUSTOMER_SUMMARY + ")",
        # copies and samples
        "append_duplicates": _with(_BASE) + f"""
            SELECT {_SALES_COLS} FROM base
            UNION ALL
            (SELECT {_SALES_COLS} FROM base
             ORDER BY {scatter_sales}, {", ".join(fixtures.LINE_KEY)} LIMIT {SAMPLE_N})""",
        "bernoulli_rows": f"""
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
            WHERE {fine_line} < {int(0.05 * 1000003 * 999983)}""",
        "sample_n": f"""
            SELECT printf('CUST-%03d', c_custkey) AS customer_id, c_name AS customer_name
            FROM customer ORDER BY {scatter_cust}, c_custkey LIMIT {SAMPLE_N}""",
        # composite stages
        "cleaned_sales": _with(_CLEANED) + f" SELECT {cleaned_cols} FROM cleaned",
        "enriched_sales": _with(_ENRICHED) + " SELECT * FROM enriched",
        "published_pipeline": _published_sql(),
    }
    return own | (_corpus.oracle_sql() if _corpus else {})
