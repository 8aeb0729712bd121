"""Raw sales and raw customers, derived from the TPC-H style tables.

The derivation uses no random draws, so Spark and an SQL oracle build the
same rows. It also plants the data faults the cleaning stage must handle:
NULL customer ids, negative prices and exact duplicate rows.

raw_sales = lineitem join orders join customer join nation join region
raw_customers = customer minus every 40th key (so some sales do not match)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.ids import prefixed_id, scatter, zero_pad
from tillroll.operators.joins import lookup_join
from tillroll.operators.masking import append_picked, copy_where, mask_to_null, negate_where, sample_n
from tillroll.sources.warehouse import filesystem

# Fixed values of the derivation (kept identical in the oracle SQL).
#   transaction_id   'TXN-%06d-%d-%d-%d' of (l_orderkey, l_linenumber, l_partkey, l_suppkey)
#   customer_id      'CUST-%03d' of o_custkey; NULL when (l_orderkey*7 + l_linenumber) % 20 = 0
#   product_id       'PROD-%03d' of l_partkey
#   unit_price       l_extendedprice, negated when (l_orderkey*11 + l_linenumber*3) % 50 = 0
#   transaction_date l_shipdate + ((l_orderkey*13 + l_linenumber*5) % 24) hours
#   duplicated rows  l_orderkey % 20 = 3 (one exact copy each)
#   conflicting rows l_orderkey % 50 = 7 (one copy each with quantity + 1)
#   customers left out: c_custkey % 40 = 7
#   signup_date      1994-06-01 00:00 + (c_custkey*37) % 1095 days + (c_custkey*5) % 24 hours
#   tier             c_custkey % 20: < 10 Bronze, < 17 Silver, else Gold
SIGNUP_EPOCH = "1994-06-01 00:00:00"

SALES_COLUMNS = ["transaction_id", "customer_id", "product_id", "quantity",
                 "unit_price", "transaction_date", "region"]
# Together unique for a line item.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "signup_date", "tier"]

# Declared schemas of the source tables this package reads
# (declaring them spares a footer read per table when the plan is built).
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table (whole, lazily read; Catalyst prunes and pushes down)."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bytes of files up to which a table is broadcast.
SMALL_BYTES = 1 << 20


def _small(spark: SparkSession, sf_dir: str, name: str, df: DataFrame) -> DataFrame:
    """``df``, which has at most the rows of table ``name``: broadcast if the
    files of that table are small (their sizes are looked up, nothing is read)."""
    fs, path = filesystem(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return F.broadcast(df) if fs.getContentSummary(path).getLength() <= SMALL_BYTES else df


# Tables that the sales and customers are made from.
SOURCES = ["region", "nation", "customer", "orders", "lineitem"]


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the files of ``SOURCES`` (sizes are looked up, nothing is read)."""
    total = 0
    for name in SOURCES:
        fs, path = filesystem(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    return total


def _null_id(l_orderkey: Column, l_linenumber: Column) -> Column:
    return (l_orderkey * 7 + l_linenumber) % 20 == 0


def _negative_price(l_orderkey: Column, l_linenumber: Column) -> Column:
    return (l_orderkey * 11 + l_linenumber * 3) % 50 == 0


def _duplicated(l_orderkey: Column) -> Column:
    return l_orderkey % 20 == 3


def _conflicting(l_orderkey: Column) -> Column:
    return l_orderkey % 50 == 7


def customer_regions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(c_custkey, ``more`` customer columns, r_name) via nation and region."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(_small(spark, sf_dir, "region", region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name")
    geo = _small(spark, sf_dir, "nation", geo)  # a row for each nation
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", *more)
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey).select("c_custkey", *more, "r_name")


def base_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the raw-sales shape, before the duplicate copies.

    Join order is chosen by hand: orders are first narrowed to
    (orderkey, custkey, region) - an orders-sized join - so the line-item
    side, the big one, takes part in one join instead of two. Keeps the
    lineitem key columns for the fault predicates (dropped by callers).
    """
    li = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_quantity", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # A customer may have a large part of all orders; only the key and the
    # region's key are joined, and the key is split (operators.joins).
    cr = customer_regions(spark, sf_dir).withColumnRenamed("c_custkey", "o_custkey")
    order_region = lookup_join(orders, cr, ["o_custkey"], "inner").select("o_orderkey", "o_custkey", "r_name")
    # Orders grow with line items (a quarter of their rows): a shuffle join on
    # the order key. An order has a handful of lines, so no key is hot.
    j = li.join(order_region, li.l_orderkey == order_region.o_orderkey)
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    hours = ((ok * 13 + ln * 5) % 24).cast("int")
    return j.select(
        *LINE_KEY,
        F.concat(F.lit("TXN-"), zero_pad(ok, 6),
                 *[F.concat(F.lit("-"), F.col(c).cast("string")) for c in LINE_KEY[1:]]).alias("transaction_id"),
        prefixed_id("CUST-", F.col("o_custkey"), 3).alias("customer_id"),
        prefixed_id("PROD-", F.col("l_partkey"), 3).alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=hours)).alias("transaction_date"),
        F.col("r_name").alias("region"),
    )


def with_faults(base: DataFrame) -> DataFrame:
    """Plant NULL ids and negative prices (row predicates, repeatable)."""
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    df = mask_to_null(base, "customer_id", _null_id(ok, ln))
    return negate_where(df, "unit_price", _negative_price(ok, ln))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales with all faults; exact and conflicting copies come from the same pass."""
    ok = F.col("l_orderkey")
    df = copy_where(with_faults(base_sales(spark, sf_dir)), _duplicated(ok) | _conflicting(ok), copy_col="__copy")
    more = F.when(_conflicting(ok), F.col("__copy")).otherwise(F.lit(0))
    return df.withColumn("quantity", (F.col("quantity") + more).cast("bigint")).select(*SALES_COLUMNS)


def raw_customers(spark: SparkSession, sf_dir: str, with_region: bool = False) -> DataFrame:
    """Customers; ``with_region`` adds the region a customer lives in."""
    c = (customer_regions(spark, sf_dir, "c_name") if with_region
         else table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    k = F.col("c_custkey")
    region = [F.col("r_name").alias("region")] if with_region else []
    tier = F.when(k % 20 < 10, "Bronze").when(k % 20 < 17, "Silver").otherwise("Gold")
    signup = (F.lit(SIGNUP_EPOCH).cast("timestamp_ntz")
              + F.make_dt_interval(days=((k * 37) % 1095).cast("int"), hours=((k * 5) % 24).cast("int")))
    return c.where(k % 40 != 7).select(
        prefixed_id("CUST-", k, 3).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))), F.lit("@example.com")).alias("email"),
        signup.alias("signup_date"),
        tier.alias("tier"), *region,
    )


def sample_lines(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The keys of ``n`` line items, picked without replacement from them alone."""
    key = [F.col(c) for c in LINE_KEY]
    return sample_n(table(spark, sf_dir, "lineitem").select(*LINE_KEY), n, [scatter(*key[:2]), *key])


def appended_sales(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Sales before duplication, with ``n`` picked ones a second time."""
    base = with_faults(base_sales(spark, sf_dir))
    return append_picked(base, sample_lines(spark, sf_dir, n), LINE_KEY).select(*SALES_COLUMNS)


def sample_customers(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``n`` customers picked without replacement, repeatably."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    return (sample_n(c, n, [scatter(k), k])
            .select(prefixed_id("CUST-", k, 3).alias("customer_id"),
                    F.col("c_name").alias("customer_name")))
