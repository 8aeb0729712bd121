"""Left join with fills (M6), groups with NaN and NULL keys (M4), first non-null."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions.money import exact_mean, exact_sum
from tillroll.operators.aggregates import first_non_null
from tillroll.operators import joins
from tillroll.operators.joins import hot_keys, lookup_join
from tillroll.session import stored
from tillroll.plans import enrich

SALES = "transaction_id string, customer_id string, transaction_date timestamp_ntz, total_amount double"
CUSTOMERS = "customer_id string, customer_name string, email string, signup_date timestamp_ntz, tier string"
T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def test_left_join_and_fill(spark):
    sales = spark.createDataFrame([("T1", "C1", T0, 1.0), ("T2", "C2", T0, 2.0), ("T3", "UNKNOWN", T0, 3.0)], SALES)
    cust = spark.createDataFrame([
        ("C1", "Ann", "a@x", dt.datetime(2023, 1, 1), "Gold"),
        ("C1", "Ann2", "a2@x", dt.datetime(2023, 1, 1), "Gold"),
        ("C2", None, "c@x", dt.datetime(2024, 2, 1), "Silver")], CUSTOMERS)
    for hot_rows in (1_000_000, 1):  # the ordinary join, then every key apart
        j = enrich.left_join_customers(sales, cust, hot_rows=hot_rows)
        assert j.count() == 4
        m = enrich.enrichment_metrics(sales, cust).first()
        assert m.missing_customers_filled == 2
        assert m.tier_distribution == {"Bronze": 1, "Gold": 2, "Silver": 1}
        out = enrich.add_tenure(enrich.fill_customer_defaults(j))
        unk = out.where(F.col("customer_id") == "UNKNOWN").first()
        assert (unk.customer_name, unk.email, unk.tier) == ("Unknown Customer", "unknown@example.com", "Bronze")
        assert unk.signup_date == T0 and unk.customer_tenure_days == 0 and unk.customer_category == "New"
        c2 = out.where(F.col("customer_id") == "C2").first()
        assert c2.customer_name == "Unknown Customer" and c2.tier == "Silver"


def test_groups_nan_and_null_keys(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", float("nan")), (None, 1.0), ("b", 2.0)],
                               "k string, v double")
    g = (df.where(F.col("k").isNotNull()).groupBy("k")
         .agg(exact_sum("v").alias("s"), F.count(F.nanvl("v", F.lit(None))).alias("n"),
              exact_mean("v").alias("m")))
    assert {r.k: (r.s, r.n, r.m) for r in g.collect()} == {"a": (0.0, 0, None), "b": (2.0, 1, 2.0)}


def test_first_non_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "y")], "k string, t int, v string")
    assert [tuple(r) for r in first_non_null(df, "k", "v", [F.col("t")]).collect()] == [("a", "x")]


def test_tier_map(spark):
    from tillroll.plans.enrich import tier_distribution

    df = spark.createDataFrame([("Gold",), ("Bronze",), ("Gold",), (None,)], "tier string")
    assert tier_distribution(df).first().tier_distribution == {"Bronze": 1, "Gold": 2}


def _plain(facts, dim, keys, how="left"):
    return sorted(map(str, facts.join(dim, keys, how).collect()))


def _split(facts, dim, keys, how="left", hot_rows=50):
    return sorted(map(str, lookup_join(facts, dim, keys, how, hot_rows=hot_rows).select(
        *facts.join(dim, keys, how).columns).collect()))


def test_lookup_join_equals_the_plain_join(spark):
    facts = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.format_string("K%d", F.col("id") % 50)).alias("k"), F.col("id"))
    dim = spark.createDataFrame([("HOT", 1), ("HOT", 2), (None, 5)]
                                + [(f"K{i}", i) for i in range(0, 50, 2)], "k string, x int")
    for how in ("left", "inner"):
        assert _split(facts, dim, ["k"], how) == _plain(facts, dim, ["k"], how)
    assert hot_keys(facts, ["k"], hot_rows=200).count() == 2  # HOT and NULL


def test_lookup_join_timestamps_and_two_keys(spark):
    t0, t1 = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 6)
    facts = spark.createDataFrame([(t0 if i % 3 else t1, i % 2, i) for i in range(300)], "k timestamp_ntz, j int, id int")
    dim = spark.createDataFrame([(t0, 0, "a"), (t1, 1, "b")], "k timestamp_ntz, j int, x string")
    assert _split(facts, dim, ["k", "j"], hot_rows=20) == _plain(facts, dim, ["k", "j"])


def test_hot_keys_are_bounded_by_their_share(spark, monkeypatch):
    """1,500 keys over the row bound: none holds a thousandth, so none is
    hot; the ordinary join deals them out by key. Nothing is cut off a list."""
    many = stored(spark.range(0, 30_000).select((F.col("id") % 1500).alias("k"), "id"), "test")
    assert hot_keys(many, ["k"], hot_rows=10).count() == 0
    assert hot_keys(many, ["k"], hot_rows=10, share=1500).count() == 1500
    dim = spark.range(0, 1500, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    assert _split(many, dim, ["k"], hot_rows=10) == _plain(many, dim, ["k"])
    monkeypatch.setattr(joins, "HOT_SHARE", 1500)
    assert _split(many, dim, ["k"], hot_rows=10) == _plain(many, dim, ["k"])


def _tasks_with(df, predicate):
    return df.where(predicate).select(F.spark_partition_id().alias("p")).distinct().count()


def test_hot_rows_stay_spread(spark):
    """A hot key, a hot NaN and 2,000 equal rows each land in one reducer of
    the plain join; here they are not shuffled."""
    rows = spark.range(0, 8000, numPartitions=8).select(
        F.when(F.col("id") % 4 == 0, F.lit(7.0)).when(F.col("id") % 4 == 1, F.lit(float("nan")))
        .when(F.col("id") % 4 == 2, F.lit(None)).otherwise(F.col("id").cast("double")).alias("k"),
        F.lit("equal").alias("v"))
    facts = stored(rows, "test")
    dim = spark.createDataFrame([(7.0, "x"), (3.0, "y")], "k double, x string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        plain = facts.join(dim, "k", "left")
        split = lookup_join(facts, dim, ["k"], hot_rows=1000)
        for which in (F.col("k") == 7.0, F.isnan("k"), F.col("k").isNull()):
            assert _tasks_with(plain, which) == 1
            assert _tasks_with(split, which) >= 4
        assert split.count() == 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_dimension_rows_of_a_hot_key_are_salted(spark, monkeypatch):
    rows = spark.range(0, 6000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.format_string("K%d", F.col("id") % 50)).alias("k"), F.lit("equal").alias("v"))
    dim = spark.createDataFrame([("HOT", i) for i in range(20)] + [(None, 5)]
                                + [(f"K{i}", i) for i in range(0, 50, 2)], "k string, x int")
    monkeypatch.setattr(joins, "DIM_ROWS", 3)
    facts = stored(rows, "test")
    for how in ("left", "inner"):
        got = lookup_join(facts, dim, ["k"], how, hot_rows=100)
        assert "__salt" in got._jdf.queryExecution().toString()
        assert sorted(map(str, got.collect())) == _plain(facts, dim, ["k"], how)


def test_salts_spread_a_key_with_a_third_of_the_rows(spark):
    """200,000 dimension rows of one key: what a task reads is bounded by the salts."""
    facts = stored(spark.range(0, 300_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v")), "test")
    dim = spark.range(200_000).select(F.lit(0).cast("long").alias("k"), F.col("id").alias("x"))
    hot = hot_keys(facts, ["k"], hot_rows=5000)
    assert [tuple(r) for r in hot.collect()] == [(0, 100_000)]
    left, right = joins.salted(facts, dim, hot, ["k"], 5000)
    for side, rows in ((left, 100_000), (right, 20 * 200_000)):
        sizes = sorted(r["count"] for r in side.groupBy("__salt").count().collect())
        assert len(sizes) == 20 and sum(sizes) == rows and sizes[-1] <= 2 * sizes[10]


def test_enrich_with_hot_customers(spark):
    """The real pipeline with every frequent customer (the fill id among them)
    joined apart gives the same rows."""
    from conftest import SF_SMALL
    from tillroll.plans import clean
    from tillroll.sources import fixtures

    cleaned = stored(clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)), "test")
    customers = fixtures.raw_customers(spark, SF_SMALL)
    want = sorted(enrich.enriched_sales(cleaned, customers).collect())
    assert sorted(enrich.enriched_sales(cleaned, customers, hot_rows=20).collect()) == want


def test_customer_aggregates_sort_no_detail_rows(spark):
    """The totals are a hash aggregate; only the narrow top-1 rows are sorted."""
    from conftest import SF_SMALL
    from tillroll.plans import clean, metrics
    from tillroll.sources import fixtures

    enriched = enrich.enriched_sales(clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)),
                                     fixtures.raw_customers(spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = metrics.customer_aggregates(enriched)._jdf.queryExecution().executedPlan().toString()
        summary = metrics.summary_metrics(enriched)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    assert "Expand" not in summary
