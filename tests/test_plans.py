"""Physical-plan properties that matter at scale."""

from tillroll.plans import clean, enrich, metrics
from tillroll.sources import fixtures

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    enriched = enrich.enriched_sales(clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)),
                                     fixtures.raw_customers(spark, SF_SMALL))
    for df in [enriched, metrics.daily_sales(enriched), metrics.customer_insights(enriched),
               metrics.product_performance(enriched), metrics.regional_performance(enriched)]:
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = clean.dedup_transactions(fixtures.raw_sales(spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p
    # the partial limit sits below the exchange
    assert p.index("Exchange hashpartitioning(transaction_id") < p.rindex("WindowGroupLimit")


def test_scan_is_pruned(spark):
    df = metrics.daily_sales(enrich.enriched_sales(
        clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)), fixtures.raw_customers(spark, SF_SMALL)))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in p and "l_tax" not in p and "c_acctbal" not in p


def test_customer_rank_has_no_single_partition_over_rows(spark):
    """The only single-partition exchange carries the totals of the ranges."""
    from tillroll.operators.ranking import average_rank

    enriched = enrich.enriched_sales(clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)),
                                     fixtures.raw_customers(spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(average_rank(metrics.customer_aggregates(enriched), "total_revenue", "r", keys_per_range=10))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = p.split("Exchange SinglePartition")[1:]
    assert parts, "expected the window over the range totals"
    for part in parts:
        assert "functions=[partial_sum(__w" in part.split("Scan parquet")[0], part[:300]


def test_facts_are_no_build_side(spark):
    """Line items and orders are shuffled, whatever their files' sizes; only nation and region are broadcast."""
    from tillroll.session import apply_pipeline_conf

    apply_pipeline_conf(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(fixtures.raw_sales(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for part in p.split("BroadcastExchange")[1:]:
        first_scan = part.split("FileScan parquet")[1] if "FileScan parquet" in part else part
        assert "n_nationkey" in first_scan.split("]")[0] or "r_regionkey" in first_scan.split("]")[0], first_scan[:200]
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p


def test_cleaning_figures_scan_the_source_once(spark):
    got = clean.cleaning_metrics(fixtures.raw_sales(spark, SF_SMALL))
    p = got._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in p  # both passes read the stored rows
    assert got.first().initial_rows == 6405
