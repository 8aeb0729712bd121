"""Publish every stage as a table; each stage reads its input table back.

Writing a stage cuts its lineage: later stages (and their retries after an
executor loss) start from the stored table, not from the raw sources, and
the three metric stages share one enriched table instead of recomputing it.
A manifest (``sources.manifest``) records each written stage: a run that
failed is taken up after its last complete stage, unless an input or a setting
has changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import clean, enrich, metrics, quality
from tillroll.operators.aggregates import value_counts
from tillroll.session import release_stored, stored_so_far
from tillroll.sources import fixtures
from tillroll.sources.manifest import Run, input_signature
from tillroll.sources.warehouse import WriteReceipt


# To be raised when a stage gives other rows: an older unfinished run is then not taken up.
STAGES_VERSION = 1
SOURCES = fixtures.SOURCES


def run_all(spark: SparkSession, sf_dir: str, database: str) -> list[WriteReceipt]:
    """Run raw -> cleaned -> enriched -> metrics, publishing each stage, and
    each stage's run figures as small tables ``<stage>_metadata`` (and the
    tier counts of the enriched stage). Additive figures come from the writes
    themselves, the others from the stored tables. Products are published with
    their position in rank order.
    """
    before = stored_so_far(spark)
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCES]
    run = Run(spark, database, {"inputs": input_signature(spark, paths), "stages": STAGES_VERSION,
                                "zone": spark.conf.get("spark.sql.session.timeZone")})
    raw_receipt = run.stage("raw_sales_data", lambda: fixtures.raw_sales(spark, sf_dir))
    receipts = [raw_receipt, run.stage("raw_customers_data", lambda: fixtures.raw_customers(spark, sf_dir))]
    raw, customers = run.read("raw_sales_data"), run.read("raw_customers_data")
    receipts.append(run.stage("cleaned_sales_data", lambda: clean.cleaned_with_figures(raw)))
    cleaned = run.read("cleaned_sales_data")
    receipts.append(run.stage("enriched_sales_data", lambda: enrich.enriched_with_figures(cleaned, customers)))
    enriched = run.read("enriched_sales_data")
    # The four metric stages only depend on the enriched table: their jobs
    # are submitted together so small stages of one fill the idle cores of
    # another (Spark schedules jobs from several threads).
    receipts += _together(run, [
        ("sales_metrics", lambda: metrics.daily_sales(enriched)),
        ("product_performance", lambda: metrics.sorted_products(metrics.product_performance(enriched))),
        ("regional_performance", lambda: metrics.regional_performance(enriched)),
        ("customer_insights", lambda: metrics.customer_insights(enriched)),
    ])
    products, customers_out = run.read("product_performance"), run.read("customer_insights")
    cleaning, enrichment = run.figures("cleaned_sales_data"), run.figures("enriched_sales_data")
    receipts += _together(run, [
        ("raw_sales_data_metadata", lambda: quality.ingest_of(
            spark, raw_receipt.row_count, raw_receipt.columns, raw_receipt.row_count - cleaning["kept"])),
        ("raw_customers_data_metadata", lambda: quality.row_count(customers)),
        ("cleaned_sales_data_metadata", lambda: clean.metrics_of(spark, raw_receipt.row_count, cleaning)),
        ("enriched_sales_data_metadata", lambda: enrich.metrics_of(cleaned, enriched, enrichment)
            .withColumn("tier_distribution", enrich.map_text("tier_distribution"))),
        ("enriched_sales_data_tiers", lambda: value_counts(enriched, "tier", "tier_count")),
        ("sales_metrics_metadata", lambda: metrics.summary_metrics(enriched)),
        ("product_performance_metadata", lambda: metrics.top_product(products)),
        ("customer_insights_metadata", lambda: metrics.customer_summary(customers_out)),
    ])
    run.finish()
    release_stored(spark, before)  # every table is written
    return receipts


def _together(run: Run, stages: Sequence[tuple[str, Callable[[], DataFrame]]]) -> list[WriteReceipt]:
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = [pool.submit(run.stage, key, build) for key, build in stages]
        return [f.result() for f in futures]
