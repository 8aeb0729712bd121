"""Results do not depend on the execution layout (partition counts, AQE),
as they must not when partitions are recomputed after an executor loss."""

from tillroll.plans import clean, enrich, metrics
from tillroll.sources import fixtures

from conftest import SF_SMALL


def _run(spark, partitions, aqe):
    old = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        enriched = enrich.enriched_sales(clean.cleaned_sales(fixtures.raw_sales(spark, SF_SMALL)),
                                         fixtures.raw_customers(spark, SF_SMALL),
                                         hot_rows=50)
        return {
            "customers": sorted(metrics.customer_insights(enriched).collect()),
            "products": sorted(metrics.product_performance(enriched).collect()),
            "regions": sorted(metrics.regional_performance(enriched).collect()),
            "cleaning": clean.cleaning_metrics(fixtures.raw_sales(spark, SF_SMALL)).collect(),
        }
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])


def test_same_results_under_other_layouts(spark):
    a = _run(spark, 3, "false")
    b = _run(spark, 11, "true")
    assert a == b
