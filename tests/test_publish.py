"""The whole published pipeline against the expected figures of FIXTURES.md (sf0.001)."""

from pyspark.sql import functions as F

from tillroll.plans.publish import run_all
from tillroll.sources.warehouse import read_table

from conftest import SF_SMALL


def test_published_pipeline_figures(spark):
    receipts = {r.table.split(".")[1]: r for r in run_all(spark, SF_SMALL, "fixture_db")}
    assert receipts["raw_sales_data"].row_count == 6405
    assert receipts["raw_customers_data"].row_count == 146
    assert receipts["cleaned_sales_data"].row_count == 5876
    assert receipts["sales_metrics"].row_count == 2279
    assert receipts["product_performance"].row_count == 200
    assert receipts["regional_performance"].row_count == 5
    assert receipts["customer_insights"].row_count == 151

    def one(key):
        return read_table(spark, "fixture_db", key).first()

    ingest = one("raw_sales_data_metadata")
    assert (ingest.row_count, ingest.duplicate_count) == (6405, 406)
    c = one("cleaned_sales_data_metadata")
    assert (c.initial_rows, c.duplicates_removed, c.missing_values_filled,
            c.invalid_prices_removed, c.final_rows) == (6405, 406, 329, 123, 5876)
    assert round(c.total_revenue, 2) == 7889579030.49
    e = one("enriched_sales_data_metadata")
    assert (e.rows_enriched, e.missing_customers_filled, e.unique_customers) == (5876, 422, 151)
    assert e.tier_distribution == "Bronze=3191,Gold=883,Silver=1802"
    tiers = {r.tier: r.tier_count for r in read_table(spark, "fixture_db", "enriched_sales_data_tiers").collect()}
    assert tiers == {"Bronze": 3191, "Silver": 1802, "Gold": 883}
    enriched = read_table(spark, "fixture_db", "enriched_sales_data")
    cats = {r.customer_category: r["count"] for r in enriched.groupBy("customer_category").count().collect()}
    assert cats == {"New": 1266, "Developing": 697, "Established": 836, "Loyal": 3077}
    assert enriched.where(F.col("customer_id") == "UNKNOWN").count() == 260
    s = one("sales_metrics_metadata")
    assert (s.days_analyzed, s.products_ranked, s.regions_analyzed, s.unique_customers) == (2279, 200, 5, 151)
    cs = one("customer_insights_metadata")
    assert round(cs.top_customer_value, 2) == 372321261.63
    assert (cs.top_known_customer, round(cs.top_known_customer_value, 2)) == ("CUST-131", 99692180.08)
    products = read_table(spark, "fixture_db", "product_performance")
    assert sorted(r.position for r in products.collect()) == list(range(1, 201))


def _copy(tmp_path):
    import shutil

    from tillroll.plans.publish import SOURCES

    for t in SOURCES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_a_killed_run_goes_on_after_the_last_written_stage(spark, tmp_path, monkeypatch):
    import pytest

    from tillroll.plans import metrics
    from tillroll.sources import fixtures

    sf = _copy(tmp_path)
    raw_builds = []
    build = fixtures.raw_sales
    monkeypatch.setattr(fixtures, "raw_sales", lambda *a: raw_builds.append(1) or build(*a))

    def killed(*a):
        raise KeyboardInterrupt("killed")

    with monkeypatch.context() as m:
        for f in ("daily_sales", "product_performance", "regional_performance", "customer_insights"):
            m.setattr(metrics, f, killed)
        with pytest.raises(KeyboardInterrupt):
            run_all(spark, sf, "restart_db")
    assert len(raw_builds) == 1
    first = spark.table("restart_db.enriched_sales_data").inputFiles()
    # the second run reads raw zero times and keeps the enriched version
    receipts = {r.table.split(".")[1]: r for r in run_all(spark, sf, "restart_db")}
    assert len(raw_builds) == 1 and len(receipts) == 16
    assert spark.table("restart_db.enriched_sales_data").inputFiles() == first
    whole = {r.table.split(".")[1]: r for r in run_all(spark, SF_SMALL, "restart_other_db")}
    assert {k: r.row_count for k, r in receipts.items()} == {k: r.row_count for k, r in whole.items()}
    for key in ("cleaned_sales_data_metadata", "raw_sales_data_metadata", "enriched_sales_data_metadata"):
        assert read_table(spark, "restart_db", key).collect() == read_table(spark, "restart_other_db", key).collect()
    # a finished run is not taken up
    run_all(spark, sf, "restart_db")
    assert len(raw_builds) == 3


def test_changed_inputs_start_anew(spark, tmp_path):
    import os

    from tillroll.plans.publish import SOURCES
    from tillroll.sources.manifest import Run, input_signature

    sf = _copy(tmp_path)
    paths = [f"{sf}/{t}.parquet" for t in SOURCES]

    def signature():
        return {"inputs": input_signature(spark, paths)}

    before = signature()
    Run(spark, "change_db", before).stage("one", lambda: spark.range(3))
    assert Run(spark, "change_db", signature()).resumed == ["one"]
    assert Run(spark, "change_db", before | {"zone": "other"}).resumed == []
    os.utime(paths[0], (1, 1))
    assert signature() != before
    assert Run(spark, "change_db", signature()).resumed == []
    # a version that is gone is written again
    run = Run(spark, "gone_db", before)
    receipt = run.stage("one", lambda: spark.range(3))
    os.remove(receipt.version.removeprefix("file:") + "/_SUCCESS")
    assert Run(spark, "gone_db", before).resumed == []
