"""Empty inputs (M8): every stage returns its columns and no rows."""

from pyspark.sql import functions as F

from tillroll.operators.ranking import average_rank, positions
from tillroll.plans import clean, enrich, metrics

SALES = ("transaction_id string, customer_id string, product_id string, quantity bigint, "
         "unit_price double, transaction_date timestamp_ntz, region string")
CUSTOMERS = "customer_id string, customer_name string, email string, signup_date timestamp_ntz, tier string"


def test_rank_and_positions_of_nothing(spark):
    df = spark.createDataFrame([], "id int, v double")
    r = average_rank(df, "v", "r")
    assert r.count() == 0 and r.columns == ["id", "v", "r"]
    p = positions(df, [F.col("v"), F.col("id")], "pos")
    assert p.count() == 0 and p.columns == ["id", "v", "pos"]


def test_all_stages_on_empty_input(spark):
    raw = spark.createDataFrame([], SALES)
    customers = spark.createDataFrame([], CUSTOMERS)
    cleaned = clean.cleaned_sales(raw)
    enriched = enrich.enriched_sales(cleaned, customers)
    assert enriched.count() == 0 and len(enriched.columns) == 18
    outs = {
        "daily": (metrics.daily_sales(enriched), metrics.DAILY_COLUMNS),
        "product": (metrics.product_performance(enriched), metrics.PRODUCT_COLUMNS),
        "region": (metrics.regional_performance(enriched), metrics.REGION_COLUMNS),
        "customer": (metrics.customer_insights(enriched), metrics.CUSTOMER_COLUMNS),
    }
    for name, (df, cols) in outs.items():
        assert df.count() == 0 and df.columns == cols, name
    assert metrics.top_product(outs["product"][0]).count() == 0
    s = metrics.summary_metrics(enriched).first()
    assert (s.total_revenue, s.total_transactions, s.unique_customers) == (0.0, 0, 0)
    cs = metrics.customer_summary(outs["customer"][0]).first()
    assert (cs.total_customers, cs.top_customer_value, cs.top_known_customer) == (0, None, None)
