"""Cleaning stage on the M1 micro-fixture (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.plans import clean

NAN = float("nan")
SCHEMA = ("transaction_id string, customer_id string, product_id string, quantity bigint, "
          "unit_price double, transaction_date timestamp_ntz, region string")


def ts(s):
    return dt.datetime.fromisoformat(s)


ROWS = [
    ("T1", "C1", "P1", 2, 10.0, ts("2024-01-31 23:59:59"), "North"),
    ("T1", "C1", "P1", 2, 10.0, ts("2024-01-31 23:59:59"), "North"),
    ("T2", None, "P1", 1, 5.0, ts("2024-02-01 00:00:00"), "South"),
    ("T3", "C2", "P2", 3, -4.0, ts("2024-02-01 12:00:00"), "East"),
    ("T3", "C2", "P2", 3, 4.0, ts("2024-02-01 12:00:00"), "East"),
    ("T4", "C3", "P2", 1, NAN, ts("2024-02-02 01:00:00"), "West"),
    ("T5", "C3", "P2", 1, None, ts("2024-02-02 02:00:00"), "West"),
    ("T6", "C4", "P3", 0, -0.0, ts("2024-02-02 03:00:00"), "West"),
    (None, "C4", "P3", 1, 20.0, ts("2024-02-29 05:00:00"), "North"),
    (None, "C4", "P3", 9, 20.0, ts("2024-02-29 05:00:00"), "North"),
]


def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_cleaned_rows(spark):
    out = {r.transaction_id: r for r in clean.cleaned_sales(raw(spark)).collect()}
    assert set(out) == {"T1", "T2", "T6", None}
    assert (out["T1"].total_amount, out["T1"].hour_of_day, out["T1"].day_of_week) == (20.0, 23, "Wednesday")
    assert (out["T2"].customer_id, out["T2"].total_amount, out["T2"].hour_of_day,
            out["T2"].day_of_week) == ("UNKNOWN", 5.0, 0, "Thursday")
    assert (out["T6"].total_amount, out["T6"].hour_of_day, out["T6"].day_of_week) == (0.0, 3, "Friday")
    assert (out[None].quantity, out[None].total_amount, out[None].day_of_week) == (1, 20.0, "Thursday")
    assert out["T1"].transaction_date_only == dt.date(2024, 1, 31)


def test_cleaning_metrics(spark):
    m = clean.cleaning_metrics(raw(spark)).first().asDict()
    assert m == {"initial_rows": 10, "final_rows": 4, "duplicates_removed": 3,
                 "missing_values_filled": 1, "invalid_prices_removed": 3,
                 "total_revenue": 45.0, "avg_transaction_value": 11.25}


def test_dedup_before_filter(spark):
    """T3's first copy is negative: the whole transaction disappears."""
    ids = [r.transaction_id for r in clean.cleaned_sales(raw(spark)).collect()]
    assert "T3" not in ids


def test_null_quantity_is_an_error(spark):
    import pytest

    df = spark.createDataFrame([("T9", "C1", "P1", None, 1.0, ts("2024-01-01 00:00:00"), "N")], SCHEMA)
    with pytest.raises(Exception, match="quantity is NULL"):
        clean.cleaned_sales(df).collect()


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = clean.cleaned_sales(empty)
    assert out.count() == 0
    assert out.columns == clean.CLEANED_COLUMNS
    m = clean.cleaning_metrics(empty).first()
    assert m.initial_rows == 0 and m.final_rows == 0 and m.total_revenue == 0.0


def test_casts_refuse_bad_text(spark):
    import pytest

    text = "transaction_id string, quantity string, unit_price string, transaction_date string"
    good = spark.createDataFrame([("T1", "3", "1.5", "2024-01-01 10:00:00")], text)
    r = clean.cast_types(good).first()
    assert (r.quantity, r.unit_price, r.transaction_date) == (3, 1.5, ts("2024-01-01 10:00:00"))
    for bad in [("T1", "3.5", "1.5", "2024-01-01 10:00:00"),   # not an integer
                ("T1", "3", "abc", "2024-01-01 10:00:00"),     # not a number
                ("T1", "3", "1.5", "yesterday")]:               # not a timestamp
        with pytest.raises(Exception):
            clean.cast_types(spark.createDataFrame([bad], text)).collect()


def test_sample_fraction_depends_on_the_keys_alone(spark):
    from tillroll.operators.masking import sample_fraction

    df = spark.range(0, 10000)
    a = {r.id for r in sample_fraction(df, 0.1, ["id"]).collect()}
    assert 800 < len(a) < 1200
    assert a == {r.id for r in sample_fraction(df.repartition(7), 0.1, ["id"]).collect()}
    # fractions far below a millionth: 10 and 12 rows expected
    assert 2 <= sample_fraction(spark.range(20_000_000), 5e-7, ["id"]).count() <= 30
    sparse = spark.range(12_000).select((F.col("id") * 1_000_003 * 7).alias("id"))  # leading digits 0
    assert 2 <= sample_fraction(sparse, 1e-9, ["id"]).count() <= 40


def test_dedup_removes_exactly_the_planted_copies(spark):
    """At sf0.01 the id of a sale is unique but for the planted copies, exact
    and conflicting, and the original of a conflicting one stays."""
    from tillroll.plans import clean
    from tillroll.sources import fixtures

    sf = "/root/testdata/sf0.01"
    raw = fixtures.raw_sales(spark, sf)
    lines = fixtures.table(spark, sf, "lineitem")
    planted = lines.where("l_orderkey % 20 = 3 OR l_orderkey % 50 = 7").count()
    kept = clean.dedup_transactions(raw)
    assert raw.count() - kept.count() == planted
    assert kept.agg({"quantity": "sum"}).first()[0] == lines.selectExpr(
        "sum(cast(l_quantity as bigint))").first()[0]
