"""Elapsed and calendar days, tenure buckets (M2)."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions.dates import calendar_days, elapsed_days, tenure_category


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


CASES = [
    ("2024-01-01 23:00:00", "2024-01-02 01:00:00", 0, 1, "New"),
    ("2024-01-02 01:00:00", "2024-01-01 23:00:00", -1, -1, "New"),
    ("2024-01-02 01:00:00", "2024-01-02 00:30:00", -1, 0, "New"),
    ("2023-01-01 00:00:00", "2023-01-30 23:59:59", 29, 29, "New"),
    ("2023-01-01 00:00:00", "2023-01-31 00:00:00", 30, 30, "Developing"),
    ("2024-01-03 01:00:00", "2024-01-01 00:00:00", -3, -2, "New"),
    (None, None, None, None, "Loyal"),
]


def test_days_and_category(spark):
    df = spark.createDataFrame([(ts(a), ts(b)) for a, b, *_ in CASES], "a timestamp_ntz, b timestamp_ntz")
    out = df.select(elapsed_days("a", "b").alias("e"), calendar_days("a", "b").alias("c"),
                    tenure_category(calendar_days("a", "b")).alias("k")).collect()
    assert [(r.e, r.c, r.k) for r in out] == [(e, c, k) for *_, e, c, k in CASES]


def test_category_bounds(spark):
    df = spark.createDataFrame([(d,) for d in [364, 365, 729, 730, -5]], "d bigint")
    assert [r.k for r in df.select(tenure_category("d").alias("k")).collect()] == [
        "Developing", "Established", "Established", "Loyal", "New"]


def test_zone_independent(spark):
    """Elapsed days across a daylight-saving change do not depend on the session zone."""
    df = spark.createDataFrame([(ts("2024-03-09 12:00:00"), ts("2024-03-10 12:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = df.select(elapsed_days("a", "b").alias("e"), F.hour("b").alias("h")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.e, r.h) == (1, 12)
