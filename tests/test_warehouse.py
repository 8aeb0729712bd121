"""Names (M7), storage projection, publish/read round trip, empty tables (M8)."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tillroll.functions.values import storage_type
from tillroll.plans import metrics
from tillroll.sources.warehouse import (
    publish, read_table, safe_name, sanitize_columns, storage_projection, table_name,
)


def test_names():
    assert table_name(["Sales", "Metrics v2"]) == "sales_metrics_v2"
    assert safe_name("a b") == "a_b"


def test_sanitize_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, c int")
    assert sanitize_columns(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    with pytest.raises(ValueError):
        sanitize_columns(spark.sql("SELECT 1 AS A, 2 AS a"))


def test_storage_types(spark):
    assert storage_type(T.IntegerType()) == T.LongType()
    assert storage_type(T.FloatType()) == T.DoubleType()
    assert storage_type(T.DecimalType(10, 2)) == T.DoubleType()
    assert storage_type(T.TimestampType()) == T.TimestampNTZType()
    with pytest.raises(TypeError):
        storage_type(T.ArrayType(T.IntegerType()))
    df = spark.createDataFrame([(1, 1.5, True, dt.date(2024, 1, 1), "x")],
                               "a int, b float, c boolean, d date, e string")
    assert [f.dataType for f in storage_projection(df).schema.fields] == [
        T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.StringType()]


def test_publish_roundtrip_twice_and_nan(spark):
    df = spark.createDataFrame([("a b", 1, float("nan")), ("c", 2, 3.0)], "`k v` string, n int, x double")
    for _ in range(2):  # overwrite works repeatedly
        r = publish(df, "t_db", ["Round", "Trip"])
        assert r.table == "t_db.round_trip" and r.row_count == 2 and r.columns == ["k_v", "n", "x"]
    back = read_table(spark, "t_db", "round_trip")
    assert sorted(back.collect()) == sorted([("a b", 1, None), ("c", 2, 3.0)])
    assert dict(back.dtypes)["n"] == "bigint"


def test_empty_table_published(spark):
    empty = spark.createDataFrame([], "product_id string, total_revenue double, rank_by_revenue double")
    r = publish(empty, "t_db", "empty_products")
    assert r.row_count == 0
    back = read_table(spark, "t_db", "empty_products")
    assert back.count() == 0 and back.columns == ["product_id", "total_revenue", "rank_by_revenue"]
    assert metrics.top_product(empty).count() == 0


def test_shuffle_sizing():
    from tillroll.session import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 1024 ** 4) == 819200


def test_failed_overwrite_keeps_the_old_table(spark):
    import pytest
    from pyspark.sql import functions as F

    from tillroll.sources.warehouse import publish, read_table

    publish(spark.range(0, 5), "switch_db", "kept")
    bad = spark.range(0, 5).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("bad row")).cast("long"))
                                       .otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad row"):
        publish(bad, "switch_db", "kept")
    assert read_table(spark, "switch_db", "kept").count() == 5
    publish(spark.range(0, 7), "switch_db", "kept")
    assert read_table(spark, "switch_db", "kept").count() == 7


def test_tables_of_an_earlier_session_are_found_again(spark):
    from tillroll.sources.warehouse import publish, read_table, register_database

    publish(spark.range(0, 4), "later_db", "first one")
    publish(spark.range(0, 6), "later_db", "second")
    # a later session has the same folder and an empty catalog
    spark.sql("DROP TABLE later_db.first_one")
    spark.sql("DROP TABLE later_db.second")
    assert read_table(spark, "later_db", "first one").count() == 4
    assert register_database(spark, "later_db") == ["first_one", "second"]
    assert spark.sql("SELECT count(*) FROM later_db.second").first()[0] == 6


def test_readers_during_overwrites_see_one_version(spark):
    """A reader looping over 20 overwrites, every other with another column."""
    import threading

    from pyspark.sql import functions as F

    def version(n):
        df = spark.range(0, 100 + n).withColumn("n", F.lit(n))
        return df.withColumn("more", F.lit(n)) if n % 4 >= 2 else df

    publish(version(0), "loop_db", "busy")
    stop, seen, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                r = read_table(spark, "loop_db", "busy").agg(
                    F.count(F.lit(1)).alias("rows"), F.min("n").alias("a"), F.max("n").alias("b")).first()
                seen.append((r.rows, r.a, r.b))
            except Exception as e:  # noqa: BLE001
                failed.append(str(e))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 21):
        publish(version(n), "loop_db", "busy")
    stop.set()
    reader.join()
    assert not failed, failed[0]
    assert seen and all(a == b and rows == 100 + a for rows, a, b in seen)
    assert read_table(spark, "loop_db", "busy").count() == 120
    assert spark.sql("SELECT max(n) FROM loop_db.busy").first()[0] == 20


def test_a_query_begun_before_the_switch_ends(spark):
    from tillroll.sources.warehouse import children, database_location

    publish(spark.range(0, 10), "old_db", "kept")
    begun = read_table(spark, "old_db", "kept")
    publish(spark.range(0, 20), "old_db", "kept")
    assert begun.count() == 10 and read_table(spark, "old_db", "kept").count() == 20
    # without a retention only the newest version stays
    publish(spark.range(0, 30), "old_db", "kept", retention_s=0)
    home = f"{database_location(spark, 'old_db').rstrip('/')}/kept"
    assert len(children(spark, home)) == 1 and read_table(spark, "old_db", "kept").count() == 30
