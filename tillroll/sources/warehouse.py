"""Catalog tables: naming, storage projection and the overwrite sink.

Each stage is published as a Parquet catalog table named after its key and
read back with ``spark.table`` (lazy, so later projections and filters are
pruned and pushed into the scan).
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.values import nan_to_null, storage_type

# Seconds that a replaced version of a table stays readable.
RETENTION_S = 3600.0
# Fixed value: the characters a name may have.
_UNSAFE = re.compile(r"[^a-zA-Z0-9_]")


def safe_name(name: str) -> str:
    """Every character outside ``[a-zA-Z0-9_]`` becomes ``_``."""
    return _UNSAFE.sub("_", str(name))


def table_name(key: str | Sequence[str]) -> str:
    """Table name of a stage key: parts joined by ``_``, made safe, lower case.

    ``["Sales", "Metrics v2"]`` -> ``sales_metrics_v2``.
    """
    parts = [key] if isinstance(key, str) else list(key)
    return safe_name("_".join(parts)).lower()


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename columns to safe names; refuse two names that become one
    (compared case-insensitively, as the catalog does)."""
    new = [safe_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        k = n.lower()
        if k in seen:
            raise ValueError(f"columns {seen[k]!r} and {old!r} both become {n!r}")
        seen[k] = old
    return df.toDF(*new)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column."""
    return df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType))
        else F.col(f.name)
        for f in df.schema.fields])


def storage_projection(df: DataFrame) -> DataFrame:
    """Cast every column to its stored type (see ``functions.values``)."""
    return df.select(*[F.col(f.name).cast(storage_type(f.dataType)).alias(f.name)
                       for f in df.schema.fields])


def prepare_for_storage(df: DataFrame) -> DataFrame:
    return storage_projection(nan_to_null_all(sanitize_columns(df)))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (under the warehouse unless ``location``)."""
    db = safe_name(database)
    loc = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{db}`{loc}")


def database_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(safe_name(database)).locationUri


@dataclass(frozen=True)
class WriteReceipt:
    table: str
    row_count: int
    columns: list[str]
    version: str = ""  # folder of the version written (Parquet tables)


def publish(df: DataFrame, database: str, key: str | Sequence[str],
            table_format: str = "parquet", retention_s: float = RETENTION_S) -> WriteReceipt:
    """Replace table ``database.table_name(key)`` with ``df``.

    The new version is a folder of its own, and the catalog moves to it in one
    step when it is complete: readers see the old rows or the new ones. Versions
    replaced less than ``retention_s`` seconds ago are kept, so queries that
    began before the switch end on the files they began with.

    The rows are counted by an ``Observation`` on the write itself: no second
    pass. An empty frame still creates the table with its columns. Writing a
    table onto itself is refused by Spark; publish each stage from its input.

    ``table_format="parquet"`` (default) writes a Parquet catalog table.
    Any other format (e.g. ``"iceberg"``) goes through ``writeTo(...)
    .createOrReplace()``, an atomic replace, and needs a catalog that
    provides that format (its jar is not part of this environment).
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"publish expects a DataFrame, got {type(df).__name__}")
    spark = df.sparkSession
    ensure_database(spark, database)
    name = f"{safe_name(database)}.{table_name(key)}"
    out = prepare_for_storage(df)
    obs = Observation(f"write_{table_name(key)}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if table_format == "parquet":
        # A new folder each time; the table moves to it once it is complete, so
        # a write that fails leaves the old rows readable.
        home = _table_home(spark, database, key)
        path = f"{home}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        out.write.format("parquet").save(path)
        _point_to(spark, name, path)
        _drop_versions(spark, home, retention_s)
    else:
        path = ""
        out.writeTo(name).using(table_format).createOrReplace()
    rows = obs.get.get("rows", 0) if out.columns else 0
    return WriteReceipt(name, int(rows), list(out.columns), path)


def read_table(spark: SparkSession, database: str, key: str | Sequence[str]) -> DataFrame:
    """Whole-table read (lazy: Catalyst prunes columns and pushes filters).

    A table that an earlier session published and this session's catalog does
    not know is found again in the database's folder and registered, so SQL
    sees it too.
    """
    name = f"{safe_name(database)}.{table_name(key)}"
    ensure_database(spark, database)
    try:
        return spark.table(name)
    except AnalysisException as e:
        found = _versions(spark, _table_home(spark, database, key))
        if e.getCondition() != "TABLE_OR_VIEW_NOT_FOUND" or not found:
            raise
    # not in this session's catalog, or being replaced by other columns just now
    if not spark.catalog.tableExists(name):
        try:
            spark.catalog.createTable(name, path=found[-1], source="parquet")
        except AnalysisException:  # the writer was faster
            pass
    return read_version(spark, found[-1])


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """One version of a table, whatever the catalog points to by now."""
    return spark.read.parquet(path)


def register_database(spark: SparkSession, database: str) -> list[str]:
    """Register every table found in the database's folder; returns their names."""
    ensure_database(spark, database)
    home = database_location(spark, database).rstrip("/")
    names = [p.rsplit("/", 1)[-1] for p in children(spark, home) if _versions(spark, p)]
    for n in names:
        read_table(spark, database, n)
    return sorted(names)


def _table_home(spark: SparkSession, database: str, key: str | Sequence[str]) -> str:
    return f"{database_location(spark, database).rstrip('/')}/{table_name(key)}"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = filesystem(spark, path)
    return [f"{path}/{s.getPath().getName()}" for s in fs.listStatus(p)] if fs.exists(p) else []


def _versions(spark: SparkSession, home: str) -> list[str]:
    """Complete versions of a table, oldest first."""
    return [p for p in _all_versions(spark, home) if version_complete(spark, p)]


def _all_versions(spark: SparkSession, home: str) -> list[str]:
    return sorted(p for p in children(spark, home) if p.rsplit("/", 1)[-1].startswith("version-"))


def version_complete(spark: SparkSession, path: str) -> bool:
    fs, done = filesystem(spark, f"{path}/_SUCCESS")
    return fs.exists(done)


def _point_to(spark: SparkSession, name: str, path: str) -> None:
    """Move the table to the version at ``path``.

    With the same columns that is one change of the catalog's entry. Other
    columns need a new entry; ``read_table`` bridges the moment between.
    """
    if spark.catalog.tableExists(name):
        old, new = spark.table(name).schema, read_version(spark, path).schema
        if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]:
            quoted = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            return
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")


def _written_ns(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].split("-")[1])


def _drop_versions(spark: SparkSession, home: str, retention_s: float) -> None:
    """Delete versions that a complete newer one replaced before the retention,
    and unfinished ones older than it."""
    done = _versions(spark, home)
    oldest = time.time_ns() - int(retention_s * 1e9)
    for path in _all_versions(spark, home):
        newer = [p for p in done if p > path]
        if newer and _written_ns(newer[0]) <= oldest:
            fs, p = filesystem(spark, path)
            fs.delete(p, True)


def receipt_frame(spark: SparkSession, receipts: Sequence[WriteReceipt]) -> DataFrame:
    """Write receipts as a small DataFrame (one row per published table)."""
    schema = "table string, row_count bigint, columns string"
    return spark.createDataFrame([(r.table, r.row_count, ",".join(r.columns)) for r in receipts], schema)
