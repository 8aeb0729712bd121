"""Session construction and cluster-setting helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the pipeline relies on. Everything else is left to the cluster.
PIPELINE_CONF = {
    # Timestamps in the data are zone-less; keep anything zone-aware in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce tiny shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts go by measured bytes of shuffled rows only. Sizes estimated
    # from compressed files would make a fact table the build side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Reduce-side partitions AQE aims for when it coalesces, and pieces of files
    # read by a task. A sort holds up to ten times these (compressed) bytes in
    # memory, so they bound the memory of a task whatever the size of the input.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
    # A join whose one side has no shuffled partition above this is hashed, and
    # neither side is sorted; others are sort-merge joins.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
}

SHUFFLE_BYTES_PER_PARTITION = 128 * 1024 * 1024
# Input bytes for each initial shuffle partition of the sales stages: their
# widest shuffles write three to five times the (compressed) input.
INPUT_BYTES_PER_PARTITION = 16 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, bytes_per_partition: int = SHUFFLE_BYTES_PER_PARTITION,
                           minimum: int = 8) -> int:
    """Initial shuffle partitions for an input of ``input_bytes``.

    AQE can merge small shuffle partitions but never splits past the initial
    count, so the count is sized for the largest shuffle (at 128 MB 100 TB of
    Parquet give about 800k partitions), which AQE then coalesces wherever a
    stage writes less.
    """
    return max(minimum, -(-int(input_bytes) // bytes_per_partition))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the initial shuffle partition count for ``input_bytes`` of input."""
    n = shuffle_partitions_for(input_bytes, INPUT_BYTES_PER_PARTITION)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def widen_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles begin with as many partitions as ``input_bytes`` asks for, or
    with the session's own number if that is more (AQE merges small ones)."""
    n = max(shuffle_partitions_for(input_bytes, INPUT_BYTES_PER_PARTITION),
            int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def build_session(master: str | None = None, app: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the pipeline settings.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in PIPELINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names it in ``spark.checkpoint.dir`` (or has already called
    ``setCheckpointDir``). Only a local session without one gets a fresh
    scratch folder; a cluster without one is refused, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/object store) before running the pipeline on a cluster")
    scratch = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the pipeline settings to an existing session (all can be set at run time)."""
    for k, v in PIPELINE_CONF.items():
        spark.conf.set(k, v)


# Paths written by ``stored``, by application, for ``release_stored``.
_STORED: dict[str, list[str]] = {}


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is read straight from files or memory: scanning it again
    repeats no join, aggregation or shuffle."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return not any(x in plan for x in ("Join", "Aggregate", "Window", "Repartition", "Rebalance",
                                       "Sort", "Expand", "Generate", "Intersect", "Except"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The lineage ends at the files, which outlive any executor, and all later
    jobs see the same rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tillroll-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``stored(df)`` and aggregates of its rows, taken in the tasks that write
    them (each counted once, however often it is run)."""
    seen = Observation(label)
    out = stored(df.observe(seen, *[c.alias(name) for name, c in figures.items()]), label)
    return out, seen.get


def stored_so_far(spark: SparkSession) -> int:
    """Number of folders ``stored`` has written in this application, for ``release_stored``."""
    return len(_STORED.get(spark.sparkContext.applicationId, []))


def release_stored(spark: SparkSession, since: int = 0) -> int:
    """Delete what ``stored`` wrote after the first ``since`` folders, once the
    results that read them are written. Returns the number deleted."""
    paths = _STORED.get(spark.sparkContext.applicationId, [])
    gone, paths[since:] = paths[since:], []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)
