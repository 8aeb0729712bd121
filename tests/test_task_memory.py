"""What a task holds is bounded by the size of its piece, not by the input."""

import pytest

from tillroll.session import PIPELINE_CONF, apply_pipeline_conf, widen_shuffles
from tillroll.sources import fixtures

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def conf(spark):
    kept = {k: spark.conf.get(k, None) for k in [INITIAL, *PIPELINE_CONF]}
    apply_pipeline_conf(spark)
    yield spark.conf
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffles_begin_with_partitions_for_the_input(spark, conf):
    own = int(conf.get("spark.sql.shuffle.partitions"))
    assert widen_shuffles(spark, 0) == own  # never fewer than the session's
    assert widen_shuffles(spark, 6 << 30) == 384
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    assert "384)" in _plan(rows.groupBy("k").count())


def test_bytes_of_the_source_files(spark, tmp_path):
    for name in ("region", "lineitem"):
        (tmp_path / f"{name}.parquet").write_bytes(b"x" * 100)
    assert fixtures.input_bytes(spark, str(tmp_path)) == 200  # missing tables count nothing


def test_tasks_take_small_pieces(conf):
    for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        assert conf.get(k) == "32MB"


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_join_with_a_small_side_sorts_neither(spark, conf, how):
    conf.set(BROADCAST, "-1")
    facts = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, w string")
    joined = facts.join(dim, "k", how)
    rows = sorted(map(tuple, joined.collect()), key=str)
    assert "ShuffledHashJoin" in _plan(joined)
    both = [(1, "a", "x"), (1, "a", "x"), (2, "b", "y"), (2, "b", "z")]
    none = [(3, "d", None), (None, "c", None)] if how == "left" else []
    assert rows == sorted(both + none, key=str)
