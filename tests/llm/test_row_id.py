from pyspark.sql import functions as F

from tillroll.llm import jaccard, line_dedup
from tillroll.llm.common import lookup_split, with_row_id

CORES = "spark.sql.leafNodeDefaultParallelism"  # stands in for the cores registered just then


def _files(spark, tmp_path, rows):
    """``rows`` in 8 files, which 1 core scans as one partition and 64 cores as 8."""
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def _with_cores(spark, n, job):
    before = spark.conf.get(CORES, None)
    spark.conf.set(CORES, str(n))
    try:
        return job()
    finally:
        spark.conf.unset(CORES) if before is None else spark.conf.set(CORES, before)


def test_numbers_stay_when_cores_change(spark, tmp_path):
    df = _files(spark, tmp_path, [(i, f"t{i}") for i in range(200)])
    parts = [_with_cores(spark, n, lambda: df.select("*").rdd.getNumPartitions()) for n in (1, 64)]
    assert parts[0] != parts[1]
    numbered = _with_cores(spark, 1, lambda: with_row_id(df, "row"))
    seen = [_with_cores(spark, n, lambda: {r.doc_id: r.row for r in numbered.select("*").collect()})
            for n in (1, 64)]
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 200


def test_line_dedup_when_cores_change(spark, tmp_path):
    df = _files(spark, tmp_path, [(i, f"x{i}\nsame\nthree\nlines\ny{i}") for i in range(200)])
    out = _with_cores(spark, 1, lambda: line_dedup.drop_lines(df))
    got = {r.doc_id: r.text for r in _with_cores(spark, 64, out.collect)}
    assert got == {i: f"x{i}\ny{i}" if i else "x0\nsame\nthree\nlines\ny0" for i in range(200)}


def test_first_of_classes_when_cores_change(spark, tmp_path):
    df = _files(spark, tmp_path, [(i, f"a{i // 2} b{i // 2} c d e f g") for i in range(200)])
    out = _with_cores(spark, 1, lambda: jaccard.first_of_classes(df))
    assert sorted(r.doc_id for r in _with_cores(spark, 64, out.collect)) == list(range(0, 200, 2))


def test_null_keys_are_spread_and_match_nothing(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"))
    keyed = spark.range(0, 4000, 3).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n"))
    joined = lookup_split(rows, keyed, ["k"], "n", 4000, F.xxhash64("id"))
    plan = joined._jdf.queryExecution().toString()
    assert "isnotnull(k" in plan
    got = joined.collect()
    assert len(got) == 4000 and all((r.n == 1) == (r.k is not None) for r in got)
