import math
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillroll.llm import ann, common, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string"


def _frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v],
                                   1, "x", "y") for i, v in zip(ids, vectors)], SCHEMA)


def _random(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.uniform(0.1, 3, (n, 1))
    return x.astype(np.float32)


def _good(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def _brute_products(ids, vectors, k, every):
    ints = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in zip(ids, vectors) if _good(v)]
    out = set()
    for qi, q in ints:
        if qi % every == 0:
            near = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in ints if ci != qi)[:k]
            out |= {(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(near)}
    return out


@pytest.mark.parametrize("block", [16, 8192])
def test_products_match_brute_force(spark, block):
    vectors = list(_random(300, 8, 1))
    vectors[10:60] = [vectors[3]] * 50  # a group of copies, longer than a block
    vectors[70], vectors[71], vectors[72] = None, [1.0, float("nan")] + [0.0] * 6, [None] + [1.0] * 7
    vectors[73], vectors[74], vectors[75] = [float("inf")] * 8, [], [0.0] * 8
    df = _frame(spark, vectors)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 7, block=block)
    assert {tuple(r) for r in got.collect()} == _brute_products(range(300), vectors, 7, 10)


def test_products_prune_but_keep_all(spark):
    x = _random(3000, 6, 2).astype(np.float64)
    x = np.floor(x * 1024)
    x = x[np.argsort(-(x * x).sum(1))]
    q = x[::37]
    rotation = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    best = topk.search_block(np.arange(-len(q), 0), q, np.full(len(q), topk.NONE), np.arange(len(x)), x,
                             rotation, 5, 2, 64)
    for b, row in zip(best, q):
        s = (x @ row).astype(np.int64)
        order = np.lexsort((np.arange(len(x)), -s))[:5]
        assert b.id.tolist() == order.tolist() and b.score.tolist() == s[order].tolist()


def test_wide_products():
    q = np.array([2.0 ** 30, 3.0])
    assert topk.products(np.array([[2.0 ** 30, 1.0]]), q).tolist() == [2 ** 60 + 3]
    with pytest.raises(ArithmeticError):
        topk.products(np.array([[2.0 ** 40, 1.0]]), q)


def test_few_and_no_candidates(spark):
    df = _frame(spark, [[1.0, 0.0], [0.5, 0.5]], [0, 7])
    assert {tuple(r) for r in topk.top_k(df, df, 10).collect()} == {(0, 1, 7, 512 * 1024), (7, 1, 0, 512 * 1024)}
    none = _frame(spark, [])
    assert topk.top_k(none, none, 10).count() == 0
    assert ann.search(ann.build_index(none), none, 5).count() == 0
    assert ann.search(ann.build_index(df), df, 5).count() == 2


def test_nearest_recall_and_exact_scores(spark):
    vectors = list(_random(1200, 24, 3))
    vectors[5], vectors[6], vectors[7] = None, [0.0] * 24, [float("nan")] * 24
    vectors[100:400] = [vectors[50]] * 300
    df = _frame(spark, vectors)
    index = ann.build_index(df, block=500)
    assert index[0].count() >= 3
    rows = ann.search(index, df.where("vec_id % 50 = 0"), 5).collect()
    good = [i for i, v in enumerate(vectors) if _good(v) and any(v)]
    x = np.array([vectors[i] for i in good], np.float64)
    found = wanted = 0
    for q in (i for i in good if i % 50 == 0):
        mine = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        s = np.round(ann.cosine(x, np.array(vectors[q], np.float64)), 12)
        order = [good[j] for j in np.lexsort((good, -s)) if good[j] != q][:5]
        found += len(set(order) & {m[1] for m in mine})
        wanted += 5
        for _, i, score in mine:
            assert abs(score - s[good.index(i)]) < 1e-12
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(mine, mine[1:]))
    assert found / wanted >= 0.9


def test_nearest_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = ann.search(ann.build_index(df, block=200), df.where("vec_id % 50 = 0"), 5).collect()
    data = df.collect()
    ids = np.array([r.vec_id for r in data])
    x = np.array([r.embedding for r in data], np.float64)
    hit = 0
    for q in ids[ids % 50 == 0]:
        s = ann.cosine(x, x[ids == q][0])
        s[ids == q] = -9
        hit += len({r.vec_id for r in rows if r.query_id == q} & set(ids[np.argsort(-s)[:5]].tolist()))
    assert hit / len(rows) >= 0.9


def test_footrule_of_prefixes():
    order = np.array([[2, 0, 1], [0, 1, 2], [3, 4, 5]], np.int32)
    starts, rows, positions = ann.inverted_files(order, 6)
    assert ann.footrule(order[0], starts, rows, positions, 3).tolist() == [0, 4, 6]


def test_index_posts_256_pivots_of_every_row(spark):
    blocks, pivots = ann.build_index(_frame(spark, _random(700, 24, 5)), block=300)
    got = blocks.collect()
    assert len(pivots) == 512 and sum(len(r.ids) // 8 for r in got) == 700
    for r in got:
        assert len(r.positions) // 2 == len(r.rows) // 4 == 256 * (len(r.ids) // 8)


def test_distances_against_brute_force():
    order = np.array([np.random.default_rng(i).permutation(512)[:256] for i in range(40)], np.int32)
    at = ann.places(*ann.inverted_files(order, 512), 40, 256)
    for q in order[:3].tolist():
        assert ann.distances(np.array(q), at).tolist() == [
            sum(abs((r.index(p) if p in r else 256) - i) for i, p in enumerate(q)) for r in order.tolist()]


def test_near_copies_do_not_crowd_the_pivots(spark):
    x = _random(900, 24, 8)
    x[:450] = x[0] + 0.01 * x[:450]
    _, pivots = ann.build_index(_frame(spark, x), pivots=200)
    near = pivots @ pivots.T - np.eye(200)
    assert len(pivots) == 200 and near.max() < ann.ALIKE
    few = ann.apart(pivots[[0, 0, 1]], 3)
    assert few.shape == (3, 24) and (few[0] == few[2]).all()


def test_a_task_streams_the_index_and_holds_the_queries(spark):
    broadcast, batch = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.execution.arrow.maxBytesPerBatch"
    kept = spark.conf.get(broadcast)
    spark.conf.unset(batch)
    spark.conf.set(broadcast, "-1")
    try:
        df = _frame(spark, _random(60, 8, 6))
        product = ann.search(ann.build_index(df, block=20), df, 3)._jdf.queryExecution().sparkPlan().toString()
        assert int(spark.conf.get(batch)) == common.BATCH_BYTES  # a pair of blocks at a time
    finally:
        spark.conf.set(broadcast, kept)
    product = product[product.index("CartesianProduct"):]
    assert product.index("positions#") < product.index("q_ids#")


def test_each_block_is_a_row_group(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROW_GROUP", 1000, raising=False)
    x = [[1.0, 2.0, 3.0]] * 90 + [[float(i), 1.0, 0.0] for i in range(30)]
    blocks, _ = ann.build_index(_frame(spark, x, [7] * 90 + list(range(100, 130))), block=10)
    assert blocks.count() >= 12  # equal rows stay together, so one task writes several blocks
    for f in blocks.inputFiles():
        m = pq.ParquetFile(Path(f.removeprefix("file://"))).metadata
        assert m.num_row_groups == m.num_rows


@pytest.mark.parametrize("n", [5, 30, 60])
def test_pivots_are_drawn_from_small_hashes(spark, n):
    v = F.array((F.col("id") % 40).cast("double") - 20, F.lit(1.0))  # 40 different, 500 of each
    rows = spark.range(20_000).select("id", v.alias("v"))
    want = [r.v for r in rows.select("v").distinct().orderBy(F.xxhash64(F.lit(3), "v"), "v").limit(n).collect()]
    got = ann.draw(rows, 20_000, n, 3)
    assert got == want and len(got) == min(n, 40)


def test_orders_of_pivots_take_little_memory():
    x = _random(8192, 64, 9).astype(np.float64)
    pivots = x[:512] / np.sqrt((x[:512] ** 2).sum(1, keepdims=True))
    tracemalloc.start()
    order = ann.prefixes(x, pivots, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # 8 MB of them are the result
    near = np.round(x / np.sqrt((x * x).sum(1, keepdims=True)) @ pivots.T, 12)
    assert (order == np.argsort(-near, axis=1, kind="stable")[:, :256]).all()
