import zlib

import numpy as np
import pytest
import xxhash

from tillroll.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string"


def _docs(spark, n):
    rows = [(i if i % 9 else None, None if i % 7 == 0 else "same" if i % 3 else f"t{i}é", None, "s", i, "x")
            for i in range(n)]
    return spark.createDataFrame(rows + rows[:5], SCHEMA)


def test_fisher_yates_is_a_uniform_permutation():
    firsts = np.bincount([sharding.fisher_yates(5, s)[0] for s in range(5000)], minlength=5)
    assert sorted(sharding.fisher_yates(100, 3)) == list(range(100))
    assert firsts.min() > 850 and firsts.max() < 1150


@pytest.mark.parametrize("total", [1, 7, 39, 40, 41, 85, 1234])
def test_shard_ranges(total):
    place = np.arange(total)
    shard = sharding._shard_of(place, total, 40)
    counts = np.bincount(shard, minlength=40)
    assert counts.max() - counts.min() <= 1 and len(counts) == 40
    assert (np.diff(shard) >= 0).all()
    assert (place - sharding._shard_start(shard, total, 40) >= 0).all()


@pytest.mark.parametrize("bucket_bytes", [64, 1 << 20])
def test_rows_law_and_gapless_slots(spark, bucket_bytes):
    df = _docs(spark, 400)
    out = sharding.shuffle_into_shards(df, 40, seed=5, bucket_bytes=bucket_bytes)
    rows = out.collect()
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(map(str, (r[:5] for r in df.collect())))
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(s, [])) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_same_seed_same_places_under_other_layouts(spark):
    df = _docs(spark, 200).dropDuplicates()
    place = lambda d: {(r.doc_id, r.text, r.n_chars): (r.shard, r.slot) for r in
                       sharding.shuffle_into_shards(d, 7, 1, bucket_bytes=500).collect()}
    assert place(df) == place(df.repartition(13))


def test_assignments_and_empty(spark, tmp_path):
    df = _docs(spark, 50)
    for r in sharding.assignments(df, 40).collect():
        assert r.law == "rows" and r.grown_shard is None and r.size >= 16 and r.text_crc32 >= 0
    known = spark.createDataFrame([(1, "aé", "", "", 2, "")], SCHEMA)
    r = sharding.assignments(known).first()
    assert r.text_crc32 == zlib.crc32("aé".encode()) and r.size == 19 and (r.shard, r.slot) == (0, 0)
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.assignments(empty).count() == 0
    sharding.write_shards(sharding.shuffle_into_shards(df, 4), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == df.count()


def _hash(*values, start=42):
    """The engine's xxhash64 in plain Python: each value hashed with the hash before it as seed."""
    h = start
    for v in values:
        if v is not None:
            kind = v if isinstance(v, bytes) else v.encode() if isinstance(v, str) else None
            if kind is None:
                v, width = v if isinstance(v, tuple) else (v, 8)
                kind = (v % (1 << (8 * width))).to_bytes(width, "little")
            h = xxhash.xxh64(kind, seed=h % (1 << 64)).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


def _brute(rows, weights, shards, seed, bucket_bytes):
    """(row, shard, slot) of every record, one bucket after another."""
    buckets = max(1, -(-sum(weights) // bucket_bytes))
    groups = {}
    for r, w in zip(rows, weights):
        groups.setdefault(r, []).append(w)
    held = {}
    for r, ws in groups.items():
        order, check = _hash((seed, 4), *r), _hash((seed + 2, 4), *r)
        heavy = len(ws) > 1 and sum(ws) * 8 > bucket_bytes
        for i in range(len(ws)):
            b = _hash((seed + 1, 4), (order, 8), (i if heavy else 0, 8)) % buckets
            held.setdefault(b, []).append((order, check, r))
    placed = []
    for b in sorted(held):
        members = sorted(held[b], key=lambda m: m[:2])
        placed += [members[i][2] for i in sharding.fisher_yates(len(members), seed * 1_000_003 + b)]
    small, longer = divmod(len(placed), shards)
    out, at = [], 0
    for s in range(shards):
        for slot in range(small + (s < longer)):
            out.append((*placed[at], s, slot))
            at += 1
    return out


@pytest.mark.parametrize("bucket_bytes, kinds", [(200, 10), (200, 0), (4000, 10), (1 << 20, 10)])
def test_whole_layout_against_brute_force(spark, monkeypatch, bucket_bytes, kinds):
    monkeypatch.setattr(sharding, "COPIES", 7)
    monkeypatch.setattr(sharding, "SPAN", 3)
    monkeypatch.setattr(sharding, "HEAVY_ROWS", kinds)
    rows = [(i if i % 9 else None, None if i % 7 == 0 else f"t{i}é" * (i % 5)) for i in range(150)]
    rows += [(1, "copy")] * 75 + [(None, None)] * 20 + [(2, "long " * 500)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = [16 + len((t or "").encode()) for _, t in rows]
    got = [tuple(r) for r in sharding.shuffle_into_shards(df, 13, 4, bucket_bytes=bucket_bytes).collect()]
    assert sorted(got, key=str) == sorted(_brute(rows, weights, 13, 4, bucket_bytes), key=str)


def test_copies_of_one_record_fill_no_bucket(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) AS doc_id", "repeat('x', 84) AS text")
    out = sharding.shuffle_into_shards(df, 30, 1, bucket_bytes=10_000)
    per = {r["shard"]: r["n"] for r in out.where("doc_id = -1").groupBy("shard").agg(
        sharding.F.count("*").alias("n")).collect()}
    assert len(per) == 30 and max(per.values()) < 65 and sum(per.values()) == 1000
