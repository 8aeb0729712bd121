import math
import random
from itertools import combinations

import numpy as np
import pytest

from tillroll.llm import jaccard
from tillroll.llm.components import components

SCHEMA = "doc_id long, text string, row string, id string, sid string"


def _shingles(text):
    w = (text or "").lower().replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else \
        frozenset([tuple(w)]) if w else frozenset()


def _brute(rows):
    """Per position: class id, size, links, linked sets."""
    sets = [_shingles(t) for _, t in rows]
    n = len(rows)
    parent, links, linked = list(range(n)), [0] * n, [set() for _ in range(n)]

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(n), 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * len(a & b) >= 4 * len(a | b):
            links[i] += 1
            links[j] += 1
            if a != b:
                linked[i].add(b)
                linked[j].add(a)
            parent[root(i)] = root(j)
    out = []
    for i in range(n):
        mine = [k for k in range(n) if root(k) == root(i)]
        ids = [rows[k][0] for k in mine if rows[k][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(mine), links[i], len(linked[i])))
    return sorted(out, key=str)


def _run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    got = jaccard.link_classes(df, **options).select(
        "id", "class_id", "class_size", "n_links", "n_linked_sets").collect()
    return sorted((tuple(r) for r in got), key=str)


def _corpus(seed, n=160):
    rng = random.Random(seed)
    passage = " ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(30))
    rows = []
    while len(rows) < n:
        words = [rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.randrange(3, 80))]
        base = " ".join(words) + (" " + passage if rng.random() < 0.6 else "")
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = base.split()
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(5))
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("limit,block", [(128, 512), (4, 3)])
def test_all_links_against_brute_force(spark, limit, block):
    rows = _corpus(limit) + [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "One  two"),
                             (None, "one two"), (905, "x " * 30000), (905, "x " * 30000), (906, "a b c d e")]
    assert _run(spark, rows, limit=limit, block=block) == _brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(150)] = f"n{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    assert _run(spark, rows, limit=16, block=40) == _brute(rows)


def test_nothing_links_and_empty(spark):
    assert _run(spark, [(1, "a b c d e f"), (2, "g h i j k l")]) == [(1, 1, 1, 0, 0), (2, 2, 1, 0, 0)]
    assert _run(spark, []) == []


def test_first_of_classes_keeps_columns(spark):
    df = spark.createDataFrame([(3, "a b c d e f", "p", "q", "r"), (2, "a b c d e f", "s", "t", "u"),
                                (None, None, "v", "w", "x"), (7, "other words entirely here now", "a", "b", "c")], SCHEMA)
    got = jaccard.first_of_classes(df)
    assert got.columns == df.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["2", "7", "None"]


def test_runs_needed_meets_the_recall():
    assert jaccard.runs_needed(0.8, 1, 0.9999) < jaccard.runs_needed(0.8, 3, 0.9999)
    rng = np.random.default_rng(0)
    met = 0
    for t in range(400):
        common = rng.integers(0, 2 ** 63, 160, dtype=np.uint64)
        a = np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, 20, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, 20, dtype=np.uint64)]))
        root = np.array([t + 1], np.uint64)
        met += bool(np.intersect1d(jaccard.branches(root, a, 0.8)[1], jaccard.branches(root, b, 0.8)[1]).size)
    assert abs(met / 400 - (1 - math.exp(-2 / 1.8))) < 0.08


def test_runs_needed_for_contained_sets():
    """A document and itself with a quarter appended share one branch on average."""
    rng = np.random.default_rng(2)
    met = 0
    for t in range(2000):
        b = np.unique(rng.integers(0, 2 ** 63, 200, dtype=np.uint64))
        a = np.sort(rng.permutation(b)[:160])
        root = np.array([t + 1], np.uint64)
        met += bool(np.intersect1d(jaccard.branches(root, a, 0.8)[1], jaccard.branches(root, b, 0.8)[1]).size)
    assert abs(met / 2000 - (1 - math.exp(-1))) < 0.04
    lives = 1 - math.exp(-(1 - math.exp(-1)))
    assert (1 - lives) ** jaccard.runs_needed(0.8, 2, 0.9999) <= 1e-4


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    for n in (3, 30, 300, 3000):
        near, far = [], []
        for _ in range(200):
            t = np.unique(rng.integers(0, 2 ** 64, 2 * n, dtype=np.uint64))
            common, k = t[:int(n * .9)], max(1, n // 10)
            near.append([jaccard.sketch(np.sort(np.concatenate([common, t[-k * (i + 1):len(t) - k * i]]))) for i in (0, 1)])
            far.append([jaccard.sketch(np.sort(t[:n])), jaccard.sketch(np.sort(t[n:]))])
        sides = lambda pairs, i: np.frombuffer(b"".join(p[i] for p in pairs), np.uint8).reshape(-1, jaccard.BINS)
        assert jaccard.alike(sides(near, 0), sides(near, 1), 0.8).all()
        if n >= 30:
            assert not jaccard.alike(sides(far, 0), sides(far, 1), 0.8).any()


def test_intersections():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(25)]
    got = jaccard.intersections(sets, chunk=7)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def test_intersections_in_token_ranges(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, 200)).astype(np.uint64) for _ in range(20)]
    seen, inner = [], jaccard._intersections
    monkeypatch.setattr(jaccard, "_intersections", lambda s, c: seen.append(sum(map(len, s))) or inner(s, c))
    assert (jaccard.intersections(sets, at_once=500) == inner(sets, 1 << 11)).all()
    assert max(seen) < 1000


def test_groups_are_cut_by_bytes():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"node": list(range(100)), "i": [0] * 100, "j": [0] * 100,
                                        "tokens": [bytes(8000)] * 100})
    got = [len(t) for t in jaccard._groups(iter([batch]), 512, 80_000)]
    assert sum(got) == 100 and max(got) <= 25


def test_long_near_copies_go_in_blocks_of_few_tokens(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[:k] + [f"n{i}"] + base[k:])) for i, k in enumerate(rng.choices(range(400), k=40))]
    assert _run(spark, rows, tokens=1500) == _brute(rows)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, x) for x in range(200, 260)] + \
        [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    want = {(x, root(x)) for e in edges for x in e if x not in loops}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 10, 64, 500])
def test_pieces_of_a_long_text_give_the_set_of_the_whole(limit):
    rng = random.Random(limit)
    for n in (0, 1, 4, 5, 6, 200):
        text = "".join(rng.choice(["\n", " ", "  "]) + rng.choice("aBé") * rng.choice([1, 2, 9, 120]) for _ in range(n))
        for t in (text, text + " \n", text.strip()):
            whole, = jaccard.shingle_sets([t])
            assert np.array_equal(jaccard.shingle_sets([t], limit=limit)[0], whole)
            assert [len(s) for s in jaccard.shingle_sets([t, "x y z", t], limit=limit)] == [len(whole), 1, len(whole)]


def test_a_batch_of_a_few_words(spark):
    assert [len(s) for s in jaccard.shingle_sets(["one two three"])] == [1]
    df = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    assert jaccard.first_of_classes(df).count() == 1


def test_branches_do_not_depend_on_the_slices(monkeypatch):
    nodes = np.arange(3, 18, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tokens = np.unique(np.random.default_rng(2).integers(0, 2 ** 63, 5000, dtype=np.uint64))
    whole = jaccard.branches(nodes, tokens, 0.8)
    monkeypatch.setattr(jaccard, "SLICE_TOKENS", 37)
    assert all(np.array_equal(x, y) for x, y in zip(jaccard.branches(nodes, tokens, 0.8), whole))
