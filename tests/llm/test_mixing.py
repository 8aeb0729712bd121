import math
from collections import Counter, defaultdict

import pytest
import xxhash

from tillroll.llm import mixing

SCHEMA = "doc_id long, source string, text string, n string, mix_epoch string"


def _docs(spark, sizes, words=5):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, source, " ".join(["w"] * words), None, "x"))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


def _epochs(out):
    by = defaultdict(Counter)
    for r in out.collect():
        by[r.source][r.doc_id] += 1
    return by


def _weights(sizes, exponent):
    t = {k: v ** exponent for k, v in sizes.items()}
    return {k: v / sum(t.values()) for k, v in t.items()}


SIZES = {"a": 300, "b": 60, None: 20, "d": 5}


def test_repeats_stay_under_the_limit_and_nothing_is_lost(spark):
    by = _epochs(mixing.mix(_docs(spark, SIZES), max_repeats=3.0, block_tokens=50))
    assert {k: len(v) for k, v in by.items()} == SIZES
    assert set(by["a"].values()) == {1}
    assert sum(by["d"].values()) == 15
    # exponent by hand: (300/5)^(1-a) = 3
    a = 1 - math.log(3) / math.log(60)
    for source, n in SIZES.items():
        assert abs(sum(by[source].values()) - n * (300 / n) ** (1 - a)) <= 1


def test_entropy_target_and_budget(spark):
    df = _docs(spark, SIZES)
    target = 1.0
    by = _epochs(mixing.mix(df, target_entropy=target, budget=2000, block_tokens=64))
    got = {k: sum(v.values()) * 5 for k, v in by.items()}
    lo, hi = 0.0, 16.0
    for _ in range(60):
        mid = (lo + hi) / 2
        h = -sum(w * math.log(w) for w in _weights(SIZES, mid).values())
        lo, hi = (mid, hi) if h > target else (lo, mid)
    for source, w in _weights(SIZES, hi).items():
        assert abs(got[source] - 2000 * w) <= 5
        counts = by[source].values()
        if got[source] >= SIZES[source] * 5:
            assert max(counts) - min(counts) <= 1


def test_places_interleave(spark):
    rows = mixing.mix(_docs(spark, {"a": 400, "b": 100}), max_repeats=2.0).collect()
    rows.sort(key=lambda r: r.mix_place)
    assert all(0 <= r.mix_place < 1 + 1e-9 for r in rows)
    half = Counter(r.source for r in rows[:len(rows) // 2])
    whole = Counter(r.source for r in rows)
    for s in whole:
        assert abs(half[s] / whole[s] - 0.5) < 0.12


def test_blocks_do_not_change_the_choice(spark):
    df = _docs(spark, SIZES)
    key = lambda d: sorted(map(str, d.collect()))
    assert key(mixing.mix(df, max_repeats=2.5, block_tokens=30)) == \
        key(mixing.mix(df.repartition(5), max_repeats=2.5, block_tokens=10 ** 6))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a", None, None, ""), (2, "a", "", None, ""), (3, "b", "x y", None, ""),
                                (3, "b", "x y", None, ""), (4, None, " ", None, "")], SCHEMA)
    out = mixing.mix(df, max_repeats=2.0)
    assert Counter(r.doc_id for r in out.collect()) == {1: 1, 2: 1, 3: 2, 4: 1}
    assert out.columns == ["doc_id", "source", "text", "n", "mix_epoch", "mix_place"]
    assert mixing.mix(df.limit(0), max_repeats=2.0).count() == 0
    assert mixing.mix(df.limit(0), target_entropy=1.0, budget=10).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, target_entropy=1.0, max_repeats=2.0)


def _hash(*parts):
    """The engine's xxhash64 of (value, bytes) numbers, strings and nulls, in plain Python."""
    h = 42
    for v in parts:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else (v[0] % (1 << 64 if v[1] == 8 else 1 << 32)).to_bytes(v[1], "little")
            h = xxhash.xxh64(raw, seed=h).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


def _brute(rows, max_repeats, block_tokens, seed):
    """(doc_id, source, epoch) of every chosen row: each source's rows in the order of an epoch, cut by the budget."""
    tokens = Counter()
    for _, source, text in rows:
        tokens[source] += len((text or "").split())
    counted = [t for t in tokens.values() if t]
    spread = math.log(max(counted) / min(counted))
    a = 1 - min(1.0, math.log(max_repeats) / spread) if spread else 1.0
    out = []
    for source, total in tokens.items():
        repeats = round((max(counted) / total) ** (1 - a), 9) if total else 1.0
        whole, rest = int(repeats), round((repeats - int(repeats)) * total)
        mine = [r for r in rows if r[1] == source]
        out += [(r[0], source, e) for e in range(whole) for r in mine]
        key = {r: _hash((seed, 4), (r[0], 8), r[1], r[2]) for r in mine}
        place = lambda r: (_hash((seed, 4), (key[r], 8), (whole, 4)) & ((1 << 53) - 1)) / float(1 << 53)
        # the cut lies in the block where the running sum reaches the rest
        blocks = max(1, -(-total // block_tokens))
        upto, end = 0, -1.0
        order = sorted(set(mine), key=place)
        sums = Counter()
        for r in mine:
            sums[r] += len((r[2] or "").split())
        before = 0
        for b in range(blocks):
            inside = [r for r in order if int(place(r) * blocks) == b]
            held = sum(sums[r] for r in inside)
            if rest > 0 and before < rest <= before + held:
                upto, end = before, place(inside[0]) - 2.0 ** -53
                for r in inside:
                    upto += sums[r]
                    if upto - len((r[2] or "").split()) / 2 <= rest:
                        end = place(r)
            before += held
        if rest > 0:
            out += [(r[0], source, whole) for r in mine if place(r) <= end]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_tokens, seed", [(20, 0), (100, 3), (10 ** 6, 5)])
def test_chosen_rows_against_brute_force(spark, block_tokens, seed):
    rows, i = [], 0
    for source, n in {"a": 150, "b": 40, None: 25, "d": 6}.items():
        for _ in range(n):
            rows.append((i, source, None if i % 17 == 0 else " ".join(["w"] * (i * 7 % 11))))
            i += 1
    rows += [(7, "b", "w w w")] * 30 + [(8, "e", "")] * 3 + [(9, "d", "w " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, max_repeats=2.5, block_tokens=block_tokens, seed=seed).collect()
    assert sorted(((r.doc_id, r.source, r.mix_epoch) for r in got), key=str) == _brute(rows, 2.5, block_tokens, seed)
