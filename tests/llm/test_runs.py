import hashlib
import zlib

import numpy as np
import pytest

from tillroll.llm import runs


def brute_runs(w):
    """Every run by comparing all words at every distance."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                out.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def brute_planted(text, doc_id):
    w = text.split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_cover_and_shifts():
    assert {(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER} == set(range(runs.MODULUS))
    i, j = np.indices(runs._SHIFT.shape)
    assert runs._IN_COVER[(i + runs._SHIFT) % runs.MODULUS].all()
    assert runs._IN_COVER[(j + runs._SHIFT) % runs.MODULUS].all()


@pytest.mark.parametrize("letters,n", [(1, 300), (2, 400), (3, 50), (50, 500), (3_000_000, 200)])
def test_lce_against_comparing(letters, n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, letters, n)
    values[n // 2:n // 2 + n // 4] = values[:n // 4]
    values[-1] = letters
    a = runs.Agreement(values)
    i, j = (x.ravel() for x in np.triu_indices(n - 1, 1))
    at = a.lce(i, j)
    for k in rng.choice(len(i), min(3000, len(i)), replace=False):
        x, y, d = i[k], j[k], 0
        while y + d < n and values[x + d] == values[y + d]:
            d += 1
        assert at[k] == d


def test_runs_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        texts = []
        for _ in range(rng.integers(1, 6)):
            n = rng.integers(0, 120)
            w = [b"w%d" % x for x in rng.integers(0, rng.integers(1, 5), n)]
            if n and rng.random() < 0.5:
                w = (w[:rng.integers(1, 12)] * 40)[:n] + w[:rng.integers(0, 9)]
            texts.append(b" ".join(w))
        found, collapsed = runs._slab([memoryview(t) for t in texts])
        for t, f, c in zip(texts, found, collapsed):
            assert f == brute_runs(t.split())
            assert c == brute_collapsed(t.split(), f)


def test_grid_in_chunks_of_any_size(monkeypatch):
    text = memoryview(b"a b c " * 30 + b"x " * 50 + b"d e " * 9)
    want = runs._slab([text, text])
    for chunk in (1, 7, 100):
        monkeypatch.setattr(runs, "GRID_CHUNK", chunk)
        assert runs._slab([text, text]) == want


TEXTS = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "a b " * 12 + "c", "ß é " * 6, "x\x1cy x\x1cy " * 9,
         "same text here " * 5, "same text here " * 5, "no-break space " * 7, " \n".join("abcab" * 8)]


def test_query_against_brute_force(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], 1) for i in range(200)] + [(None, "a a a a a a a", 1)]
    got = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        data = (text or "").encode()
        w = data.split() if i is None else brute_planted(data, i)
        found = brute_runs(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = by_id[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, found)).hexdigest()


def test_plant_is_the_rule():
    rng = np.random.default_rng(5)
    for i in range(400):
        text = " ".join(rng.choice(["a", "bb", "c\t", "\nd"], rng.integers(0, 40))).encode()
        assert runs.plant(text, i).split() == brute_planted(text, i)


def test_long_text_other_columns_and_empty_table(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    long = words + " tail end" * 100_000 + " " + words  # 4 MB, more than a slab
    df = spark.createDataFrame([(1, long, "x")], "id long, body string, __both string")
    r = runs.collapse_runs(df, "body").first()
    assert [tuple(x) for x in r.runs] == [(200_000, 200_000, 2)]
    assert r.collapsed == words + " tail end " + words and r["__both"] == "x"
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
