import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as cp
from tillroll.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _documents():
    rng = random.Random(8)
    word = {"en": ["the", "and", "with", "house", "river", "stone"], "de": ["und", "der", "schnell", "haus", "fluss"]}
    line = lambda k: " ".join(rng.choice(word[k]) + str(rng.randrange(50)) for _ in range(12))
    rows = []
    shared = [line("en") for _ in range(4)]
    for i in range(120):
        k = "en" if i % 3 else "de"
        lines = [line(k) for _ in range(rng.randrange(1, 6))]
        if i % 5 == 0:
            lines += shared
        rows.append([i, "\n".join(lines), k if i % 7 else None, "big" if i % 4 else f"s{i % 3}"])
    rows.append([200, rows[3][1], "en", "big"])                      # exact copy
    rows.append([201, rows[6][1].replace("\n", " ") + " one", "de", "big"])
    long = " ".join(line("en") for _ in range(8))
    rows += [[202, long, "en", "s0"], [203, long.replace("the", "tho", 1), "en", "s1"]]
    rows += [[204, None, "en", "s0"], [205, "", None, "s1"], [206, "123 !!! 456", "en", None]]
    return [(i, t, k, s, None if t is None else len(t)) for i, t, k, s in rows]


def _lines_brute(docs):
    seen, out = set(), {}
    for i, t in sorted(docs.items()):
        lines = t.split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            w = tuple(lines[at:at + 3])
            if w in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(w)
        kept = "\n".join(x for j, x in enumerate(lines) if j not in gone)
        if not gone or kept.strip():
            out[i] = kept
    return out


def _near_brute(docs):
    def shingles(t):
        w = t.lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))

    ids = sorted(docs)
    sets = {i: shingles(docs[i]) for i in ids}
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for x, a in enumerate(ids):
            for b in ids[x + 1:]:
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i for i in ids if label[i] == i}


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(_documents(), SCHEMA).write.parquet(str(folder / "documents.parquet"))
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    out = {"documents": docs}
    for name, stage in cp.STAGES:
        docs = cp.store(stage(spark, docs, str(folder)), name)
        out[name] = docs
    return out | {"folder": str(folder)}


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(results):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "source_mixing", "byte_bpe"]
    for name, _ in cp.STAGES[:-1]:
        assert results[name].columns == results["documents"].columns


def test_each_stage_against_brute_force(results):
    given = _texts(results["documents"])
    told = _texts(results["language_id"])
    assert told == {i: t for i, t in given.items() if i not in (204, 205, 206)}
    assert results["language_id"].where("lang is null").count() == 0
    stripped = _texts(results["line_dedup"])
    assert stripped == _lines_brute(told)
    assert results["line_dedup"].where("n_chars <> length(text)").count() == 0
    single = _texts(results["jaccard_join"])
    assert set(single) == _near_brute(stripped) and all(single[i] == stripped[i] for i in single)
    assert not {202, 203} <= set(single)


def test_mixing_repeats_small_sources(results):
    before = Counter(r.source for r in results["jaccard_join"].collect())
    rows = results["source_mixing"].collect()
    ids = Counter(r.doc_id for r in rows)
    assert set(ids) == {r.doc_id for r in results["jaccard_join"].collect()}
    after = Counter(r.source for r in rows)
    assert after["big"] == before["big"] and max(ids.values()) <= 2
    assert sum(after.values()) > sum(before.values())
    for s, n in after.items():
        assert n <= 1.5 * before[s] + 2


def test_tokens_and_run(spark, results):
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = _texts(results["source_mixing"])
    rows = results["byte_bpe"].collect()
    for r in rows:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert bytes(r.token_ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    whole = cp.run(spark, results["folder"])
    assert sorted(r.ids_sha256 for r in whole.collect()) == sorted(r.ids_sha256 for r in rows)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        docs = cp.store(stage(spark, docs, ""), "empty")
    assert docs.count() == 0
