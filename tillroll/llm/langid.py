"""Language identification by mixture inference.

A language is a distribution over hashed byte trigrams of lower-cased text,
letters and word gaps only. A document is taken as a mixture of languages: its
trigrams come from ``sum_l share_l * P(trigram | l)``. Expectation-maximisation
estimates the shares. The set of languages starts with the single best one; the
language whose share would grow fastest joins it while the likelihood gains
more than the penalty of one more parameter (half the logarithm of the number
of trigrams, as in BIC). The prediction is the language of the largest share,
its score that share.

The model is fitted on at most ``per_language`` documents of each language (a
documented bound; a seeded hash of id and text picks them), and is one
matrix of MODEL_FEATURES numbers per language. Predictions read the whole
text of every document.

Rows: null texts and texts without a letter are ``und`` with score 0, and so
is every text if nothing was learned. A null or empty language teaches
nothing. Ties go to the language first in alphabetical order. Rows are
predicted one by one, so copies and skew have no effect. No rows give no rows.
Columns pass through; the output columns replace input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import returns_memory, sized_slices, table

FEATURE_BITS = 16
MODEL_FEATURES = 1 << FEATURE_BITS
PER_LANGUAGE = 30_000
MAX_LANGUAGES = 1000   # more distinct values than this are no language codes
SLICE_BYTES = 1 << 18
STEPS = 10
UNKNOWN = "und"

# Byte -> byte: ASCII letters and all of UTF-8's other bytes stay, the rest is a gap.
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of the distinct trigrams, documents ascending."""
    parts = [b" " + t.lower().encode("utf-8", "replace").translate(_TABLE) + b" " for t in texts]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    if len(buf) < 3:
        return (np.empty(0, np.int64),) * 3
    code = buf[:-2].astype(np.uint32) << np.uint32(16)
    code |= buf[1:-1].astype(np.uint32) << np.uint32(8)
    code |= buf[2:]
    doc = np.repeat(np.arange(len(parts), dtype=np.uint64), lengths)[:-2]
    inside = doc == np.repeat(np.arange(len(parts), dtype=np.uint64), lengths)[2:]
    inside &= ~((buf[:-2] == 32) & (buf[1:-1] == 32)) & ~((buf[1:-1] == 32) & (buf[2:] == 32))
    feature = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
    pairs, counts = np.unique((doc[inside] << np.uint64(FEATURE_BITS)) | feature[inside], return_counts=True)
    return ((pairs >> np.uint64(FEATURE_BITS)).astype(np.int64),
            (pairs & np.uint64(MODEL_FEATURES - 1)).astype(np.int64), counts)


class Model:
    """Languages in alphabetical order and P(feature | language), feature by row."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts.astype(np.float64) + 0.5
        self.p = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        self.log_p = np.log(self.p)

    def shares(self, texts: list[str]) -> np.ndarray:
        """Estimated language shares, one row per text (zero without trigrams)."""
        out = np.zeros((len(texts), len(self.languages)))
        doc, feature, count = trigrams(texts)
        present, starts = np.unique(doc, return_index=True)
        if not len(present):
            return out
        c = count.astype(np.float32)
        n = np.add.reduceat(c, starts, dtype=np.float64)
        single = np.add.reduceat(self.log_p[feature] * c[:, None], starts, axis=0, dtype=np.float64)
        best = single.argmax(axis=1)
        weights = np.zeros_like(single)
        weights[np.arange(len(present)), best] = 1.0
        score = single.max(axis=1)
        going = np.arange(len(present))
        while len(going) and len(self.languages) > 1:
            going, weights, score = self._grow(going, weights, score, starts, feature, c, n)
        out[present] = weights
        return out

    def _grow(self, going, weights, score, starts, feature, c, n):
        """Try one more language for the documents ``going``; return those that gained."""
        ends = np.append(starts[1:], len(feature))
        sizes = (ends - starts)[going]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        if len(going) == len(starts):
            p, cc = self.p[feature], c
        else:
            at = np.repeat(starts[going] - first, sizes) + np.arange(sizes.sum())
            p, cc = self.p[feature[at]], c[at]
        row = np.repeat(np.arange(len(going)), sizes)
        w = weights[going]

        def per_doc(x):
            return np.add.reduceat(x, first, axis=0, dtype=np.float64)

        mixed = (w.astype(np.float32)[row] * p).sum(axis=1)
        gain = per_doc(p * (cc / mixed)[:, None]) / n[going, None]
        gain[w > 0] = -np.inf
        new = gain.argmax(axis=1)
        w = w * 0.8
        w[np.arange(len(going)), new] = 0.2
        for _ in range(STEPS):
            w32 = w.astype(np.float32)
            mixed = (w32[row] * p).sum(axis=1)
            w = w * per_doc(p * (cc / mixed)[:, None]) / n[going, None]
        mixed = (w.astype(np.float32)[row] * p).sum(axis=1)
        better = per_doc(np.log(mixed) * cc)
        won = (gain.max(axis=1) > 1) & (better - score[going] > 0.5 * np.log(np.maximum(n[going], 2)))
        weights, score = weights.copy(), score.copy()
        weights[going[won]] = w[won] / w[won].sum(axis=1, keepdims=True)
        score[going[won]] = better[won]
        more = won & ((w > 0).sum(axis=1) < len(self.languages))
        return going[more], weights, score


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        per_language: int = PER_LANGUAGE, seed: int = 0) -> Model:
    """Learn from the rows of ``labelled`` (id, text and language are read)."""
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"),
                           F.col(f"`{text}`").cast("string").alias("text"),
                           F.col(f"`{doc_id}`").alias("doc_id")).where(
        F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, MODEL_FEATURES)))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text")

    @returns_memory
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
            for i, j in sized_slices([len(t) for t in texts], SLICE_BYTES):
                doc, feature, n = trigrams(texts[i:j])
                codes = np.array(langs[i:j])
                for k in set(langs[i:j]):
                    mine = codes[doc] == k if len(doc) else np.empty(0, bool)
                    totals[k] = totals.get(k, 0) + np.bincount(feature[mine], n[mine], MODEL_FEATURES)
        for k, v in totals.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([k] * len(at), pa.string()),
                                              "f": pa.array(at.astype(np.int32)),
                                              "n": pa.array(v[at].astype(np.int64))})

    counts = np.zeros((len(languages), MODEL_FEATURES))
    number = {k: i for i, k in enumerate(languages)}
    for r in (sample.mapInArrow(count, "lang string, f int, n long")
              .groupBy("lang", "f").agg(F.sum("n").alias("n")).toLocalIterator()):
        counts[number[r["lang"]], r["f"]] = r["n"]
    return Model(languages, counts)


def predict(df: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """Add the language of the largest share and that share to every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # one bounded matrix per language

    @F.arrow_udf("struct<lang:string,score:double>")
    @returns_memory
    def infer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            values = batch.to_pylist()
            lang, score = [UNKNOWN] * len(values), [0.0] * len(values)
            for i, j in sized_slices([len(v or "") for v in values], SLICE_BYTES):
                at = [k for k in range(i, j) if values[k] and has_letter(values[k])] if m.languages else []
                if at:
                    shares = m.shares([values[k] for k in at])
                    for k, row in zip(at, shares):
                        top = int(row.argmax())
                        lang[k], score[k] = m.languages[top], min(1.0, float(row[top]))
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["lang", "score"])

    # not to be run again for a filter on what it predicts
    result = infer.asNondeterministic()(F.col(f"`{text}`").cast("string"))
    name = "__language"
    while name in df.columns:
        name += "_"
    return (df.withColumn(name, result).withColumn(lang_out, F.col(f"{name}.lang"))
            .withColumn(score_out, F.col(f"{name}.score")).drop(name))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def languages(spark, sf_dir: str) -> DataFrame:
    """Every document's predicted language; two of three folds teach."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")
