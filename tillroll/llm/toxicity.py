"""Toxicity by a weighted lexicon and an Aho-Corasick automaton.

Texts are folded first: lower case, homoglyphs and accented letters to plain
Latin ones, digits and signs that stand for letters inside words to those
letters, everything else to single blanks. The lexicon holds whole words and
word beginnings, learned from labelled documents. A term's weight is the
logarithm of how much likelier a toxic document holds it than another. The
automaton finds all terms of a text in one pass; a word counts once, with its
heaviest term, and not at all inside an exception phrase (a pair of words
around a term that labelled documents use without being toxic). The sum of the
weights, as such and over the text's length, becomes a probability by a fitted
logistic curve.

Learning goes in rounds: terms that many toxic documents hold come first, then
only documents without any strong term so far are asked for more, for rarer
ones each time, down to LEAST documents. So a rare word that merely shares a
document, or a group of near copies, with a real term is not taken, and no
significant term is left out for being rare. It reads at most ``max_rows``
different labelled texts of each class (a documented bound; a seeded hash picks
them), equal texts of a class once; the lexicon is as large as what is
significant in them. Scores read every whole text.

Rows: null and empty texts score like a text without terms. A very long text is
folded and matched as a whole, at some ten bytes of memory a character. Labels
that are null teach nothing; a document labelled more than once counts as toxic
if any label says so. With no toxic label nothing is learned and every score is
0. Rows are scored one by one; no rows give no rows. Columns pass through; the
output columns replace input columns of their names.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import returns_memory, store, table
from tillroll.llm.langid import fold as fold_of

MAX_ROWS = 50_000
PREFIXES = range(4, 10)  # lengths of word beginnings
LEAST = 6                # toxic documents that a term needs
FIRST_SHARE = 0.02       # share of the toxic documents that a term of the first round needs,
RARER = 4                # and so many times less in each further round
FLUSH_TERMS = 200_000    # terms a worker holds before it hands on their counts
LIFT = 4.0               # a term is so many times likelier in toxic documents
STRONG = 3.0             # weight from which a term explains a toxic document
THRESHOLD = 0.3

# Letters of other scripts that look like Latin ones, and the
# digits and signs that stand for letters.
HOMOGLYPHS = dict(zip("аеорсухікмнтвјѕԁɡⅼαερονυικτβη", "aeopcyxikmhtbjsdglaepovuiktbn"))
DIGITS = str.maketrans("0134578@$", "oieastbas")
_DIGIT_RUN = re.compile(r"(?<=[a-z])[0134578@$]+|[0134578@$]+(?=[a-z])|(?<=[a-z])[!|](?=[a-z])")
_GAP = re.compile(r"[^a-z0-9]+")


class _Plain(dict):
    """Character -> its plain letters, worked out when first asked for (one entry per character)."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = []
        for d in unicodedata.normalize("NFKD", "ss" if c == "ß" else HOMOGLYPHS.get(c, c)):
            if unicodedata.combining(d) or unicodedata.category(d) == "Cf":
                continue
            out.append(d if d < "\x80" else HOMOGLYPHS.get(d) or ("q" if d.isalpha() else " "))
        self[code] = "".join(out)
        return self[code]


_PLAIN = _Plain({c: chr(c) for c in range(128)})


def fold_text(text: str) -> str:
    """The folded text: words of a-z and 0-9 between single blanks, blanks at both ends."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_PLAIN).lower()
    text = _DIGIT_RUN.sub(lambda m: "i" if m[0] in "!|" else m[0].translate(DIGITS), text)
    return " " + _GAP.sub(" ", text).strip() + " "


def terms_of(words: set[str]) -> set[str]:
    """Whole words (" word ") and word beginnings (" wor") of a set of words."""
    out = {f" {w} " for w in words}
    for w in words:
        out.update(" " + w[:n] for n in PREFIXES if n < len(w))
    return out


class Lexicon:
    """Weighted terms, exception phrases and the logistic curve."""

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset(),
                 curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = weights, set(exceptions), curve
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for t, w in self.weights.items():
                a.add_word(t, (len(t), w, False))
            for t in self.exceptions:
                a.add_word(t, (len(t), 0.0, True))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> dict[int, float]:
        """Start of each matched word -> weight of its heaviest term, without exceptions."""
        if not self.weights:
            return {}
        hits: dict[int, float] = {}
        excused = []
        for end, (size, weight, exception) in self.automaton().iter(folded):
            start = end - size + 1
            if exception:
                excused.append((start, end))
            elif weight > hits.get(start, 0.0):
                hits[start] = weight
        for a, b in excused:
            for start in [s for s in hits if a <= s < b]:
                del hits[start]
        return hits

    def measure(self, text: str | None) -> tuple[float, int]:
        """Sum of the weights, and number of words."""
        folded = fold_text(text or "")
        return sum(self.matches(folded).values()), max(0, folded.count(" ") - 1)

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        total, words = self.measure(text)
        z = float(design(np.array([total]), np.array([words]))[0] @ np.array(self.curve))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def design(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the logistic curve sees: the sum, the sum over the length, the length."""
    return np.stack([np.ones(len(total)), np.log1p(total), 50 * total / (words + 50.0),
                     np.log1p(words) * (total > 0) / 10], axis=1)


def _term_counts(rows: DataFrame, without: dict[str, float]) -> DataFrame:
    """(term, n): documents per term, of documents that hold none of ``without``;
    the empty term has the number of documents."""
    covered = Lexicon(dict.fromkeys(without, 1.0))

    def batch_of(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string()),
                                           "n": pa.array(found.values(), pa.int64())})

    @returns_memory
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for v in b.column("text"):
                folded = fold_text(v.as_py())
                if covered.matches(folded):
                    continue
                found[""] += 1
                found.update(terms_of(set(folded.split())))
                if len(found) > FLUSH_TERMS:
                    yield batch_of(found)
                    found.clear()
        yield batch_of(found)

    return (rows.select("text").mapInArrow(count, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def _documents_of(counts: DataFrame) -> int:
    return int(counts.where(F.col("term") == "").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def _weight(a: int, n_a: int, b: int, n_b: int) -> float:
    return math.log(((a + 0.5) / (n_a + 1)) / ((b + 0.5) / (n_b + 1)))


def _significant(toxic: DataFrame, n_a: int, other: DataFrame, n_b: int, least: int) -> dict[str, tuple]:
    """Term -> (toxic documents, weight) of terms with at least ``least`` toxic documents that
    are LIFT times likelier in them, which chance does not explain. Counts are compared where they lie."""
    a, b = F.col("n"), F.coalesce(F.col("other_n"), F.lit(0))
    rate = (a + b) / F.lit(float(n_a + n_b))
    surprise = 2 * (a * F.log(a / (F.lit(float(n_a)) * rate))
                    + F.when(b > 0, b * F.log(b / (F.lit(float(n_b)) * rate))).otherwise(0.0))
    lifted = (a + 0.5) * (n_b + 1) > LIFT * (b + 0.5) * (n_a + 1)
    rows = (toxic.where((a >= least) & (F.col("term") != ""))
            .join(other.withColumnRenamed("n", "other_n"), "term", "left")
            .where(lifted & (surprise > 30)).select("term", "n", b.alias("b")).collect())
    return {r["term"]: (r["n"], _weight(r["n"], n_a, r["b"], n_b)) for r in rows}


def _choose(significant: dict[str, tuple]) -> dict[str, float]:
    """Of a beginning and its continuations the lighter ones only where they are
    not explained by the other."""
    toxic = {t: n for t, (n, _) in significant.items()}
    good = {t: w for t, (_, w) in significant.items()}
    words = sorted(t for t in good if t.endswith(" "))
    chosen: dict[str, float] = {}
    for t in sorted(good, key=lambda t: (len(t), t)):
        heaviest = max((chosen[t[:n]] for n in range(5, len(t)) if t[:n] in chosen), default=0.0)
        if good[t] > heaviest + (0.4 if heaviest else 0.0):
            chosen[t] = good[t]
    for t in [t for t in chosen if not t.endswith(" ")]:
        # a beginning that stands for a single word is that word
        continued = words[bisect.bisect_left(words, t):bisect.bisect_left(words, t + "\x7f")]
        whole = max(continued, key=lambda w: toxic[w], default=None)
        if whole and toxic[whole] >= 0.9 * toxic[t]:
            del chosen[t]
            chosen[whole] = good[whole]
    return chosen


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    """Pairs of words around a term that harmless documents use and toxic ones hardly."""
    @returns_memory
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                folded = fold_text(t)
                pairs = set()
                for start in lexicon.matches(folded):
                    end = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start) if start else -1
                    after = folded.find(" ", end + 1)
                    if before >= 0:
                        pairs.add(folded[before:end + 1])
                    if after >= 0:
                        pairs.add(folded[start:after + 1])
                found.update((p, toxic) for p in pairs)
        yield pa.RecordBatch.from_pydict({"pair": pa.array([k[0] for k in found], pa.string()),
                                          "toxic": pa.array([k[1] for k in found], pa.int32()),
                                          "n": pa.array(found.values(), pa.int64())})

    counts = (rows.mapInArrow(count, "pair string, toxic int, n long").groupBy("pair")
              .agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("fine"),
                   F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"))
              .where((F.col("fine") >= LEAST) & (F.col("fine") > 4 * F.col("bad"))))
    return {r["pair"] for r in counts.select("pair").collect()}


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by damped Newton steps with a weak prior."""
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def draw_labels(rows: DataFrame, key: Column, toxic: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows of each class at most, picked by a hash; ``rows``
    has one row per key and class."""
    sizes = {r[0]: r[1] for r in rows.where(F.col(toxic).isin(0, 1)).groupBy(toxic)
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    return rows.where(_drawn(key, toxic, max_rows, sizes))


def _drawn(key: Column, toxic: str, max_rows: int, sizes: dict) -> Column:
    draw = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.when(F.col(toxic) == 1, draw < max_rows / max(1, sizes.get(1, 0)))
            .when(F.col(toxic) == 0, draw < max_rows / max(1, sizes.get(0, 0))).otherwise(False))


def draw_texts(rows: DataFrame, max_rows: int, seed: int = 0) -> DataFrame:
    """(text, toxic): about ``max_rows`` different texts of each class at most. Copies
    of a drawn text shrink to one row in the task that reads them."""
    key = F.xxhash64(F.lit(seed), "text")
    sizes = {r["toxic"]: r["n"] for r in rows.select("toxic", key.alias("key")).distinct()
             .groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    return (rows.where(_drawn(key, "toxic", max_rows, sizes))
            .groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("key"), "toxic")
            .agg(F.first("text").alias("text")).select("text", "toxic"))


def fit(labelled: DataFrame, text: str = "text", toxic: str = "toxic", max_rows: int = MAX_ROWS,
        seed: int = 0) -> Lexicon:
    """Learn from rows with a text and a label (1 toxic, 0 not)."""
    rows = (labelled.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
                            F.col(f"`{toxic}`").cast("int").alias("toxic"))
            .where(F.col("toxic").isin(0, 1)))
    sample = store(draw_texts(rows, max_rows, seed), "toxicity-sample")
    if sample.select("toxic").distinct().count() < 2:
        return Lexicon({})
    bad, fine = sample.where(F.col("toxic") == 1), sample.where(F.col("toxic") == 0)
    other = store(_term_counts(fine, {}), "toxicity-terms")
    n_other = _documents_of(other)
    weights: dict[str, float] = {}
    least = None
    while True:
        strong = {t: w for t, w in weights.items() if w >= STRONG}
        toxic_terms = store(_term_counts(bad, strong), "toxicity-terms")
        n_bad = _documents_of(toxic_terms)
        if n_bad < LEAST:
            break
        least = max(LEAST, int(FIRST_SHARE * n_bad) if least is None else least // RARER)
        new = {t: w for t, w in _choose(_significant(toxic_terms, n_bad, other, n_other, least)).items()
               if t not in weights}
        weights.update(new)
        if least == LEAST and not any(w >= STRONG for w in new.values()):
            break  # no document is explained by a new term: the next round would be this one
    lexicon = Lexicon(weights)
    if not weights:
        return lexicon
    lexicon.exceptions = _exceptions(sample, lexicon)

    @F.arrow_udf("struct<total:double,words:long>")
    @returns_memory
    def measures(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            got = [lexicon.measure(v.as_py()) for v in batch]
            yield pa.StructArray.from_arrays(
                [pa.array((g[0] for g in got), pa.float64()), pa.array((g[1] for g in got), pa.int64())],
                ["total", "words"])

    # three numbers for each of about 2 * max_rows documents at most
    seen = sample.select(measures("text").alias("m"), "toxic").select("m.total", "m.words", "toxic").collect()
    x = design(np.array([r["total"] for r in seen]), np.array([r["words"] for r in seen]))
    lexicon.curve = _curve(x, np.array([r["toxic"] for r in seen], np.float64))
    return lexicon


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of being toxic to every row."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)  # of a bounded sample

    @F.arrow_udf("double")
    @returns_memory
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lex = shared.value
        for batch in batches:
            yield pa.array((lex.score(v.as_py()) for v in batch), pa.float64())

    return df.withColumn(out, scores(F.col(f"`{text}`").cast("string")))


def toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; three of four folds teach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    labels = (table(spark, sf_dir, "labels").where(fold_of(F.col("doc_id"), 4) != 2)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # two classes of MAX_ROWS rows or so: small enough to be sent to every task
    drawn = F.broadcast(draw_labels(labels, F.xxhash64("doc_id"), "toxic", MAX_ROWS))
    lexicon = fit(docs.where(~held_out).join(drawn, "doc_id"))
    return score(docs.withColumn("held_out", held_out), lexicon).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
