"""The corpus pipeline: documents to tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which ``run``
writes as Parquet into the shared folder and reads again for the next one. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, jaccard, langid, line_dedup, mixing
from tillroll.llm.common import bounded_batches, internal, store, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# No source is repeated more often than this; none loses a document.
MAX_REPEATS = 1.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (no text, no letter); names the
    language of those whose ``lang`` is null."""
    columns = docs.columns
    pred, score = internal(docs, "__pred", "__score")
    told = langid.predict(docs, langid.fit(docs), lang_out=pred, score_out=score)
    return (told.where(F.col(pred) != langid.UNKNOWN)
            .withColumn("lang", F.coalesce("lang", pred)).select(*[F.col(f"`{c}`") for c in columns]))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated three-line windows; a document of which nothing but
    white space is left goes."""
    lines, removed = internal(docs, "__lines", "__removed")
    stripped = line_dedup.drop_lines(docs, lines_out=lines, removed_out=removed)
    changed = F.col(removed) > 0
    return (stripped.where(~changed | F.col("text").rlike(r"\S"))
            .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the one of smallest id."""
    return jaccard.first_of_classes(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources to their target weights."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of what they decode to."""
    tokens = bpe.decode(bpe.encode(docs.select("doc_id", "source", "lang", "text"), RANKS, PATTERN),
                        RANKS, PATTERN)
    return tokens.select("doc_id", "source", "lang", "n_tokens", "token_ids",
                         F.sha2("token_ids", 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def _bounded(stage):
    """The stage with its Python workers fed by bytes, whoever runs it."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _bounded(identify_language)),
    ("line_dedup", _bounded(dedup_lines)),
    ("jaccard_join", _bounded(drop_near_copies)),
    ("source_mixing", _bounded(mix_sources)),
    ("byte_bpe", _bounded(tokenize)),
]

# A fitted language model and a byte-pair encoder are not SQL; the pipeline is
# tested against brute-force stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
