"""The registered queries of the corpus operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import ann, audit, bpe, jaccard, langid, line_dedup, mixing, runs, sharding, simple8b, \
    suffix_dedup, topk, toxicity
from tillroll.llm.common import table

# The rank file and pattern of the registered queries; operators take any.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SHARDS = 40


def _documents(spark, sf):
    return table(spark, sf, "documents")


def _op2(spark, sf):
    return bpe.digests(_documents(spark, sf), RANKS, PATTERN)


def _op3(spark, sf):
    return sharding.assignments(_documents(spark, sf), SHARDS)


def _op12(spark, sf):
    return simple8b.token_files(_documents(spark, sf), WORDS, END_ID)


def _pipeline(spark, sf):
    import corpus_pipeline  # at the repository's top, which imports this package

    return corpus_pipeline.run(spark, sf)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_topk": topk.nearest_products,
        "op2_byte_bpe": _op2,
        "op3_sharding": _op3,
        "op4_jaccard_join": jaccard.linked,
        "op5_temperature_mixing": mixing.mixed,
        "op6_line_dedup": line_dedup.without_repeats,
        "op7_language_mixtures": langid.languages,
        "op8_permutation_index": ann.nearest_cosines,
        "op9_toxicity_lexicon": toxicity.toxicity,
        "op10_suffix_dedup": suffix_dedup.without_repeats,
        "op11_conversation_audit": lambda spark, sf: audit.repaired_conversations(table(spark, sf, "conversations")),
        "op12_token_files": _op12,
        "op13_periodic_runs": lambda spark, sf: runs.periodic_runs(_documents(spark, sf)),
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_topk": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
              FROM embeddings
              WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ),
            scored AS (
              SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                     CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
            )
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
              FROM scored) WHERE rank <= 10""",
        "op4_jaccard_join": jaccard.ORACLE,
        "op6_line_dedup": line_dedup.ORACLE,
        "op10_suffix_dedup": suffix_dedup.ORACLE,
        "op11_conversation_audit": audit.ORACLE,
        "op13_periodic_runs": runs.ORACLE,
    }
