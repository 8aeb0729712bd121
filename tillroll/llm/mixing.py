"""Mixing sources by temperature.

Each source's share of all tokens is raised to an exponent and normalised to a
weight: exponent 1 keeps the shares, 0 makes all sources equal. The exponent
is found by bisection, either for a target entropy of the weights or for the
least exponent at which no source is repeated more often than a limit. A
budget of tokens then gives each source ``weight * budget`` tokens.

The weights are realised by block permutations. In each epoch a source's rows
are put in an order of their own by a seeded hash, cut into blocks of about
``block_tokens``. A source takes whole epochs while its budget lasts, then
whole blocks of one more epoch, then rows of one last block. Only totals per
source and per block are shuffled, and the rows of one block per source are
put in order; the rows themselves stay where they are, so a source with a
third of all rows is no hot key.

Rows: a null source is a source. A null text has no tokens; rows without
tokens are taken in every whole epoch and where their place in the order falls
into the budget. Equal rows have one place in the order and are taken
together, each counting; they are counted before the block is put in order. A
very long text is a row like any other; a block that it starts in ends with it. A source without any tokens gets one epoch. No rows
give no rows. Columns pass through; ``mix_epoch`` and ``mix_place`` replace
input columns of those names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import internal, lookup_split, store, table

BLOCK_TOKENS = 1 << 20
LEVELS = 6       # bisection levels evaluated in one job
ROUNDS = 8


def word_tokens(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _bisect(totals: DataFrame, measure: Column, target: float, low: float, high: float,
            rounds: int = ROUNDS) -> float:
    """The exponent in [low, high] where ``measure`` falls to ``target``.

    ``measure`` is an aggregate over the sources with the exponent in column
    ``a``. A job evaluates all midpoints of LEVELS levels of the bisection.
    """
    for _ in range(rounds):
        n = 2 ** LEVELS
        points = [low + (high - low) * i / n for i in range(1, n)]
        rows = (totals.withColumn("a", F.explode(F.lit(points)))
                .groupBy("a").agg(measure.alias("m")).collect())
        at = {r.a: r.m for r in rows}
        lo, hi = 0, n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            m = at.get(points[mid - 1])
            if m is not None and m > target:
                lo = mid
            else:
                hi = mid
        low, high = low + (high - low) * lo / n, low + (high - low) * hi / n
    return high


def entropy() -> Column:
    """Entropy in nats of the normalised weights ``exp(a * log_share)``."""
    e = F.col("a") * F.col("log_share")
    z = F.sum(F.exp(e))
    return F.ln(z) - F.sum(F.exp(e) * e) / z


def find_exponent(totals: DataFrame, target_entropy: float | None = None,
                  max_repeats: float | None = None) -> float:
    """Exponent for ``totals`` (log_share: log of a source's token share).

    With ``target_entropy`` the weights have that entropy, as far as exponents
    from 0 to 16 reach. With ``max_repeats`` it is the least exponent at which
    the smallest source is repeated at most so often, counted against the
    largest source taken once. With neither it is 1.
    """
    if target_entropy is not None and max_repeats is not None:
        raise ValueError("give target_entropy or max_repeats, not both")
    if target_entropy is not None:
        return _bisect(totals, entropy(), target_entropy, 0.0, 16.0)
    if max_repeats is not None:
        if max_repeats < 1:
            raise ValueError("max_repeats must be at least 1")
        # the smallest source's repeats against the largest's, as a logarithm
        spread = F.max((1 - F.col("a")) * F.col("log_share")) - F.min((1 - F.col("a")) * F.col("log_share"))
        return _bisect(totals, F.abs(spread), math.log(max_repeats), 0.0, 1.0)
    return 1.0


def mix(df: DataFrame, source: str = "source", text: str = "text", tokens: Column | None = None,
        target_entropy: float | None = None, max_repeats: float | None = None,
        budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """The rows of ``df``, each as often as its source's budget takes it, with
    ``mix_epoch`` (int, from 0) and ``mix_place`` (double in [0, 1): sorting by
    it interleaves the sources in the target proportions).

    ``budget`` is in tokens; without it the budget is the least at which no
    source gets less than one whole epoch. ``tokens`` is a row's size, words
    by default.
    """
    df = df.drop("mix_epoch", "mix_place")
    size, key, group, count, reps, epochs, rest, blocks, epoch, end, count2 = internal(
        df, "__size", "__key", "__group", "__count", "__reps", "__epochs", "__rest", "__blocks",
        "__epoch", "__end", "__count_2")
    cols = [F.col(f"`{c}`") for c in df.columns]
    src = F.col(f"`{source}`").cast("string")
    rows = df.withColumn(size, tokens if tokens is not None else word_tokens(F.col(f"`{text}`"))) \
             .withColumn(key, F.xxhash64(F.lit(seed), *cols)) \
             .withColumn(group, F.coalesce(F.concat(F.lit("="), src), F.lit("null")))
    totals = store(rows.groupBy(group).agg(F.sum(size).alias("tokens"), F.count(F.lit(1)).alias("n"))
                   .withColumn("log_share", F.when(F.col("tokens") > 0, F.ln(
                       F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0)))))), "mix-sources")
    n_rows, whole = (int(x) for x in totals.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "tokens")]).first())
    exponent = find_exponent(totals, target_entropy, max_repeats)
    z, least = totals.agg(F.sum(F.exp(F.lit(exponent) * F.col("log_share"))),
                          F.max(F.exp(F.lit(1 - exponent) * F.col("log_share")))).first()
    # repeats = weight * budget / tokens = share^(exponent-1) / z * budget / whole
    scale = (budget / whole / z if budget is not None else least) if whole else 1.0
    repeats = F.round(F.coalesce(F.exp(F.lit(exponent - 1) * F.col("log_share")) * F.lit(float(scale)),
                                 F.lit(1.0)), 9)
    plan = totals.select(
        group, F.col("n").alias(count), repeats.alias(reps), F.floor(repeats).cast("int").alias(epochs),
        F.round((repeats - F.floor(repeats)) * F.col("tokens")).cast("long").alias(rest),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("long").alias(blocks))
    planned = lookup_split(rows, plan, [group], count, n_rows, F.col(key))

    def place(epoch: Column) -> Column:
        """A row's place in the order of an epoch, uniform in [0, 1)."""
        bits = F.xxhash64(F.lit(seed), F.col(key), epoch).bitwiseAND(F.lit((1 << 53) - 1))
        return bits / F.lit(float(1 << 53))

    # The epoch that the budget takes in part: the block where it ends, and
    # the place in that block.
    last = planned.where(F.col(rest) > 0).select(
        F.col(group).alias("source"), F.col(size).alias("size"), F.col(rest).alias("rest"),
        place(F.col(epochs)).alias("u"), F.col(blocks).alias("blocks")) \
        .withColumn("block", F.floor(F.col("u") * F.col("blocks")))
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (last.groupBy("source", "block").agg(F.sum("size").alias("total"), F.max("rest").alias("rest"))
            .withColumn("before", F.coalesce(F.sum("total").over(run), F.lit(0)))
            .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("total") >= F.col("rest")))
            .select("source", "block", "before"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("u"))
    # a row is taken if at least half of it fits
    # copies of a row, at one place, shrink to one row with all their tokens before they meet
    block = (last.join(cuts, ["source", "block"]).groupBy("source", "block", "u")
             .agg(F.sum("size").alias("size"), F.max("size").alias("one"), F.max("rest").alias("rest"),
                  F.max("before").alias("before")))
    ends = (block.withColumn("upto", upto)
            .groupBy("source").agg(
                F.max(F.when(F.col("upto") - F.col("one") / 2 <= F.col("rest"), F.col("u"))).alias("last"),
                F.min("u").alias("first")))
    ends = store(totals.select(group, "n").join(ends, F.col(group) == F.col("source"), "left").select(
        group, F.col("n").alias(count2),
        # no row of the block fits: end just before its first
        F.coalesce("last", F.col("first") - F.lit(2.0 ** -53), F.lit(-1.0)).alias(end)), "mix-ends")
    chosen = lookup_split(planned, ends, [group], count2, n_rows, F.col(key))
    taken = F.filter(F.sequence(F.lit(0), F.col(epochs)),
                     lambda e: (e < F.col(epochs)) | (place(e) <= F.col(end)))
    return (chosen.withColumn(epoch, F.explode(taken))
            .select(*cols, F.col(epoch).cast("int").alias("mix_epoch"),
                    ((F.col(epoch) + place(F.col(epoch))) / F.col(reps)).alias("mix_place")))


def mixed(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed so that no source is repeated more than four times."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, max_repeats=4.0).select("doc_id", "source", "mix_epoch", "mix_place")
