"""Mixing sources to target weights, in DataFrame functions only.

**Weights.** The share of each source in all tokens is raised to an exponent between 0 (all sources equal) and 1 (as they
are) and normalised. Bisection finds the least exponent that keeps the entropy of the weights at or under a target, or the
number of times that the most repeated source is passed at or under a limit, or both.

**Realisation.** The budget gives every source at least ``MIN_EPOCHS`` passes. A source's tokens in it are whole passes over
its documents, each in a permutation of its own, and a last one that ends when the budget is used up. The mixture is a
sequence of blocks of ``BLOCK_TOKENS`` tokens; each holds every source in its weight, in a permuted order.

Permutations are orders of MD5 hashes. A source of any size is dealt into 4096 buckets by the first digits of the hash:
bucket totals are summed up within a source, and documents are ranked within one bucket only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.llm.shared import stored, words_of

REPETITION_LIMIT = 1.5
MIN_EPOCHS = 1
BLOCK_TOKENS = 65_536
HALVINGS = 20
SEED = 17


@dataclass(frozen=True)
class Mixture:
    """The exponent, the budget in tokens, and per source ``weight, budget, tokens, epochs, rest, last_key``."""

    exponent: float
    budget: int
    sources: DataFrame


def _key(epoch: Column, doc_id: Column, content: Column) -> Column:
    """Place in the permutation of a pass. The text is part of it, so rows with one doc_id, or with none, are apart."""
    name = F.coalesce(doc_id.cast("string"), F.lit("none"))
    return F.md5(F.concat_ws(":", F.lit(SEED), epoch.cast("string"), name, content))


def _content(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, tokens, content``: words of the text, one at least, so that every row takes room, and its MD5."""
    tokens = F.greatest(F.size(words_of(F.col("text"))), F.lit(1)).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"), tokens.alias("tokens"),
        _content(F.col("text")).alias("content"),
    )


def _state(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, least, greatest) for each exponent; the last two are of weight per share, in units of their sum."""
    columns = []
    for k, x in enumerate(exponents):
        power = F.pow("share", F.lit(x))
        columns += [
            F.sum(power).alias(f"z{k}"), F.sum(power * F.log("share")).alias(f"l{k}"),
            F.min(power / F.col("share")).alias(f"a{k}"), F.max(power / F.col("share")).alias(f"b{k}"),
        ]
    row = sources.agg(*columns).first()
    return [
        (math.log(row[f"z{k}"]) - x * row[f"l{k}"] / row[f"z{k}"], row[f"a{k}"] / row[f"z{k}"], row[f"b{k}"] / row[f"z{k}"])
        for k, x in enumerate(exponents)
    ]


def exponent_for(sources: DataFrame, target_entropy: float | None, repetition_limit: float | None) -> float:
    """The least exponent, to ``2**-HALVINGS``, that meets the targets; 1 if none below does.

    Both grow easier to meet with the exponent. A job tries the fifteen exponents that four halvings can ask for.
    """

    def meets(state: tuple[float, float, float]) -> bool:
        entropy, least, greatest = state
        even = target_entropy is None or entropy <= target_entropy
        return even and (repetition_limit is None or greatest <= repetition_limit / MIN_EPOCHS * least)

    if meets(_state(sources, [0.0])[0]):
        return 0.0
    low, high, left = 0.0, 1.0, HALVINGS
    while left:
        step = min(4, left)
        grid = [low + (high - low) * k / 2**step for k in range(1, 2**step)]
        passed = [meets(s) for s in _state(sources, grid)]
        at = passed.index(True) if any(passed) else len(grid)
        low, high = ([low, *grid][at], [*grid, high][at])
        left -= step
    return high


def plan(rows: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = REPETITION_LIMIT) -> Mixture:
    """The mixture of measured rows."""
    by_source = stored(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    total = by_source.agg(F.sum("tokens")).first()[0] or 1
    sources = by_source.withColumn("share", F.col("tokens") / F.lit(float(total)))
    empty = not by_source.take(1)
    exponent = 1.0 if empty else exponent_for(sources, target_entropy, repetition_limit)
    per_share = F.pow("share", F.lit(exponent)) / F.col("share")
    least = 1.0 if empty else sources.agg(F.min(per_share)).first()[0]
    budget = F.round(MIN_EPOCHS * per_share / F.lit(least) * F.col("tokens")).cast("long")
    shared = sources.withColumn("budget", budget)
    whole = shared.agg(F.sum("budget")).first()[0] or 1
    shared = shared.select(
        "source", "tokens", "budget", (F.col("budget") / F.lit(float(whole))).alias("weight"),
        F.floor(F.col("budget") / F.col("tokens")).alias("epochs"), (F.col("budget") % F.col("tokens")).alias("rest"),
    )
    # The hash at which the last pass of a source ends: the bucket where its rest runs out, then the row there.
    same = F.col("source").eqNullSafe(F.col("_source"))
    last = (
        rows.join(shared.select(F.col("source").alias("_source"), "epochs", "rest").filter("rest > 0"), same)
        .withColumn("key", _key(F.col("epochs"), F.col("doc_id"), F.col("content")))
        .select("source", "rest", "tokens", "key", F.substring("key", 1, 3).alias("bucket"))
    )
    totals = last.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    crossing = totals.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter(
        "before < rest and before + n >= rest"
    )
    crossing = crossing.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "before")
    inside = Window.partitionBy("source").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        last.join(crossing, same & (F.col("bucket") == F.col("_bucket")))
        .withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .filter("at < rest").groupBy("source").agg(F.max("key").alias("last_key"))
        .withColumnRenamed("source", "_source")
    )
    return Mixture(exponent, int(whole), stored(shared.join(ends, same, "left").drop("_source"), "mixture"))


def _copies(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """Rows with ``epoch`` for every pass that draws them, and the columns ``budget, weight`` of their source.

    Sources are few next to documents; the planner broadcasts them if they are small, and else splits a large source.
    """
    per_source = mixture.sources.select(
        F.col("source").alias("_source"), "budget", "weight", F.col("tokens").alias("pass_tokens"), "epochs", "last_key"
    )
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    again = F.coalesce(_key(F.col("epochs"), F.col("doc_id"), F.col("content")) <= F.col("last_key"), F.lit(False)).cast("long")
    drawn = joined.withColumn("draws", F.col("epochs") + again)
    return drawn.withColumn("epoch", F.explode(F.when(F.col("draws") > 0, F.sequence(F.lit(0).cast("long"), F.col("draws") - 1))))


def draws(docs: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = REPETITION_LIMIT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixture as rows: ``doc_id, source, tokens, weight, epoch, block, place``.

    ``weight`` is the weight of the source, ``epoch`` its pass, ``block`` the block of the mixture and ``place`` the number from 0
    within the block. A null source is a source of its own. A row without words counts as one token. Rows with one doc_id,
    or without one, have places of their own by their texts; rows equal in both are drawn together. An empty table gives an empty one.
    """
    rows = stored(measured(docs), "measured")
    mixture = plan(rows, target_entropy, repetition_limit)
    copies = _copies(rows, mixture).withColumn("key", _key(F.col("epoch"), F.col("doc_id"), F.col("content")))
    copies = copies.select("doc_id", "source", "tokens", "weight", "budget", "pass_tokens", "epoch", "key", F.substring("key", 1, 3).alias("bucket"))
    totals = copies.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("source").alias("_source"), F.col("epoch").alias("_epoch"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("epoch") == F.col("_epoch")) & (F.col("bucket") == F.col("_bucket"))
    at = F.col("epoch") * F.col("pass_tokens") + F.col("before") + F.coalesce("inside", F.lit(0))
    blocks = max(1, -(-mixture.budget // block_tokens))
    block = F.least(F.floor(at / F.col("budget") * blocks), F.lit(blocks - 1)).cast("long")
    placed = copies.withColumn("inside", F.sum("tokens").over(inside)).join(before, same).withColumn("block", block)
    order = Window.partitionBy("block").orderBy(F.md5(F.concat_ws(":", "key", F.coalesce("source", F.lit("")))), "tokens", "doc_id")
    place = (F.row_number().over(order) - 1).cast("long")
    return placed.select("doc_id", "source", "tokens", F.round("weight", 9).alias("weight"), "epoch", "block", place.alias("place"))


def mixed(docs: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = REPETITION_LIMIT) -> DataFrame:
    """The documents as often as the mixture draws them, all columns as they are; every document at least once."""
    mixture = plan(stored(measured(docs), "measured"), target_entropy, repetition_limit)
    packed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"),
        _content(F.col("text")).alias("content"),
    )
    return _copies(packed, mixture).select("row.*")
