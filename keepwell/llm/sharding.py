"""Sharding by balanced label propagation.

Documents with equal texts are linked through the text they share. Labels are shards. At first linked documents are
dealt out evenly; then rounds of joins and aggregates move them:

1. every text counts its documents in each shard and chooses one: with room for all of them, and then where most are;
2. documents elsewhere ask to move there. For each pair of shards the driver sees two numbers, the requests there and
   back, and sets a quota: what can be swapped, and what the receiving shard has room for;
3. requests are granted up to the quota, greatest gain first.

Documents of one text in one shard are interchangeable, so a round works on cells ``(text, shard, count)``: at most one cell
for each text and shard, however many copies there are. Documents without a link have no edge to cut; they fill the
shards up at the end. Counts of shards then differ by one at most.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from keepwell.llm.shared import numbered, stored

SHARDS = 8
ROUNDS = 12
_BINS = 256


def _asks(cells: DataFrame, room: list[int]) -> DataFrame:
    """Requests ``(key, label, n, target, gain)`` of the cells that are not in the shard their text has chosen.

    A text prefers shards with room for all its documents, then the one that holds most. Equal ones are told apart by
    the hash of the text, so that ties do not all fall to one shard. A text has one count for each shard at most.
    """
    held = cells.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("held"))
    copies = F.aggregate(F.map_values("held"), F.lit(0).cast("long"), lambda s, x: s + x)
    rooms = F.array(*[F.lit(r).cast("long") for r in room])

    def choice(shard):
        n = F.coalesce(F.element_at("held", shard), F.lit(0).cast("long"))
        turn = -F.pmod(shard - F.xxhash64("key"), F.lit(len(room)))
        return F.struct((F.get(rooms, shard) >= F.col("copies") - n).alias("fits"), n.alias("n"), turn.alias("turn"), shard.alias("label"))

    shards = F.sequence(F.lit(0), F.lit(len(room) - 1))
    chosen = held.withColumn("copies", copies).withColumn("best", F.array_max(F.transform(shards, choice)))
    return (
        chosen.select("key", "best", F.explode("held").alias("label", "n")).filter("label != best.label")
        .select("key", "label", "n", F.col("best.label").alias("target"), F.greatest(F.col("best.n") - F.col("n"), F.lit(0)).alias("gain"))
    )


def _quotas(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Granted numbers per (from, to): swaps, then the room of the receiving shard, larger requests first."""
    granted = {pair: min(n, asked.get(pair[::-1], 0)) for pair, n in asked.items()}
    room = list(room)
    for (source, target), n in sorted(asked.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - granted[source, target], room[target])
        granted[source, target] += more
        room[target] -= more
    return granted


def _grant(asks: DataFrame, quotas: dict[tuple[int, int], int]) -> DataFrame:
    """Requests with ``moved``: how many of each are granted, greatest gain first within each pair of shards.

    Requests are put into bins by the size of their gain and a hash; bins are granted in order, and only the requests of
    one bin are ranked together.
    """
    spark = asks.sparkSession
    limits = spark.createDataFrame([(a, b, n) for (a, b), n in quotas.items()], "label int, target int, quota long")
    size = F.floor(F.log2(F.col("gain") + 1)).cast("int")
    binned = asks.withColumn("bin", -size * _BINS + F.pmod(F.xxhash64("key"), F.lit(_BINS)).cast("int"))
    pair = ["label", "target"]
    earlier = Window.partitionBy(*pair).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = binned.groupBy(*pair, "bin").agg(F.sum("n").alias("asked"))
    before = totals.select(*pair, "bin", F.coalesce(F.sum("asked").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*pair, "bin").orderBy(F.desc("gain"), "key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("quota") - F.col("before") - F.coalesce(F.sum("n").over(inside), F.lit(0))
    return (
        binned.join(before, [*pair, "bin"]).join(limits, pair)
        .select("key", "label", "target", "n", F.greatest(F.lit(0), F.least("n", left)).alias("moved"))
    )


def propagate(cells: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Cells ``(key, label, n)`` after moving until nothing moves, or for ``rounds`` rounds; no shard exceeds its capacity."""
    shards = len(capacity)
    for _ in range(rounds):
        loads = {r.label: r.n for r in cells.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        room = [capacity[s] - loads.get(s, 0) for s in range(shards)]
        asks = stored(_asks(cells, room), "asks")
        wishes = asks.groupBy("label", "target").agg(F.sum("n").alias("n")).collect()
        quotas = _quotas({(r.label, r.target): r.n for r in wishes}, room)
        if not any(quotas.values()):
            break
        moves = stored(_grant(asks, quotas).filter("moved > 0"), "moves")
        change = moves.select("key", F.col("target").alias("label"), F.col("moved").alias("n")).union(
            moves.select("key", "label", -F.col("moved"))
        )
        cells = stored(
            cells.select("key", "label", "n").union(change).groupBy("key", "label").agg(F.sum("n").alias("n")).filter("n > 0"),
            "cells",
        )
    return cells


def _interval(rank, bounds: list[int]):
    """Number of bounds that a rank has reached."""
    return sum([F.when(rank >= b, 1).otherwise(0) for b in bounds], F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, copies`` for every row of documents.

    The law is ``rows``: counts of shards differ by one at most, slots run from 0 without gaps. Equal texts share a shard
    as far as the counts allow. ``copies`` counts the rows with the text. A null text is linked with empty ones and has size 1. Repeated
    rows and null doc_ids are rows like any other. Other columns are ignored; an empty table gives an empty one.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.unhex(F.md5(raw)).alias("key"),
        ),
        "rows",
    )
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    spread, order = F.xxhash64("doc_id", "key"), [F.xxhash64("doc_id", "key"), F.col("doc_id")]

    # Stored before they are joined: a join straight above an aggregate keeps a text's copies in one task.
    groups = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "groups")
    marked = stored(rows.join(groups, "key", "left").withColumn("copies", F.coalesce("copies", F.lit(1))), "marked")
    linked = stored(numbered(numbered(marked.filter("copies > 1"), [], spread, order, "turn"), ["key"], spread, order, "rank"), "linked")
    dealt = linked.groupBy("key", (F.col("turn") % shards).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    cells = propagate(stored(dealt, "cells"), capacity, rounds)

    # The copies of a text are told apart by their rank: so many for its first shard, then for the next.
    up_to = Window.partitionBy("key").orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
    ends = stored(
        cells.withColumn("end", F.sum("n").over(up_to)).groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("end", "label"))).alias("ends")
        ),
        "ends",
    )
    placed = (
        linked.join(ends, "key")
        .withColumn("shard", F.filter("ends", lambda e: e["end"] > F.col("rank"))[0]["label"])
        .drop("ends", "rank", "turn")
    )
    placed = stored(numbered(placed, ["shard"], spread, order, "slot"), "placed")

    loads = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    room = [capacity[s] - loads.get(s, 0) for s in range(shards)]
    ends_of = list(accumulate(room))
    first_slot = F.array(*[F.lit(loads.get(s, 0) - (ends_of[s] - room[s])).cast("long") for s in range(shards)])
    alone = numbered(marked.filter("copies = 1"), [], spread, order, "rank", 8192)
    alone = alone.withColumn("shard", _interval(F.col("rank"), ends_of[:-1]))
    alone = alone.withColumn("slot", F.col("rank") + F.get(first_slot, "shard"))
    shown = [
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "copies",
    ]
    return placed.select(*shown).union(alone.select(*shown))
