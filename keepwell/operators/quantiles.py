"""Exact interpolated quantiles of many columns without collecting a column anywhere.

Spark's own exact ``percentile`` keeps every distinct value of a column in one task. Here a column with
many distinct values is first narrowed, by counting, to a bracket around each wanted rank; only the
distinct values inside the bracket are sorted. How many there are is estimated by a sketch, so the bound on what
one task sorts is approximate; the result is exact all the same.

Quantiles of groups are a table, ``grouped_quantiles``, and nothing of it is in the driver. Distinct values are counted, range-partitioned by
group, column and value, and numbered within their partition; sums over earlier partitions shift the numbers. A group with
very many values lies in many partitions, and very many groups in one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from keepwell.session import settle

# Distinct values of one column and group that one task may sort.
SORTABLE = 200_000
# Edges that a sketch proposes per step, and its accuracy.
EDGES = 500
SKETCH = 5_000

Fit = dict[tuple, dict[str, dict[float, float | None]]]


@dataclass
class _Rank:
    """A wanted rank, and the bracket of values known to hold it."""

    column: str
    rank: int
    inside: int
    distinct: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None


def _candidates(df: DataFrame, ranks: Sequence[_Rank], extra: str = "", values=None) -> DataFrame:
    """(target, value, ...) for the values in the bracket of each rank. ``extra`` names more columns per rank.

    The table of ranks has one row per quantile asked for; the planner broadcasts it while it is small. Values outside
    a bracket go as soon as they meet it.
    """
    fields = ["_column string", "target int", "low double", "high double"] + ([extra] if extra else [])
    rows = [(r.column, i, r.low, r.high, *(values[i] if values else ())) for i, r in enumerate(ranks)]
    wanted = df.sparkSession.createDataFrame(rows, ", ".join(fields))
    cells = [
        F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("value"))
        for c in sorted({r.column for r in ranks})
    ]
    long = df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*").filter("value IS NOT NULL")
    return long.join(wanted, F.col("_name") == F.col("_column")).filter(
        "(low IS NULL OR value >= low) AND (high IS NULL OR value <= high)"
    )


def _narrow(df: DataFrame, ranks: list[_Rank]) -> None:
    """One step for each rank: a sketch proposes a smaller bracket, a count says on which side of it the rank is."""
    grid = [i / EDGES for i in range(EDGES + 1)]
    sketches = _candidates(df, ranks).groupBy("target").agg(
        F.percentile_approx("value", grid, SKETCH).alias("edges"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    proposals: list[tuple[float, float]] = [(0.0, 0.0)] * len(ranks)
    for row in sketches.collect():
        rank = ranks[row["target"]]
        place = (rank.rank - rank.below) / max(rank.inside - 1, 1) * EDGES
        first, last = math.floor(place) - 1, math.ceil(place) + 1
        low = row["edges"][first] if first > 0 else row["min"]
        high = row["edges"][last] if last < EDGES else row["max"]
        if low == row["min"] and high == row["max"]:
            high = low + (high - low) / 2
        proposals[row["target"]] = (low, high)

    under, over = F.col("value") < F.col("p_low"), F.col("value") > F.col("p_high")
    inner = ~under & ~over
    counted = _candidates(df, ranks, "p_low double, p_high double", proposals).groupBy("target").agg(
        F.count(F.when(under, True)).alias("n_under"),
        F.count(F.when(inner, True)).alias("n_inner"),
        F.approx_count_distinct(F.when(under, F.col("value"))).alias("d_under"),
        F.approx_count_distinct(F.when(inner, F.col("value"))).alias("d_inner"),
        F.approx_count_distinct(F.when(over, F.col("value"))).alias("d_over"),
        F.max(F.when(under, F.col("value"))).alias("before"),
        F.min(F.when(over, F.col("value"))).alias("after"),
    )
    for row in counted.collect():
        rank = ranks[row["target"]]
        start = rank.below + row["n_under"]
        end = start + row["n_inner"]
        if rank.rank < start:
            rank.high, rank.inside, rank.distinct = row["before"], row["n_under"], row["d_under"]
        elif rank.rank < end:
            rank.low, rank.high = proposals[row["target"]]
            rank.below, rank.inside, rank.distinct = start, row["n_inner"], row["d_inner"]
        else:
            rank.low, rank.inside = row["after"], rank.inside - row["n_under"] - row["n_inner"]
            rank.below, rank.distinct = end, row["d_over"]


def _resolve(df: DataFrame, ranks: list[_Rank]) -> None:
    """Sort the distinct values of every bracket and read off the ranks."""
    inside = _candidates(df, ranks, "place bigint", [(r.rank - r.below,) for r in ranks])
    counted = inside.groupBy("target", "place", "value").agg(F.count(F.lit(1)).alias("rows"))
    so_far = Window.partitionBy("target").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        counted.withColumn("end", F.sum("rows").over(so_far))
        .filter("end - rows <= place AND place < end")
        .select("target", "value")
    )
    for row in hits.collect():
        ranks[row["target"]].value = row["value"]


def grouped_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], by: Sequence[str], parts: int | None = None
) -> DataFrame:
    """``(*by, column, p, value)`` for each group, wanted column and share; linear between neighbours, null without values.

    Values are compared as doubles, NULLs do not count, a null group is a group. ``parts`` range partitions are used, by default
    ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_b{i}" for i in range(len(by))]
    group = [*names, "_column"]
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in wanted])
    long = df.select(*[F.col(b).alias(n) for b, n in zip(by, names)], F.explode(cells).alias("_cell")).select(*names, "_cell.*")
    counted = settle(long.groupBy(*group, "_value").agg(F.count("_value").alias("_rows")))
    placed = settle(counted.repartitionByRange(parts, *group, "_value").withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy("_part", *group).agg(F.sum("_rows").alias("_held"))
    # A group has one row here for each partition that it lies in.
    own = Window.partitionBy(*group)
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "_part", *group, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"), F.sum("_held").over(own).alias("_all")
    )
    so_far = Window.partitionBy("_part", *group).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group]
    numbered = (
        placed.withColumn("_end", F.sum("_rows").over(so_far)).alias("v")
        .join(shifts.alias("s"), reduce(lambda a, b: a & b, same, F.col("v._part") == F.col("s._part")))
        .select(*[F.col(f"v.{c}").alias(c) for c in group], "_value", "_rows", "_all", (F.col("_before") + F.col("_end")).alias("_end"))
    )
    asked = F.create_map(*[x for c, probs in wanted.items() for x in (F.lit(c), F.array(*[F.lit(float(p)) for p in probs]))])
    place = F.col("_p") * (F.col("_all") - 1)
    first = F.floor(place)
    last = F.least(first + 1, F.col("_all") - 1)

    def here(rank):
        return (rank >= F.col("_end") - F.col("_rows")) & (rank < F.col("_end"))

    hits = (
        numbered.withColumn("_p", F.explode(F.element_at(asked, F.col("_column"))))
        .filter(here(first) | here(last) | (F.col("_all") == 0))
        .groupBy(*group, "_p").agg(
            F.max(F.when(here(first), F.col("_value"))).alias("_low"), F.max(F.when(here(last), F.col("_value"))).alias("_high"),
            F.max(place - first).alias("_weight"),
        )
    )
    return hits.select(
        *[F.col(n).alias(b) for b, n in zip(by, names)], F.col("_column").alias("column"), F.col("_p").alias("p"),
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_weight")).alias("value"),
    )


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    by: Sequence[str] = (),
    sortable: int = SORTABLE,
) -> Fit:
    """``{group: {column: {p: value}}}`` with linear interpolation between neighbours; NULLs do not count.

    Without ``by`` the driver holds one bracket per quantile. Groups go through ``grouped_quantiles``; callers with many of them use
    that table and not this dictionary. ``df`` is read several times and should be stored.
    """
    columns = list(wanted)
    if by:
        grouped: Fit = {}
        for row in grouped_quantiles(df, wanted, by).toLocalIterator():
            cells = grouped.setdefault(tuple(row[b] for b in by), {c: {p: None for p in wanted[c]} for c in columns})
            cells[row["column"]][row["p"]] = row["value"]
        return grouped

    fit = {c: {p: None for p in wanted[c]} for c in columns}
    ranks: dict[tuple, _Rank] = {}
    places = []
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    for c in columns:
        for p in wanted[c] if counts[c] else ():
            place = p * (counts[c] - 1)
            first = math.floor(place)
            ends = (first, min(first + 1, counts[c] - 1))
            for rank in ends:
                # A column cannot have more distinct values than rows.
                ranks.setdefault((c, rank), _Rank(c, rank, counts[c], counts[c]))
            places.append((c, p, place - first, *ends))
    # Only long columns need the estimate.
    long = sorted({r.column for r in ranks.values() if r.distinct > sortable})
    if long:
        estimate = df.agg(*[F.approx_count_distinct(F.col(c).cast("double")).alias(c) for c in long]).first()
        for r in ranks.values():
            if r.column in long:
                r.distinct = min(r.distinct, estimate[r.column])
    while wide := [r for r in ranks.values() if r.distinct > sortable]:
        _narrow(df, wide)
    if ranks:
        _resolve(df, list(ranks.values()))
    for c, p, weight, first, last in places:
        low, high = ranks[c, first].value, ranks[c, last].value
        fit[c][p] = low + (high - low) * weight
    return {(): fit}


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> Fit:
    """Exact quantiles, or with ``accuracy`` one pass of the built-in sketch."""
    if accuracy is None:
        return exact_quantiles(df, wanted, by)
    sketches = [
        F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c, probs in wanted.items()
    ]
    rows = (df.groupBy(*by).agg(*sketches) if by else df.agg(*sketches)).collect()
    return {
        tuple(row[b] for b in by): {
            c: dict(zip(probs, row[c] if row[c] is not None else [None] * len(probs)))
            for c, probs in wanted.items()
        }
        for row in rows
    }


def medians(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), accuracy: int | None = None
) -> dict[tuple, dict[str, float | None]]:
    fit = quantiles(df, {c: [0.5] for c in columns}, by, accuracy)
    return {group: {c: probs[0.5] for c, probs in cells.items()} for group, cells in fit.items()}
