"""Nearest neighbours without comparing all pairs.

**Tables.** In each of several tables the points are put in an order in which near points tend to be neighbours: a few random
projections are cut into levels and the bits of the levels interleaved. Points are range-partitioned by that order and compared
within overlapping windows of a fixed size. A window never holds more than ``window`` points, so copies of one point, or a
dense region, are many windows and not one large bucket.

**Refinement.** What is near to a near point is likely near: the neighbours of the neighbours found so far are compared in a
join, and the closest are kept. This is repeated ``rounds`` times.

The work is proportional to the number of points. Distances are exact; what may be missed is a neighbour that no table and no
round has met. ``neighbours.nearest_neighbours`` is the exact way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keepwell.operators.neighbours import closest_of
from keepwell.session import settle

TABLES = 8
WINDOW = 128
ROUNDS = 2
#: Projections of a table, and bits of each level.
PROJECTIONS = 4
LEVEL_BITS = 8
#: Rows of all tables that a task orders.
TASK_ROWS = 50_000


def _directions(width: int, tables: int, seed: int) -> np.ndarray:
    """``(width, tables * PROJECTIONS)``: unit vectors in random directions."""
    drawn = np.random.default_rng(seed).normal(size=(width, tables * PROJECTIONS))
    return drawn / np.linalg.norm(drawn, axis=0)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _interleaved(levels: np.ndarray) -> np.ndarray:
    """One integer for each row of levels: their highest bits first, then their next."""
    out = np.zeros(len(levels), np.int64)
    for bit in range(LEVEL_BITS - 1, -1, -1):
        for column in range(levels.shape[1]):
            out = out << 1 | (levels[:, column] >> bit & 1)
    return out


def _spread(points: DataFrame, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every projection; the driver gets one row per task."""
    def run(batches):
        total = np.zeros((3, directions.shape[1]))
        for batch in batches:
            if batch.num_rows:
                p = _vectors(batch) @ directions
                total += [np.full(p.shape[1], len(p)), p.sum(axis=0), np.square(p).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array([row.tolist()], pa.list_(pa.float64())) for row in total], ["n", "s", "q"])

    sums = points.mapInArrow(run, "n array<double>, s array<double>, q array<double>").collect()
    n, s, q = (sum(np.array(r[c]) for r in sums) for c in ("n", "s", "q"))
    n = np.maximum(n, 1)
    deviation = np.sqrt(np.maximum(q / n - np.square(s / n), 0))
    return s / n, np.where(deviation > 0, deviation, 1)


def _ordered(points: DataFrame, directions: np.ndarray, tables: int, shift: np.ndarray) -> DataFrame:
    """Every point once per table, with its place in the order of the table."""
    mean, deviation = _spread(points, directions)
    steps = 1 << LEVEL_BITS

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            z = (_vectors(batch) @ directions - mean) / deviation
            # Three deviations to either side, each table's levels shifted on their own.
            levels = np.clip((z + 3) / 6 * steps + shift, 0, steps - 1).astype(np.int64)
            for table in range(tables):
                own = levels[:, table * PROJECTIONS:(table + 1) * PROJECTIONS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, table, np.int32)), pa.array(_interleaved(own)), batch.column("point"),
                     batch.column("vector")],
                    ["table", "order", "point", "vector"],
                )

    return points.mapInArrow(run, "table int, order long, point long, vector array<double>")


def _in_windows(ordered: DataFrame, k: int, window: int) -> DataFrame:
    """``point, neighbour, square``: the k closest points of every window that a point is in."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        tables = np.concatenate([b.column("table").to_numpy() for b in held])
        ids = np.concatenate([b.column("point").to_numpy() for b in held])
        vectors = np.concatenate([_vectors(b) for b in held])
        for table in np.unique(tables):
            rows = np.flatnonzero(tables == table)
            for at in range(0, max(len(rows) - window // 2, 1), window // 2):
                own = rows[at:at + window]
                for places, near, squares in closest_of(ids[own], vectors[own], ids[own], vectors[own], k):
                    asked = np.repeat(ids[own][places], near.shape[1])
                    some = np.isfinite(squares.ravel())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[some]) for x in (asked, near.ravel(), squares.ravel())], ["point", "neighbour", "square"]
                    )

    return ordered.mapInArrow(run, "point long, neighbour long, square double")


def _closest(found: DataFrame, k: int) -> DataFrame:
    """The k closest of each point, once each, as the sorted array ``near``. A point has a bounded number of rows here."""
    hits = F.array_sort(F.collect_set(F.struct("square", "neighbour")))
    return found.groupBy("point").agg(F.slice(hits, 1, k).alias("near"))


def _refined(near: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """``near`` with the neighbours of neighbours considered."""
    edges = near.select("point", F.explode("near.neighbour").alias("by"))
    onward = near.select(F.col("point").alias("by"), F.explode("near.neighbour").alias("neighbour"))
    pairs = edges.join(onward, "by").filter("point != neighbour").select("point", "neighbour").distinct()
    ends = points.select(F.col("point").alias("neighbour"), F.col("vector").alias("end"))
    gaps = F.zip_with("vector", "end", lambda a, b: (a - b) * (a - b))
    measured = pairs.join(points, "point").join(ends, "neighbour").select(
        "point", "neighbour", F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap).alias("square")
    )
    known = near.select("point", F.explode("near").alias("hit")).select("point", "hit.neighbour", "hit.square")
    return _closest(known.unionByName(measured), k)


def near_neighbours(
    points: DataFrame, k: int = 5, tables: int = TABLES, window: int = WINDOW, rounds: int = ROUNDS, seed: int = 11
) -> DataFrame:
    """(point, neighbour, place, distance) as ``nearest_neighbours`` gives them, but for neighbours that were not met.

    ``points`` has a unique bigint ``point`` and an array<double> ``vector`` of one length. Equal distances go by the smaller id.
    """
    if window < 2 * (k + 1):
        raise ValueError("a window holds at least twice as many points as are asked for")
    points = settle(points.select("point", "vector"))
    first = points.select(F.size("vector")).first()
    if first is None:
        return points.select("point", F.col("point").alias("neighbour"), F.lit(1).alias("place"), F.lit(0.0).alias("distance"))
    directions = _directions(first[0], tables, seed)
    shift = np.random.default_rng(seed + 1).uniform(-4, 4, directions.shape[1])
    tasks = max(tables, -(-points.count() * tables // TASK_ROWS))
    placed = _ordered(points, directions, tables, shift).repartitionByRange(tasks, "table", "order", "point")
    near = settle(_closest(_in_windows(placed.sortWithinPartitions("table", "order", "point"), k, window), k))
    for _ in range(rounds):
        near = settle(_refined(near, points, k))
    placed = near.select("point", F.posexplode("near").alias("at", "hit"))
    return placed.select(
        "point", "hit.neighbour", (F.col("at") + 1).cast("int").alias("place"), F.sqrt("hit.square").alias("distance")
    )
