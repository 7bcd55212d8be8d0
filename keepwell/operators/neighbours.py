"""Exact k nearest neighbours within one bounded set of points.

Every point is a question, and questions are spread over tasks of a bounded size. The known points are taken in blocks of a
fixed size; a block is broadcast, and each task compares its questions with it and keeps the k best. The best of all blocks
are chosen per question at the end.

**Cells.** A block is cut into cells of near points, each with the box around it. A question meets the cell of the nearest box, then
those whose boxes are no farther away than the worst neighbour it has found so far. Of a cell and its questions one matrix product
gives lower bounds of all squares; only pairs that the bound does not exclude are measured, axis by axis.

**Copies.** Of equal points a question needs the k with the smallest ids, so a block holds no more of them than any question asks for.

Where boxes exclude nothing the work is the square of the number of points, so more than ``MOST_POINTS`` are refused;
``near.near_neighbours`` takes any number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keepwell.session import settle

# Numbers of a broadcast block: 16 MB.
BLOCK_NUMBERS = 1 << 21
_BLOCK = 256
# Questions that a task holds.
TASK_POINTS = 25_000
# Points of a cell, and questions compared at a time, at most.
CELL_POINTS = 512
ASKED_POINTS = 2048
# All pairs of more points are not compared.
MOST_POINTS = 10_000_000


def _squares(asked: np.ndarray, known: np.ndarray) -> np.ndarray:
    total = np.zeros((len(asked), len(known)))
    for axis in range(asked.shape[1]):
        total += np.square(asked[:, axis, None] - known[None, :, axis])
    return total


def closest_of(asked_ids, asked, known_ids, known, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of questions: their places, and per question the (ids, distances) of up to k other points."""
    by_id = np.argsort(known_ids, kind="stable")
    known_ids, known = known_ids[by_id], known[by_id]
    for at in range(0, len(asked), _BLOCK):
        block = slice(at, at + _BLOCK)
        squares = _squares(asked[block], known)
        squares[asked_ids[block, None] == known_ids[None, :]] = np.inf
        take = min(k, squares.shape[1])
        reach = np.partition(squares, take - 1, axis=1)[:, take - 1]
        row, column = np.nonzero(squares <= reach[:, None])
        found = squares[row, column]
        # Columns stand in the order of the ids, so equal distances fall to the smaller id.
        order = np.lexsort((column, found, row))
        row, column, found = row[order], column[order], found[order]
        first = np.searchsorted(row, np.arange(len(squares)))
        kept = np.arange(len(row)) - first[row] < take
        shape = (len(squares), take)
        yield np.arange(at, at + len(squares)), known_ids[column[kept]].reshape(shape), found[kept].reshape(shape)


def _numbers(vectors, width: int) -> np.ndarray:
    """The rows of a column of lists."""
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in getattr(vectors, "chunks", [vectors])]
    return np.concatenate([*parts, np.empty(0)]).reshape(-1, width)


def _parted(inside: np.ndarray, reach: float) -> tuple[int, float] | None:
    """The axis and the value up to which points go to one side, so that most pairs are in different sides and farther apart than
    ``reach``. Some rows decide: it is about speed only."""
    some, best = inside[::max(1, len(inside) // 1000)], (0.0, None)
    for axis, x in enumerate(some.T):
        middle = np.partition(x, len(x) // 2)[len(x) // 2]
        left = x <= middle if (x > middle).any() else x < middle
        if left.any():
            low, high = x[left].max(), x[~left].min()
            told = np.count_nonzero(high - x[left] > reach) * (~left).sum() + np.count_nonzero(x[~left] - low > reach) * left.sum()
            best = max(best, (told, (axis, low)), key=lambda b: b[0])
    return best[1]


def _cells(vectors: np.ndarray, size: int, reach: float) -> list[np.ndarray]:
    """Places of the rows in cells of at most ``size``."""
    cells, waiting = [], [np.arange(len(vectors))]
    while waiting:
        own = waiting.pop()
        if len(own) <= size:
            cells.append(own)
            continue
        inside, middle = vectors[own], len(own) // 2
        if parted := _parted(inside, reach):
            left = inside[:, parted[0]] <= parted[1]
            waiting += [own[left], own[~left]]
        else:
            cut = np.argpartition(inside[:, inside.var(axis=0).argmax()], middle)
            waiting += [own[cut[:middle]], own[cut[middle:]]]
    return cells


class _Known(NamedTuple):
    """Points of a block cell by cell: those of cell i are from ``starts[i]`` on, within the box from ``low[i]`` to ``high[i]``."""

    ids: np.ndarray
    vectors: np.ndarray
    starts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    reach: float

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, k: int) -> _Known:
        # How far neighbours are: some points say where cells are cut, not what is near.
        asked = vectors[::max(1, len(vectors) // 100)]
        far = np.partition(_lower_bounds(asked, vectors), min(k, len(vectors) - 1), axis=1)[:, min(k, len(vectors) - 1)]
        reach = math.sqrt(max(float(np.median(far)), 0.0))
        cells = _cells(vectors, CELL_POINTS, reach)
        starts = np.cumsum([0, *map(len, cells)])
        order = np.concatenate(cells)
        boxes = [(vectors[c].min(axis=0), vectors[c].max(axis=0)) for c in cells]
        return cls(ids[order], vectors[order], starts, *(np.stack(side) for side in zip(*boxes)), reach)


def _pair_squares(asked: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Squares of rows that stand side by side, summed in the order of ``_squares``."""
    total = np.zeros(len(asked))
    for axis in range(asked.shape[1]):
        total += np.square(asked[:, axis] - known[:, axis])
    return total


def _lower_bounds(asked: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Squares by one matrix product, each less by more than its rounding can be."""
    centre = asked.mean(axis=0)
    asked, known = asked - centre, known - centre
    slack = 1 - 4 * (asked.shape[1] + 8) * np.finfo(float).eps
    lengths = [np.square(x).sum(axis=1)[:, None] * slack for x in (asked, known)]
    left = np.hstack([-2 * asked, lengths[0], np.ones_like(lengths[0])])
    return left @ np.hstack([known, np.ones_like(lengths[1]), lengths[1]]).T


def _closest_in(known: _Known, asked_ids: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, id, square): up to k other known points of every question, the smaller id among equals."""
    size = len(asked)
    squares, ids = np.full((size, k), np.inf), np.full((size, k), np.iinfo(np.int64).max)
    away = np.zeros((size, len(known.low)))
    for axis in range(asked.shape[1]):
        x = asked[:, axis, None]
        away += np.square(np.maximum(np.maximum(known.low[:, axis] - x, x - known.high[:, axis]), 0))
    # Rounded down, as a box may not seem farther than a point on its edge.
    away *= 1 - 4 * (asked.shape[1] + 8) * np.finfo(float).eps

    def meet(rows: np.ndarray, cell: int) -> None:
        own = slice(known.starts[cell], known.starts[cell + 1])
        own_ids, vectors, reach = known.ids[own], known.vectors[own], squares[rows, -1]
        least = _lower_bounds(asked[rows], vectors)
        if len(own_ids) > k and np.isinf(reach).any():
            # The k other points of least bounds give a first reach: their squares are measured.
            least[asked_ids[rows, None] == own_ids[None, :]] = np.inf
            first = np.argpartition(least, k - 1, axis=1)[:, :k]
            measured = _pair_squares(np.repeat(asked[rows], k, axis=0), vectors[first.ravel()]).reshape(-1, k)
            measured[np.isinf(np.take_along_axis(least, first, axis=1))] = np.inf
            reach = np.minimum(reach, measured.max(axis=1))
        row, column = np.nonzero(least <= reach[:, None])
        measured = _pair_squares(asked[rows[row]], vectors[column])
        some = (measured <= reach[row]) & (asked_ids[rows[row]] != own_ids[column])
        if not some.any():
            return
        row, near, measured = rows[row[some]], own_ids[column[some]], measured[some]
        changed = np.unique(row)
        row = np.concatenate([row, np.repeat(changed, k)])
        measured = np.concatenate([measured, squares[changed].ravel()])
        near = np.concatenate([near, ids[changed].ravel()])
        order = np.lexsort((near, measured, row))
        row, measured, near = row[order], measured[order], near[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        squares[changed], ids[changed] = measured[kept].reshape(-1, k), near[kept].reshape(-1, k)

    nearest, cells = away.argmin(axis=1), np.argsort(away.min(axis=0))
    for cell in np.unique(nearest):
        meet(np.flatnonzero(nearest == cell), cell)
    away[np.arange(size), nearest] = np.nan
    for cell in cells:
        rows = np.flatnonzero(away[:, cell] <= squares[:, -1])
        if len(rows):
            meet(rows, cell)
    place, at = np.nonzero(np.isfinite(squares))
    return place, ids[place, at], squares[place, at]


def _against(questions: DataFrame, block: DataFrame, k: int, width: int) -> DataFrame:
    """(point, neighbour, square): for every question the k closest points of one block."""
    rows = block.orderBy("point").toArrow()
    known = _Known.of(rows.column("point").to_numpy(), _numbers(rows.column("vector"), width), k) if rows.num_rows else None
    shared = questions.sparkSession.sparkContext.broadcast(known)

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = shared.value, [b for b in batches if b.num_rows]
        if known is None or not held:
            return
        ids = np.concatenate([b.column("point").to_numpy() for b in held])
        asked = np.concatenate([_numbers(b.column("vector"), width) for b in held])
        for own in _cells(asked, ASKED_POINTS, known.reach):
            place, near, squares = _closest_in(known, ids[own], asked[own], k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids[own][place], near, squares)], ["point", "neighbour", "square"]
            )

    return questions.mapInArrow(closest, "point bigint, neighbour bigint, square double")


def _asked_for(points: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the rows of the first ``k + 1`` ids: whoever asks finds k others among them. Rows of one id count up to k times."""
    once = points.withColumn("_same", F.row_number().over(Window.partitionBy("vector", "point").orderBy("point")))
    few = once.filter(F.col("_same") <= k).withColumn("_nth", F.dense_rank().over(Window.partitionBy("vector").orderBy("point")))
    return few.filter(F.col("_nth") <= k + 1).select("point", "vector")


def nearest_neighbours(points: DataFrame, k: int = 5, block_points: int | None = None) -> DataFrame:
    """(point, neighbour, place, distance): the k other points closest by Euclidean distance, nearer first,
    the smaller id among equals. ``points`` has a unique bigint ``point`` and an array<double> ``vector``; it should be stored.
    A block has ``block_points``, by default as many as ``BLOCK_NUMBERS`` allow."""
    count = points.count()
    if count > MOST_POINTS:
        raise ValueError(f"{count} points are too many to compare all pairs; use near.near_neighbours")
    tasks = max(2, points.sparkSession.sparkContext.defaultParallelism, -(-count // TASK_POINTS))
    points = settle(points.select("point", "vector").repartition(tasks, "point"))
    first = points.select(F.size("vector")).first()
    width = first[0] if first else 1
    known = settle(_asked_for(points, k))
    blocks = max(1, math.ceil(known.count() / (block_points or max(1, BLOCK_NUMBERS // max(width, 1)))))
    place = F.pmod(F.xxhash64("point"), F.lit(blocks))
    parts = [_against(points, known.filter(place == i), k, width) for i in range(blocks)]
    best = Window.partitionBy("point").orderBy("square", "neighbour")
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .select("point", "neighbour", "place", F.sqrt("square").alias("distance"))
    )
