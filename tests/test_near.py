"""Neighbours by ordered tables against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import near
from keepwell.operators.neighbours import nearest_neighbours
from keepwell.operators.smote import smote
from keepwell.params import Oversampling
from keepwell.session import settle


def points(spark, x):
    return settle(spark.createDataFrame(
        [(int(i), [float(v) for v in row]) for i, row in enumerate(x)], "point bigint, vector array<double>"
    ))


def recall(found, exact):
    """Share of exact distances, by place, that were found: equal distances are as good."""
    both = exact.select("point", "place", F.col("distance").alias("want")).join(found, ["point", "place"], "left")
    return both.agg(F.avg((F.col("distance") <= F.col("want") + 1e-12).cast("double"))).first()[0]


@pytest.mark.parametrize("width,kind", [(3, "normal"), (20, "clusters")])
def test_recall(spark, width, kind):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(3000, width))
    if kind == "clusters":
        x = x * 0.3 + rng.normal(size=(60, width))[rng.integers(0, 60, 3000)]
    table = points(spark, x)
    found = settle(near.near_neighbours(table, 5))
    assert found.groupBy("point").count().filter("count = 5").count() == 3000
    assert recall(found, nearest_neighbours(table, 5)) >= 0.95


def test_copies_are_many_windows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 4))
    x[:500] = x[0]  # a third are copies of one point
    table = points(spark, x)
    found = settle(near.near_neighbours(table, 4, window=64))
    assert recall(found, nearest_neighbours(table, 4)) >= 0.95
    assert found.filter("point = neighbour").count() == 0
    assert found.filter("point < 500").agg(F.max("distance")).first()[0] == 0


def test_work_grows_with_the_points(spark, monkeypatch):
    """Rows that windows compare, and pairs of the refinement, grow in proportion and not with the square."""
    rng = np.random.default_rng(2)
    compared = []
    for size in (1000, 4000):
        table = points(spark, rng.normal(size=(size, 6)))
        directions = near._directions(6, 4, 1)
        placed = near._ordered(table, directions, 4, np.zeros(16)).repartitionByRange(4, "table", "order", "point")
        inside = near._in_windows(placed.sortWithinPartitions("table", "order", "point"), 3, 32)
        close = settle(near._closest(inside, 3))
        edges = close.select("point", F.explode("near.neighbour").alias("by"))
        pairs = edges.join(close.select(F.col("point").alias("by"), F.explode("near.neighbour").alias("n")), "by")
        compared.append(inside.count() + pairs.count())
    assert math.log(compared[1] / compared[0]) / math.log(4) < 1.3


def test_few_and_no_points(spark):
    found = near.near_neighbours(points(spark, np.array([[0.0], [1.0], [5.0]])), 2).collect()
    assert sorted((r["point"], r["place"], r["neighbour"]) for r in found) == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0)]
    assert near.near_neighbours(points(spark, np.array([[0.0]])).limit(0), 2).count() == 0
    with pytest.raises(ValueError, match="window"):
        near.near_neighbours(points(spark, np.zeros((3, 1))), 5, window=8)


def test_smote_beyond_the_exact_bound(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    made = smote(points(spark, x), 1000, Oversampling(ratio=0.5, neighbours=3, exact_up_to=100)).collect()
    assert len(made) == 200
    for r in made:
        a, b, v = x[r["point"]], x[r["neighbour"]], np.array(r["vector"])
        gap = (v - a) @ (b - a) / ((b - a) @ (b - a))
        assert 0 <= gap < 1 and np.allclose(v, a + gap * (b - a))


def test_smote_of_many_copies_goes_to_the_nearest(spark):
    """500 copies of each of 41 places: of those at distance 0 the smaller ids are nearer."""
    rows = spark.range(20_500, numPartitions=4).select(
        F.col("id").alias("point"), F.array((F.col("id") % 41).cast("double"), F.lit(1.0)).alias("vector")
    )
    made = smote(settle(rows), 80_000, Oversampling(ratio=0.5))
    assert made.count() == 19_500
    assert made.filter("neighbour % 41 <> point % 41 OR neighbour >= 41 * 6").count() == 0


def test_too_many_points_for_all_pairs(spark, monkeypatch):
    from keepwell.operators import neighbours

    monkeypatch.setattr(neighbours, "MOST_POINTS", 2)
    with pytest.raises(ValueError, match="too many"):
        nearest_neighbours(points(spark, np.zeros((3, 1))), 1)


def test_more_points_than_were_allowed_are_compared_exactly(spark):
    rows = spark.range(210_000, numPartitions=8).select(F.col("id").alias("point"), F.array(F.col("id").cast("double")).alias("vector"))
    found = nearest_neighbours(settle(rows), 2).groupBy("point").agg(
        F.array_sort(F.collect_list(F.struct("place", "neighbour", "distance"))).alias("hits")
    )
    last, p, hit = 209_999, F.col("point"), F.transform("hits", lambda h: h["neighbour"])
    ends = F.when(p == 0, F.array(F.lit(1), F.lit(2))).when(p == last, F.array(F.lit(last - 1), F.lit(last - 2))).otherwise(F.array(p - 1, p + 1))
    assert found.filter(hit == ends).count() == 210_000


@pytest.mark.parametrize("kind", ["normal", "far from zero", "copies", "few values"])
def test_cells_miss_no_neighbour(monkeypatch, kind):
    from keepwell.operators import neighbours

    monkeypatch.setattr(neighbours, "CELL_POINTS", 9)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    if kind == "far from zero":
        x = x * 1e-3 + 1e6
    elif kind == "copies":
        x[:150] = x[0]
    elif kind == "few values":
        x = x.round(0)
    ids = rng.permutation(300)
    known = neighbours._Known.of(ids, x, 5)
    assert len(known.starts) > 30
    got = {}
    for own in neighbours._cells(x, 64, known.reach):
        place, near, squares = neighbours._closest_in(known, ids[own], x[own], 5)
        for p, n, s in zip(ids[own][place].tolist(), near.tolist(), squares.tolist()):
            got.setdefault(p, []).append((s, n))
    for at, point in enumerate(ids.tolist()):
        squares = neighbours._squares(x[at:at + 1], x)[0]
        assert sorted(got[point]) == sorted((s, i) for s, i in zip(squares.tolist(), ids.tolist()) if i != point)[:5]


def test_rows_of_one_point_count_as_before(spark):
    x = np.array([[0.0], [0.0], [1.0], [3.0], [7.0]])
    table = settle(points(spark, x).unionByName(points(spark, x)))
    found = sorted(map(tuple, nearest_neighbours(table, 3).select("point", "place", "neighbour").collect()))
    assert [n for p, _, n in found if p == 4] == [3, 3, 3] and [n for p, _, n in found if p == 0] == [1, 1, 1]
