"""Histogram boosting against plain Python."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from keepwell.operators import boosting
from keepwell.params import Boosting, Params
from keepwell.session import settle

SMALL = Boosting(trees=6, depth=3, learning_rate=0.3, bins=16, min_hessian=1.0, gamma=0.2, l1=0.1, l2=1.0)


def data(rows=200, width=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, width)).round(2)
    x[:, 1] = rng.integers(0, 3, rows)
    y = (x[:, 0] + (x[:, 1] == 1) + rng.normal(size=rows) * 0.5 > 0.8).astype(float)
    return x, y, np.where(y == 1, 2.5, 1.0)


def table(spark, x, y, w):
    rows = [(int(i), [float(v) for v in row], float(a), float(b)) for i, (row, a, b) in enumerate(zip(x, y, w))]
    df = spark.createDataFrame(rows, "_order bigint, v array<double>, churn_label double, _weight double")
    return settle(df.select("_order", array_to_vector("v").alias("features"), "churn_label", "_weight").repartition(3))


def worth(g, h, s):
    return max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)


def plain(x, y, w, s, seed):
    """Trees as ``{path: (column, threshold)}`` and leaves ``{path: value}``, one row and one cut at a time."""
    rows, width = x.shape
    cuts = []
    for i in range(width):
        ordered = sorted(x[:, i])
        picked = sorted({ordered[max(math.ceil(k / s.bins * rows), 1) - 1] for k in range(s.bins + 1)})
        cuts.append([(a + b) / 2 for a, b in zip(picked, picked[1:])][:s.bins - 1])
    margin, trees = [0.0] * rows, []
    for number in range(s.trees):
        g, h = (v.tolist() for v in boosting.gradients(np.array(margin), y, w))
        used = boosting._drawn(np.arange(rows), s.row_share, seed, number)
        columns = boosting.columns_of_tree(width, number, s, seed).tolist()
        splits, leaves = {}, {}

        def total(members):
            return sum(g[r] for r in members) / boosting.SCALE, sum(h[r] for r in members) / boosting.SCALE

        def grow(path, members):
            """Returns whether the node stays a leaf."""
            gw, hw = total(members)
            best = (1e-6, None)
            if len(path) < s.depth and hw >= 2 * s.min_hessian:
                for c in columns:
                    for cut in cuts[c]:
                        gl, hl = total([r for r in members if x[r, c] <= cut])
                        gr, hr = gw - gl, hw - hl
                        if hl >= s.min_hessian and hr >= s.min_hessian:
                            gain = worth(gl, hl, s) + worth(gr, hr, s) - worth(gw, hw, s)
                            if gain > best[0]:
                                best = (gain, (c, cut))
            value = -math.copysign(max(abs(gw) - s.l1, 0), gw) / (hw + s.l2) * s.learning_rate
            if best[1] is None:
                leaves[path] = value
                return True
            c, cut = best[1]
            flat = [grow(path + side, [r for r in members if (x[r, c] <= cut) == (side == "l")]) for side in "lr"]
            if all(flat) and best[0] < s.gamma:
                del leaves[path + "l"], leaves[path + "r"]
                leaves[path] = value
                return True
            splits[path] = best[1]
            return False

        grow("", [r for r in range(rows) if used[r]])

        def leaf(r):
            path = ""
            while path in splits:
                c, cut = splits[path]
                path += "l" if x[r, c] <= cut else "r"
            return path

        margin = [m + leaves[leaf(r)] for r, m in enumerate(margin)]
        trees.append((splits, leaves))
    return trees, margin


def as_paths(tree, cuts):
    splits, leaves, waiting = {}, {}, [(0, "")]
    while waiting:
        node, path = waiting.pop()
        if tree.column[node] >= 0:
            splits[path] = (int(tree.column[node]), float(cuts[tree.column[node]][tree.cut[node]]))
            waiting += [(2 * node + 1, path + "l"), (2 * node + 2, path + "r")]
        else:
            leaves[path] = float(tree.value[node])
    return splits, leaves


@pytest.mark.parametrize("settings", [SMALL, Boosting(trees=4, depth=4, bins=256, min_hessian=0.5, gamma=0.0, l1=0.0, l2=0.1, row_share=1.0)])
def test_trees_equal_plain_python(spark, settings):
    x, y, w = data()
    wanted, margin = plain(x, y, w, settings, 7)
    rows = table(spark, x, y, w)
    got, cuts = boosting.grow(rows, settings, 7, "churn_label", "_weight", "_order")
    assert len(got) == len(wanted)
    for tree, (splits, leaves) in zip(got, wanted):
        own_splits, own_leaves = as_paths(tree, cuts)
        assert own_splits == splits
        assert own_leaves.keys() == leaves.keys()
        assert all(abs(own_leaves[p] - leaves[p]) < 1e-12 for p in leaves)
    model = boosting.as_model(spark, got, cuts, settings.depth)
    scored = {r["_order"]: r["p"] for r in model.transform(rows).select("_order", vector_to_array("probability")[1].alias("p")).collect()}
    assert all(abs(scored[i] - 1 / (1 + math.exp(-m))) < 1e-9 for i, m in enumerate(margin))


def test_levels_as_jobs_give_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    x, y, w = data(300)
    few = Boosting(trees=3, depth=3, bins=32, min_hessian=1.0, learning_rate=0.3)
    rows = table(spark, x, y, w)
    one, cuts = boosting.grow(rows, few, 3, "churn_label", "_weight", "_order")
    many, again = boosting.grow(rows.repartition(5), few, 3, "churn_label", "_weight", "_order", local_cells=0)
    assert all(np.array_equal(a, b) for a, b in zip(cuts, again))
    assert [as_paths(t, cuts) for t in one] == [as_paths(t, cuts) for t in many]
    assert all(np.array_equal(a.rows, b.rows) for a, b in zip(one, many))


def test_penalties_and_importances(spark):
    x, y, w = data(400)
    rows = table(spark, x, y, w)
    base = Boosting(trees=3, depth=4, bins=32, min_hessian=0.5, gamma=0.0, l1=0.0, l2=0.0, learning_rate=0.3)

    def leaves(**changes):
        trees, cuts = boosting.grow(rows, Boosting(**{**base.__dict__, **changes}), 3, "churn_label", "_weight", "_order")
        return [v for t in trees[:1] for v in as_paths(t, cuts)[1].values()]

    plain_leaves = leaves()
    assert len(leaves(gamma=20.0)) < len(plain_leaves)
    assert len(leaves(min_hessian=20.0)) < len(plain_leaves)
    assert max(map(abs, leaves(l2=50.0))) < max(map(abs, plain_leaves))
    assert leaves(l1=1e6) == [0.0]
    model = boosting.fit_boosted(rows, base, 3)
    assert model.featureImportances.toArray()[:2].sum() > 0.7


def test_constant_missing_and_one_class(spark):
    x = np.zeros((30, 2))
    rows = table(spark, x, np.r_[np.ones(10), np.zeros(20)], np.ones(30))
    model = boosting.fit_boosted(rows, SMALL, 1)
    scores = {round(r[0], 9) for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 0.5
    x = np.column_stack([np.where(np.arange(30) < 10, np.nan, 1.0), np.arange(30.0)])
    gaps = table(spark, x, np.r_[np.ones(10), np.zeros(20)], np.ones(30))
    assert boosting.fit_boosted(gaps, SMALL, 1).transform(gaps).filter(F.col("prediction") == F.col("churn_label")).count() > 25
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit_boosted(rows.limit(0), SMALL, 1)


def test_settings_of_a_configuration():
    own = Params.from_config({"model": {"hyperparams": {"gamma": 2.0, "reg_alpha": 0.3, "reg_lambda": 4.0, "min_child_weight": 9}}}).boosting
    assert (own.gamma, own.l1, own.l2, own.min_hessian) == (2.0, 0.3, 4.0, 9)


def test_inputs_with_a_usual_bin_are_summed_the_same():
    rng = np.random.default_rng(5)
    bins = np.column_stack([rng.integers(0, 16, 500), rng.random(500) < 0.1, np.zeros(500), rng.random(500) < 0.8, rng.integers(0, 3, 500)]).astype(np.uint8)
    listed, plain_columns = boosting.Columns.of(bins, listed=True), boosting.Columns.of(bins)
    assert set(listed.rest) == {1, 2, 3} and not plain_columns.rest
    at, used = rng.integers(3, 7, 500), rng.random(500) < 0.8
    g, h = np.rint(rng.normal(size=500) * 1e6), np.rint(rng.random(500) * 1e6)
    got = [boosting.histograms(c, at, used, [4, 6], np.array([0, 1, 2, 3, 4]), 16, g, h) for c in (listed, plain_columns)]
    assert np.array_equal(*got)
    for node, cells in zip((4, 6), got[0]):
        for column, by_bin in enumerate(cells):
            for b, sums in enumerate(by_bin):
                rows = used & (at == node) & (bins[:, column] == b)
                assert sums.tolist() == [g[rows].sum(), h[rows].sum(), rows.sum()]
    no_rows = boosting.histograms(listed, at, np.zeros(500, bool), [4], np.array([0, 1]), 16, g, h)
    assert not no_rows.any()


def test_rows_go_down_a_level_at_a_time():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 256, (200, 3)).astype(np.uint8)
    tree = boosting.Tree(np.array([1, 0, -1, -1, 2, *[-1] * 10], np.int32), np.array([100, 254, 0, 0, 7, *[0] * 10], np.int32), *[np.zeros(15)] * 3)
    at, told = np.zeros(200, np.int64), boosting.Columns.of(bins)
    for _ in range(3):
        at = told.below(tree, at)
    assert np.array_equal(at, tree.leaf_of(bins))
