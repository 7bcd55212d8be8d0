"""Second-order boosting of regression trees over histograms, with L1, L2, a least gain and a least hessian.

Inputs are cut into at most ``bins`` bins once; after that a row is a few bytes. For each level of a tree the sums of
gradients and hessians by (node, input, bin) decide all splits; of two siblings only the one with fewer rows is counted, the other is
the difference to their parent. A split needs ``min_hessian`` on both sides. When a tree has grown, splits of two
leaves that gain less than ``gamma`` are taken back.

Gradients and hessians are rounded to multiples of 2^-20 before they are summed, in integers: sums are exact, so the trees
do not depend on how the rows are spread over tasks. Rows and inputs of a tree are drawn by hashes.

Up to ``LOCAL_CELLS`` binned values (rows x inputs, one byte each) one task grows all trees, since the sums of a level take
less time than a job or not much more. Beyond that every level is one aggregate over all tasks: the driver gets the sums, at most
one row per (node, input, bin), and the scores of the rows so far are written again every ``STORED_EVERY`` trees.

The result is a gradient-boosted classification model of MLlib, written in its format and loaded from there, so it scores
inside the JVM, joins pipelines and is saved like any other.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from keepwell.params import Boosting
from keepwell.session import settle, shared_folder

SCALE = 1 << 20
LOCAL_CELLS = 1 << 26
#: Share of the rows in one bin from which on an input is summed by its other rows.
USUAL_SHARE = 0.6
STORED_EVERY = 16
BLOCK_ROWS = 1 << 16
LEAST = 1e-6


class Tree(NamedTuple):
    """Nodes as in a heap: the children of i are 2 i + 1 and 2 i + 2. ``column`` is -1 at leaves; rows with a bin up to ``cut`` go left."""

    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of binned inputs."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            column = self.column[at]
            inner = column >= 0
            if not inner.any():
                return at
            right = bins[rows, np.maximum(column, 0)] > self.cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)


def mixed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers, well mixed."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(ids: np.ndarray, share: float, *salts: int) -> np.ndarray:
    """Which ids a hash picks for a share of all."""
    if share >= 1:
        return np.ones(len(ids), bool)
    x = ids.astype(np.uint64)
    for salt in salts:
        x = mixed(x ^ mixed(np.array([salt + 1], np.uint64)))
    return x < np.uint64(int(share * 2**64))


def columns_of_tree(width: int, tree: int, settings: Boosting, seed: int) -> np.ndarray:
    """The inputs that a tree may split by, at least one: those with the least hashes."""
    order = np.argsort(mixed(mixed(np.arange(width, dtype=np.uint64) + np.uint64(1)) ^ mixed(np.array([seed + 7 * tree + 3], np.uint64))), kind="stable")
    return np.sort(order[:max(1, int(width * settings.column_share))])


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted logistic loss, as multiples of 2^-20."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - label) * weight * SCALE), np.rint(np.maximum(p * (1 - p), 1e-16) * weight * SCALE)


def _pull(g, settings: Boosting):
    """The sum of gradients drawn to 0 by L1."""
    return np.sign(g) * np.maximum(np.abs(g) - settings.l1, 0)


def _worth(g, h, settings: Boosting):
    return np.maximum(np.abs(g) - settings.l1, 0) ** 2 / (h + settings.l2)


class Growth:
    """A tree that grows level by level from histograms of its nodes."""

    def __init__(self, settings: Boosting, columns: np.ndarray):
        size = 2 ** (settings.depth + 1) - 1
        self.settings, self.columns = settings, columns
        self.tree = Tree(
            np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        )
        #: Gradient, hessian and rows of every node.
        self.sums = np.zeros((size, 3), np.int64)
        self.known: dict[int, np.ndarray] = {}
        self.level = [0]
        #: Nodes whose histograms are needed next.
        self.wanted = [0]

    def step(self, counted: dict[int, np.ndarray]) -> None:
        """Take the histograms ``(inputs, bins, 3)`` of the wanted nodes and split the level."""
        own = dict(counted)
        for node in self.level:
            if node not in own:
                own[node] = self.known[(node - 1) // 2] - own[node + 1 if node % 2 else node - 1]
        nodes = self.level
        stats = np.stack([own[n] for n in nodes])
        if nodes == [0]:
            self.sums[0] = stats[0, 0].sum(axis=0)
        self.level, self.wanted, self.known = [], [], {}
        if stats.shape[2] < 2:
            return
        below = np.cumsum(stats[:, :, :-1], axis=2)
        left, whole = below[..., :2] / SCALE, (self.sums[nodes][:, :2] / SCALE)[:, None, None, :]
        right = whole - left
        gain = (
            _worth(left[..., 0], left[..., 1], self.settings) + _worth(right[..., 0], right[..., 1], self.settings)
            - _worth(whole[..., 0], whole[..., 1], self.settings)
        )
        gain[(left[..., 1] < self.settings.min_hessian) | (right[..., 1] < self.settings.min_hessian)] = -np.inf
        flat = gain.reshape(len(nodes), -1)
        best = flat.argmax(axis=1)
        for i, node in enumerate(nodes):
            if flat[i, best[i]] > LEAST:
                column, cut = divmod(int(best[i]), gain.shape[2])
                self._split(node, column, cut, float(flat[i, best[i]]), below[i, column, cut], own[node])

    def _split(self, node: int, column: int, cut: int, gain: float, left: np.ndarray, own: np.ndarray) -> None:
        self.tree.column[node], self.tree.cut[node], self.tree.gain[node] = self.columns[column], cut, gain
        sides = (2 * node + 1, 2 * node + 2)
        self.sums[sides[0]], self.sums[sides[1]] = left, self.sums[node] - left
        if 2 * sides[1] >= len(self.tree.column):
            return
        # A side with less than twice the least hessian stays a leaf.
        least = 2 * self.settings.min_hessian * SCALE
        grows = [c for c in sides if self.sums[c, 1] >= least]
        self.level += grows
        if len(grows) == 2:
            self.known[node] = own
            grows = [min(grows, key=lambda c: self.sums[c, 2])]
        self.wanted += grows

    def grown(self) -> Tree:
        """The tree with weak splits taken back, and the values of its leaves."""
        tree = self.tree
        for node in range(len(tree.column) // 2 - 1, -1, -1):
            if tree.column[node] >= 0 and tree.gain[node] < self.settings.gamma and (tree.column[[2 * node + 1, 2 * node + 2]] < 0).all():
                tree.column[node] = -1
        g, h = self.sums[:, 0] / SCALE, self.sums[:, 1] / SCALE
        tree.rows[:] = self.sums[:, 2]
        tree.value[:] = -_pull(g, self.settings) / (h + self.settings.l2 + 1e-300) * self.settings.learning_rate
        return tree


class Block(NamedTuple):
    """Binned rows."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    order: np.ndarray
    margin: np.ndarray

    @classmethod
    def of(cls, row: dict, width: int) -> Block:
        kinds = {"bins": np.uint8, "label": np.float64, "weight": np.float64, "order": np.int64, "margin": np.float64}
        own = {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}
        return cls(own.pop("bins").reshape(-1, width), **own)


class Columns(NamedTuple):
    """Bins input by input. Inputs with one bin in most rows (``usual``) list the other rows in ``rest``, which alone are summed."""

    bins: np.ndarray
    usual: dict[int, int]
    rest: dict[int, np.ndarray]

    @classmethod
    def of(cls, bins: np.ndarray, listed: bool = False) -> Columns:
        turned, usual, rest = np.ascontiguousarray(bins.T), {}, {}
        for i, x in enumerate(turned if listed else []):
            counts = np.bincount(x)
            if len(x) and counts.max() > USUAL_SHARE * len(x):
                usual[i] = int(counts.argmax())
                rest[i] = np.flatnonzero(x != usual[i])
        return cls(turned, usual, rest)

    def below(self, tree: Tree, at: np.ndarray) -> np.ndarray:
        """The child that every row goes to; rows at leaves stay."""
        inner, rows = tree.column >= 0, self.bins.shape[1]
        nodes = np.arange(len(inner))
        # No bin is above 255: a leaf sends no row to the right, and has itself to the left.
        cut = np.where(inner, tree.cut, 255).astype(np.uint8)
        x = self.bins.ravel().take((np.maximum(tree.column, 0).astype(np.int64) * rows).take(at) + np.arange(rows))
        return np.where(inner, 2 * nodes + 1, nodes).take(at) + (x > cut.take(at))


def histograms(
    block: Columns, at: np.ndarray, used: np.ndarray, wanted: list[int], columns: np.ndarray, bins: int, g: np.ndarray, h: np.ndarray
) -> np.ndarray:
    """``(node, input, bin, 3)``: sums of gradients, hessians and rows of the wanted nodes, exact in doubles and then integers."""
    n = len(wanted)
    slot = np.full(max(int(at.max(initial=0)), *wanted) + 1, n, np.int64)
    slot[wanted] = np.arange(n)
    # Rows of other nodes and rows that are not drawn have the place after the last.
    place = slot.take(at)
    place[~used] = n
    rows = np.flatnonzero(place < n)
    first, own = place.take(rows) * bins, (g.take(rows), h.take(rows), None)
    place *= bins
    size = n * bins
    whole = np.stack([np.bincount(first, x, size)[::bins] for x in own], axis=-1)
    out = np.zeros((n, len(columns), bins, 3))
    for i, column in enumerate(columns.tolist()):
        x = block.bins[column]
        if column in block.rest:
            rest = block.rest[column]
            cells = place.take(rest) + x.take(rest).astype(np.int64)
            sums = [np.bincount(cells, y, size + bins)[:size] for y in (g.take(rest), h.take(rest), None)]
            out[:, i] = np.stack(sums, axis=-1).reshape(n, bins, 3)
            out[:, i, block.usual[column]] = whole - out[:, i].sum(axis=1)
        else:
            cells = first + x.take(rows).astype(np.int64)
            out[:, i] = np.stack([np.bincount(cells, y, size) for y in own], axis=-1).reshape(n, bins, 3)
    return out.astype(np.int64)


def _grow_all(block: Block, settings: Boosting, bins: int, seed: int) -> Iterator[Tree]:
    """All trees over rows of one task."""
    margin, told = block.margin.copy(), Columns.of(block.bins, listed=True)
    for number in range(settings.trees):
        g, h = gradients(margin, block.label, block.weight)
        growth = Growth(settings, columns_of_tree(len(told.bins), number, settings, seed))
        used, at = _drawn(block.order, settings.row_share, seed, number), np.zeros(len(margin), np.int64)
        while growth.wanted:
            counted = histograms(told, at, used, growth.wanted, growth.columns, bins, g, h)
            growth.step(dict(zip(growth.wanted, counted)))
            at = told.below(growth.tree, at)
        tree = growth.grown()
        # Rows below a split that was taken back belong to its node.
        leaf = np.arange(len(tree.column))
        for node in range(1, len(leaf)):
            over = leaf[(node - 1) // 2]
            leaf[node] = node if tree.column[over] >= 0 else over
        margin += tree.value[leaf[at]]
        yield tree


def _records(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


_BLOCK = "bins binary, label binary, weight binary, order binary, margin binary"


def cuts_of(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Between neighbouring quantiles of each input, at most ``bins - 1`` cut points. Few distinct values are all told apart."""
    shares = [i / bins for i in range(bins + 1)]
    each = rows.select(F.posexplode(vector_to_array("features")).alias("input", "x"))
    asked = each.groupBy("input").agg(F.percentile_approx("x", shares, 100 * bins).alias("q"))
    # One row per input.
    found = {r["input"]: r["q"] for r in asked.collect()}
    cuts = []
    for i in range(width):
        values = np.unique(np.array([x for x in found.get(i) or [] if x is not None and np.isfinite(x)]))
        middle = (values[:-1] + values[1:]) / 2
        cuts.append(middle[:bins - 1])
    return cuts


def _binned(rows: DataFrame, cuts: list[np.ndarray], label: str, weight: str, order: str) -> DataFrame:
    """Blocks of binned rows."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                values = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                bins = np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
                own = [part.column(k).to_numpy(zero_copy_only=False) for k in ("label", "weight", "order")]
                packed = [bins.tobytes(), *(x.tobytes() for x in own), np.zeros(part.num_rows).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in packed], [c.split()[0] for c in _BLOCK.split(", ")])

    told = rows.select(
        vector_to_array("features").alias("v"), F.col(label).cast("double").alias("label"),
        F.col(weight).cast("double").alias("weight"), F.col(order).cast("long").alias("order"),
    )
    return told.mapInArrow(run, _BLOCK)


def _grow_in_one_task(blocks: DataFrame, width: int, bins: int, settings: Boosting, seed: int) -> list[Tree]:
    def run(batches):
        parts = [Block.of(row, width) for row in _records(batches)]
        if not parts:
            return
        whole = Block(*(np.concatenate([p[k] for p in parts]) for k in range(len(Block._fields))))
        for number, tree in enumerate(_grow_all(whole, settings, bins, seed)):
            packed = [x.astype(np.float64).tobytes() for x in tree]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (np.int32(number), *packed)], ["tree", *Tree._fields])

    fields = ", ".join(f"{f} binary" for f in Tree._fields)
    found = blocks.coalesce(1).mapInArrow(run, f"tree int, {fields}").collect()
    trees = []
    for row in sorted(found, key=lambda r: r["tree"]):
        own = [np.frombuffer(row[f], np.float64) for f in Tree._fields]
        trees.append(Tree(own[0].astype(np.int32), own[1].astype(np.int32), own[2], own[3], own[4].astype(np.int64)))
    return trees


def _grow_by_levels(blocks: DataFrame, width: int, bins: int, settings: Boosting, seed: int) -> list[Tree]:
    """Every level is one aggregate over all blocks."""
    context = blocks.sparkSession.sparkContext
    trees: list[Tree] = []
    fresh: list[Tree] = []

    def with_margins(row: dict, later: list[Tree]) -> Block:
        block = Block.of(row, width)
        margin = block.margin.copy()
        for tree in later:
            margin += tree.value[tree.leaf_of(block.bins)]
        return block._replace(margin=margin)

    for number in range(settings.trees):
        growth = Growth(settings, columns_of_tree(width, number, settings, seed))
        while growth.wanted:
            shared = context.broadcast((list(fresh), growth.tree, growth.wanted, growth.columns))

            def count(batches, number=number, shared=shared):
                later, tree, wanted, columns = shared.value
                total = None
                for row in _records(batches):
                    block = with_margins(row, later)
                    used = _drawn(block.order, settings.row_share, seed, number)
                    g, h = gradients(block.margin, block.label, block.weight)
                    own = histograms(Columns.of(block.bins), tree.leaf_of(block.bins), used, wanted, columns, bins, g, h)
                    total = own if total is None else total + own
                if total is not None:
                    some = np.flatnonzero(total[..., 2].ravel())
                    cells = total.reshape(-1, 3)[some]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, *cells.T.copy())], ["cell", "g", "h", "n"])

            summed = blocks.mapInArrow(count, "cell long, g long, h long, n long").groupBy("cell").agg(
                F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")
            )
            stats = np.zeros((len(growth.wanted) * len(growth.columns) * bins, 3), np.int64)
            for row in summed.collect():
                stats[row["cell"]] = row["g"], row["h"], row["n"]
            growth.step(dict(zip(growth.wanted, stats.reshape(len(growth.wanted), len(growth.columns), bins, 3))))
        trees.append(growth.grown())
        fresh.append(trees[-1])
        if len(fresh) == STORED_EVERY and number + 1 < settings.trees:
            later = context.broadcast(list(fresh))

            def moved(batches, later=later):
                for row in _records(batches):
                    margin = with_margins(row, later.value).margin
                    yield pa.RecordBatch.from_pylist([row | {"margin": margin.tobytes()}])

            blocks = settle(blocks.mapInArrow(moved, _BLOCK))
            fresh.clear()
    return trees


def grow(
    rows: DataFrame, settings: Boosting, seed: int, label: str, weight: str, order: str, local_cells: int = LOCAL_CELLS
) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees, and the cut points of each input. ``rows`` has the vector ``features`` and is stored."""
    first = rows.select("features").first()
    if first is None:
        raise ValueError("no rows to fit on")
    if not 2 <= settings.bins <= 256:
        raise ValueError("between 2 and 256 bins are possible")
    width = len(first["features"])
    cuts = cuts_of(rows, width, settings.bins)
    bins = max(map(len, cuts)) + 1
    blocks = settle(_binned(rows, cuts, label, weight, order))
    held = blocks.agg(F.coalesce(F.sum(F.octet_length("bins")), F.lit(0))).first()[0]
    how = _grow_in_one_task if held <= local_cells else _grow_by_levels
    return how(blocks, width, bins, settings, seed), cuts


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT),
]))])


def _nodes(number: int, tree: Tree, cuts: list[np.ndarray]) -> Iterator[tuple]:
    """The reachable nodes, children after their parents. MLlib scores ``1 / (1 + exp(-2 m))``, so leaves have half of their value."""
    ids, order = {0: 0}, [0]
    for node in order:
        if tree.column[node] >= 0:
            for child in (2 * node + 1, 2 * node + 2):
                ids[child] = len(ids)
                order.append(child)
    for node in order:
        column, rows = int(tree.column[node]), max(int(tree.rows[node]), 1)
        inner = column >= 0
        # Importances are gain times count: the gain of the split as a whole.
        yield number, {
            "id": ids[node], "prediction": float(tree.value[node]) / 2, "impurity": 0.0, "impurityStats": [float(rows), 0.0, 0.0],
            "rawCount": rows, "gain": float(tree.gain[node]) / rows if inner else -1.0,
            "leftChild": ids[2 * node + 1] if inner else -1, "rightChild": ids[2 * node + 2] if inner else -1,
            "split": {
                "featureIndex": column, "leftCategoriesOrThreshold": [float(cuts[column][tree.cut[node]])] if inner else [],
                "numCategories": -1,
            },
        }


def as_model(spark, trees: list[Tree], cuts: list[np.ndarray], depth: int) -> GBTClassificationModel:
    """The trees as a model of MLlib, by way of its files."""
    path = f"{shared_folder(spark)}/boosted-{uuid.uuid4().hex}"
    stamp = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {"impurity": "variance"}}
    whole = stamp | {
        "class": "org.apache.spark.ml.classification.GBTClassificationModel", "uid": f"boosted_{uuid.uuid4().hex[:12]}",
        "paramMap": {"maxDepth": depth, "maxIter": len(trees)}, "numFeatures": len(cuts), "numTrees": len(trees),
    }
    each = [
        stamp | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"{whole['uid']}_{i}", "paramMap": {"maxDepth": depth}}
        for i in range(len(trees))
    ]
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(i, json.dumps(e), 1.0) for i, e in enumerate(each)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    listed = zip(*(n for i, t in enumerate(trees) for n in _nodes(i, t, cuts)))
    # By way of Arrow: these are some ten thousands of nested rows.
    nodes = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(listed, _NODE.types)], _NODE.names)
    spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_boosted(
    rows: DataFrame, settings: Boosting = Boosting(), seed: int = 245573, label: str = "churn_label", weight: str = "_weight",
    order: str = "_order", local_cells: int = LOCAL_CELLS,
) -> GBTClassificationModel:
    """Boost over the vectors ``features`` with 0/1 labels and row weights. ``order`` is a long by which rows are drawn."""
    trees, cuts = grow(rows, settings, seed, label, weight, order, local_cells)
    return as_model(rows.sparkSession, trees, cuts, settings.depth)
