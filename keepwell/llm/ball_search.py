"""Ranked lexical search: exact inner products by sparse ball trees.

A document is a sparse vector over the terms of the queries, its entry for a term the saturated frequency
``(10^9 tf) div (1000 tf + 8 m)`` times the term's weight; a query counts its terms. The score is their inner product, in
64-bit integers.

1. Queries come in blocks of bounded size; the terms of a block are broadcast. One pass over the documents stores the
   frequencies of these terms and the length of every document.
2. Document counts and lengths are aggregated from the stored table; the driver gets one number per term of the block.
3. Every task builds ball trees over at most ``TREE_ROWS`` documents each: a node has a centroid c and a radius R, its children are
   halves along the line between two far members. For a query q no member scores more than ``q.c + |q| R``. Nodes are visited
   best-first until no bound reaches the score that is needed, and leaves are scored exactly in integers.
4. The ten best of each tree are merged in steps of bounded groups.

**Safe rounding.** Centroids are kept in single precision and then taken as exact centres. Squared distances get an allowance for
cancellation before the root, bounds one for the sum, both upwards, and a node is left out only if its bound is strictly
less than the score needed, so ties are never lost. The best scores within a bounded sample of documents
start the search; they are scores of real documents, so they cannot cut off a result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.shared import stored, top_rows
from keepwell.llm.spans import blocks, buffer_of, ragged, small_letters, words_of_bytes

TOP = 10
#: Bounds of a block of queries, of a tree, of a leaf, and of the sample that starts the search.
BLOCK_TERMS = 20_000
BLOCK_BYTES = 1 << 22
TREE_ROWS = 8192
TREE_ENTRIES = 1 << 20
LEAF_ROWS = 64
SAMPLE_ROWS = 4096

_SMALL = small_letters()
_INSIDE = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z"), ("\x80", "\xff")):
    _INSIDE[ord(_first):ord(_last) + 1] = True


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in a row, and the text that each is from."""
    data, offsets = buffer_of(texts)
    found, starts = words_of_bytes(data, offsets, _INSIDE, _SMALL)
    return found, np.searchsorted(offsets, starts, "right") - 1


def _query_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of ``(item_id, {term: count})``; an item too long for a block is one by itself. Items without a term are left out."""
    def run(batches):
        for batch in blocks(batches):
            found, row = terms(batch.column("text"))
            counts = np.bincount(row, minlength=batch.num_rows)
            at = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.ListArray.from_arrays(pa.array(at), found)], ["item_id", "terms"])

    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    block, size, volume = [], 0, 0
    for row in rows.mapInArrow(run, f"item_id {kind}, terms array<binary>").toLocalIterator():
        counts = Counter(map(bytes, row.terms))
        own = sum(map(len, counts))
        if block and (size + len(counts) > BLOCK_TERMS or volume + own > BLOCK_BYTES):
            yield block
            block, size, volume = [], 0, 0
        if counts:
            block.append((row.item_id, counts))
            size, volume = size + len(counts), volume + own
    if block:
        yield block


def _frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tf`` of every document with a term: its length, and how often it holds the terms of the block."""
    def run(batches):
        known = pa.array(vocabulary.value, pa.binary())
        size = max(len(known), 1)
        for batch in blocks(batches):
            found, row = terms(batch.column("text"))
            lengths = np.bincount(row, minlength=batch.num_rows)
            ids = pc.index_in(found, value_set=known)
            hit = ids.is_valid().to_numpy(zero_copy_only=False)
            keys = row[hit] * size + ids.drop_null().to_numpy()
            entries, tf = np.unique(keys, return_counts=True)
            worded = np.flatnonzero(lengths)
            at = np.searchsorted(entries, np.append(worded, batch.num_rows) * size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(worded)), pa.array(lengths[worded].astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(at), pa.array((entries % size).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(tf.astype(np.int64)))],
                ["doc_id", "n", "terms", "tf"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


class BallTree:
    """Ball tree over the rows of a sparse matrix of integers, for exact searches by inner product."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF_ROWS):
        """Row i has the entries ``rows[i]`` to ``rows[i + 1]``, at least one."""
        self.rows, self.columns, self.values, self.width, self.leaf = rows, columns, values, width, leaf
        self.floats = values.astype(np.float64)
        self.squares = np.add.reduceat(self.floats * self.floats, rows[:-1]) if len(rows) > 1 else np.empty(0)
        self.order = np.arange(len(rows) - 1)
        self.nodes: list[tuple[int, int, int, int]] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self._grow()
        # Rows in the order of the leaves, so that a leaf is a slice.
        counts = np.diff(rows)[self.order]
        taken = ragged(rows[:-1][self.order], counts)
        self.columns, self.values = columns[taken], values[taken]
        self.rows = np.concatenate(([0], np.cumsum(counts)))

    def _products(self, members: np.ndarray, vector: np.ndarray) -> np.ndarray:
        counts = self.rows[members + 1] - self.rows[members]
        taken = ragged(self.rows[members], counts)
        return np.add.reduceat(self.floats[taken] * vector[self.columns[taken]], np.cumsum(counts) - counts)

    def _dense(self, member: int) -> np.ndarray:
        out = np.zeros(self.width)
        own = slice(self.rows[member], self.rows[member + 1])
        out[self.columns[own]] = self.floats[own]
        return out

    def _grow(self) -> None:
        waiting = [(0, len(self.order), -1, 0)]
        while waiting:
            first, last, parent, side = waiting.pop()
            members = self.order[first:last]
            taken = ragged(self.rows[members], self.rows[members + 1] - self.rows[members])
            centre = (np.bincount(self.columns[taken], self.floats[taken], self.width) / max(len(members), 1)).astype(np.float32)
            exact = centre.astype(np.float64)
            own = float(exact @ exact)
            distances = self.squares[members] - 2 * self._products(members, exact) + own if len(members) else np.zeros(1)
            allowance = 1e-9 * (float(self.squares[members].max(initial=0)) + own)
            number = len(self.nodes)
            self.centres.append(centre)
            self.radii.append(math.sqrt(max(float(distances.max()), 0.0) + allowance) * (1 + 1e-9))
            self.nodes.append((first, last, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, number, right) if side == 0 else (a, b, left, number)
            if last - first <= self.leaf:
                continue
            far = members[int(np.argmax(distances))]
            towards = self._dense(far)
            other = members[int(np.argmax(self.squares[members] - 2 * self._products(members, towards)))]
            along = self._products(members, towards - self._dense(other))
            half = len(members) // 2
            self.order[first:last] = members[np.argpartition(along, half)]
            waiting += [(first, first + half, number, 0), (first + half, last, number, 1)]

    def search(self, ids: np.ndarray, counts: np.ndarray, needed: int, top: int, names: list) -> list[tuple[int, int]]:
        """``(score, row)`` of the ``top`` rows that score ``needed`` at least and more than 0, ties by name.

        ``ids`` and ``counts`` are the entries of the query, ``names`` sort keys of the rows.
        """
        if not len(self.order):
            return []
        query = np.zeros(self.width, np.int64)
        query[ids] = counts
        weights = counts.astype(np.float64)
        norm = math.sqrt(float(weights @ weights)) * (1 + 1e-9)
        needed = max(needed, 1)

        def bound(node: int) -> float:
            return (float(self.centres[node][ids].astype(np.float64) @ weights) + norm * self.radii[node]) * (1 + 1e-9) + 1

        # The worst of the best rows is the first of the heap: least score, then greatest name.
        best: list[tuple] = []
        waiting = [(-bound(0), 0)]
        while waiting and -waiting[0][0] >= needed:
            _, node = heapq.heappop(waiting)
            first, last, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if (most := bound(child)) >= needed:
                        heapq.heappush(waiting, (-most, child))
                continue
            a, b = self.rows[first], self.rows[last]
            scores = np.add.reduceat(self.values[a:b] * query[self.columns[a:b]], self.rows[first:last] - a)
            for at in np.flatnonzero(scores >= needed).tolist():
                row = int(self.order[first + at])
                entry = (int(scores[at]), _Last(names[row]), row)
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif best[0] < entry:
                    heapq.heapreplace(best, entry)
                if len(best) == top:
                    needed = max(needed, best[0][0])
        return [(score, row) for score, _, row in best]


class _Last:
    """A name that counts as less when it is greater."""

    __slots__ = ("name",)

    def __init__(self, name):
        self.name = name

    def __lt__(self, other: _Last) -> bool:
        return other.name < self.name

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Last) and other.name == self.name


def _forest(rows: DataFrame, shared, top: int) -> DataFrame:
    """``item, doc_id, score``: the best of each tree over the stored frequencies."""
    def run(batches):
        queries, weights, documents, terms_of_all, needed = shared.value
        ids = [np.array([t for t, _ in q], np.int64) for q in queries]
        counts = [np.array([c for _, c in q], np.int64) for q in queries]

        def searched(held):
            docs = [d for b in held for d in b.column("doc_id").to_pylist()]
            length = np.concatenate([b.column("n").to_numpy() for b in held])
            sizes = np.concatenate([pc.list_value_length(b.column("terms")).to_numpy() for b in held]).astype(np.int64)
            columns = np.concatenate([b.column("terms").flatten().to_numpy() for b in held]).astype(np.int64)
            tf = np.concatenate([b.column("tf").flatten().to_numpy() for b in held])
            m = 25 + 75 * length * documents // terms_of_all
            values = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)) * weights[columns]
            tree = BallTree(np.concatenate(([0], np.cumsum(sizes))), columns, values, len(weights))
            names = [(d is None, d or 0) for d in docs]
            out = [
                (item, docs[row], score)
                for item in range(len(queries))
                for score, row in tree.search(ids[item], counts[item], int(needed[item]), top, names)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int32(), pa.int64(), pa.int64()))],
                ["item", "doc_id", "score"],
            )

        held, size, entries = [], 0, 0
        for batch in batches:
            at = 0
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                until = int(np.searchsorted(ends, before + TREE_ENTRIES - entries, "right"))
                until = min(max(until, at + (not held)), at + TREE_ROWS - size, batch.num_rows)
                if until > at:
                    held.append(batch.slice(at, until - at))
                    size, entries = size + until - at, entries + int(ends[until - 1]) - before
                    at = until
                if at < batch.num_rows:
                    yield searched(held)
                    held, size, entries = [], 0, 0
        if held:
            yield searched(held)

    return rows.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0, ties by doc_id.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. A null text has no terms; such an item finds nothing. Repeated
    rows are documents or items of their own, null doc_ids come last among ties. Other columns are ignored. Empty tables,
    and documents without any term, give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    results = []
    for block in _query_blocks(items):
        vocabulary = sorted({t for _, counts in block for t in counts})
        number = {t: i for i, t in enumerate(vocabulary)}
        queries = [[(number[t], c) for t, c in counts.items()] for _, counts in block]
        rows = stored(_frequencies(docs, spark.sparkContext.broadcast(vocabulary)), "frequencies")
        documents, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            return spark.createDataFrame([], _result_schema(items))
        holders = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in holders:
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        rows = rows.filter(F.size("terms") > 0)

        def best(of: DataFrame, needed: list[int], trees: int) -> DataFrame:
            shared = spark.sparkContext.broadcast((queries, weights, documents, length, needed))
            order = [F.desc("score"), F.asc_nulls_last("doc_id")]
            return top_rows(_forest(of, shared, top), ["item"], order, top, trees)

        share = max(documents // SAMPLE_ROWS, 1)
        needed = [1] * len(block)
        if share > 1:
            sample = rows.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(share)) == 0)
            # A score for each item that ``top`` rows of the sample reach.
            for item, score in best(sample, needed, 4).filter(F.col("rank") == top).select("item", "score").collect():
                needed[item] = score
        found = best(rows, needed, documents // 1024 + 1)
        names = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        results.append(stored(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not results:
        return spark.createDataFrame([], _result_schema(items))
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out


def _result_schema(items: DataFrame) -> str:
    return f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
