"""SimHash near-duplicates by a Gray-order hierarchical index.

A fingerprint has 64 bits. Two of them link when at most ``MAX_BITS`` bits differ, and linked fingerprints
form components.

* **Tables.** The bits are cut into ``BLOCKS`` blocks; linked fingerprints agree on at least
  ``BLOCKS - MAX_BITS`` whole blocks. There is one table for every choice of so many blocks. The chosen bits are the
  top node of an index: a pattern that the whole group shares, with no difference on it.
* **Gray order.** Within a group the fingerprints are sorted by the Gray rank of the other bits, so that neighbours
  share most of them. Runs of ``LEAF`` fingerprints are leaves, runs of ``LEAF`` nodes are the nodes above. Each node
  holds the bits that all its fingerprints agree on.
* **Search.** The index is joined with itself from the top. A pair of nodes carries the differences on bits that both
  sides share; once they exceed ``MAX_BITS`` the pair is dropped with everything below it.
* **Hot groups.** A group of more than ``GROUP`` fingerprints is dealt into chunks, and every pair of chunks is a group
  of its own, so that a task never holds more than two chunks. No pair is lost.
* **Links out.** A group returns at most one link per fingerprint (to the least of its local component), never all pairs.

Equal fingerprints are one row before any of this, so copies cost nothing.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.llm.components import components
from keepwell.llm.shared import arrays, change_points, pieces, shingle_hashes, stored

WIDTH = 4
MAX_BITS = 4
BLOCKS = 6
LEAF = 32
GROUP = 16_384


def simhash(text: bytes | None, width: int = WIDTH) -> int:
    """Unsigned fingerprint: a bit is 1 if it is set in over half the shingle hashes; 0 without words."""
    hashes = shingle_hashes(text or b"", width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(hashes)))


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, text_hash, bits)`` for every row of documents; a null text counts as empty."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text")).alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )

    def run(batches):
        for batch in pieces(batches):
            bits = np.array([simhash(t, width) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(bits.view(np.int64))],
                ["doc_id", "text_hash", "bits"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, bits long")


def gray_rank(bits: Column) -> Column:
    """The place of a 64-bit pattern in the reflected Gray order, shifted so that signed order is right."""
    for step in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, step))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks, as signed numbers."""
    if blocks <= max_bits:
        raise ValueError("more blocks than differing bits are needed")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(single, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the components of each ``a[i]`` and ``b[i]``; a label is the least row of its component."""
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            lower = labels[labels]
            if (lower == labels).all():
                break
            labels = lower
    return labels


def _levels(bits: np.ndarray, leaf: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first row or child, shared bits, pattern) per node, leaves first, up to a single node."""
    low = high = bits
    levels = []
    while True:
        first = np.arange(0, len(low), leaf)
        low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
        levels.append((first, ~(low ^ high), low))
        if len(first) == 1:
            return levels


def _node_pairs(levels: list, leaf: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves (a <= b) that the differences on shared bits do not rule out."""
    a = b = np.zeros(1, np.int64)
    seen, apart = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    offsets = np.arange(leaf)
    for depth in range(len(levels) - 1, -1, -1):
        _, shared, pattern = levels[depth]
        if depth < len(levels) - 1:
            size = len(shared)
            left = (a[:, None] * leaf + offsets).repeat(leaf, axis=1).ravel()
            right = np.tile(b[:, None] * leaf + offsets, (1, leaf)).ravel()
            up = np.arange(len(a)).repeat(leaf * leaf)
            fits = (left < size) & (right < size) & (left <= right)
            a, b, up = left[fits], right[fits], up[fits]
            seen, apart = seen[up], apart[up]
        both = shared[a] & shared[b]
        # Only bits that became shared on this level add to the differences carried down.
        apart = apart + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~seen)
        near = apart <= max_bits
        a, b, seen, apart = a[near], b[near], both[near], apart[near]
    return a, b


def group_labels(bits: np.ndarray, max_bits: int = MAX_BITS, leaf: int = LEAF) -> np.ndarray:
    """For Gray-ordered fingerprints of one group, the least row of each row's component."""
    labels = np.arange(len(bits))
    levels = _levels(bits, leaf)
    left, right = _node_pairs(levels, leaf, max_bits)
    # Near leaves first: they join most rows, and whole pairs of leaves then need no look.
    order = np.argsort(right - left, kind="stable")
    left, right = left[order], right[order]
    offsets = np.arange(leaf)
    for at in range(0, len(left), 1024):
        a, b = left[at:at + 1024], right[at:at + 1024]
        ends = np.minimum(levels[0][0] + leaf, len(bits))
        low = np.minimum.reduceat(labels, levels[0][0])
        uniform = low == np.maximum.reduceat(labels, levels[0][0])
        todo = ~(uniform[a] & uniform[b] & (low[a] == low[b]))
        a, b = a[todo], b[todo]
        rows_a, rows_b = a[:, None] * leaf + offsets, b[:, None] * leaf + offsets
        fits = (rows_a < ends[a][:, None])[:, :, None] & (rows_b < ends[b][:, None])[:, None, :]
        safe_a, safe_b = np.minimum(rows_a, len(bits) - 1), np.minimum(rows_b, len(bits) - 1)
        near = np.bitwise_count(bits[safe_a][:, :, None] ^ bits[safe_b][:, None, :]) <= max_bits
        pair, i, j = np.nonzero(near & fits)
        labels = _merge(labels, safe_a[pair, i], safe_b[pair, j])
    return labels


def _links_of_groups(starts: np.ndarray, bits: np.ndarray, max_bits: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole groups that begin at ``starts``: small ones all at once, larger ones by the index."""
    sizes = np.diff(np.append(starts, len(bits)))
    labels = np.arange(len(bits))
    group = np.repeat(np.arange(len(starts)), np.where(sizes <= leaf, sizes, 0))
    rows = np.flatnonzero(np.repeat(sizes <= leaf, sizes))
    last = (starts + sizes)[group]
    a_all, b_all = [], []
    for step in range(1, leaf):
        inside = rows + step < last
        rows, last = rows[inside], last[inside]
        if not len(rows):
            break
        near = np.bitwise_count(bits[rows] ^ bits[rows + step]) <= max_bits
        a_all.append(rows[near])
        b_all.append(rows[near] + step)
    if a_all:
        labels = _merge(labels, np.concatenate(a_all), np.concatenate(b_all))
    for k in np.flatnonzero(sizes > leaf):
        at, end = starts[k], starts[k] + sizes[k]
        labels[at:end] = at + group_labels(bits[at:end], max_bits, leaf)
    linked = np.flatnonzero(labels != np.arange(len(bits)))
    return linked, labels[linked]


def _index_join(max_bits: int, leaf: int, at_once: int = 131_072):
    """Links of the groups of a partition that is sorted by group and Gray rank; holds whole groups only."""

    def run(batches):
        held: list[list[np.ndarray]] = []
        waiting = 0

        def found(parts, whole):
            columns = [np.concatenate(c) for c in zip(*parts)]
            starts = change_points(*columns[:4])
            cut = len(columns[0]) if whole else starts[-1]
            bits = columns[4][:cut].view(np.uint64)
            a, b = _links_of_groups(starts[starts < cut], bits, max_bits, leaf)
            links = pa.RecordBatch.from_arrays(
                [pa.array(bits[a].view(np.int64)), pa.array(bits[b].view(np.int64))], ["a", "b"]
            )
            return links, [c[cut:] for c in columns]

        for columns in arrays(batches, "mask", "key", "low", "high", "bits"):
            held.append(columns)
            waiting += len(columns[0])
            if waiting >= at_once:
                links, rest = found(held, whole=False)
                yield links
                held, waiting = [rest], len(rest[0])
        if waiting:
            yield found(held, whole=True)[0]

    return run


def links_between(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """Links ``(a, b)`` that span every component of distinct fingerprints ``bits``."""
    masks = block_masks(blocks, max_bits)
    keyed = distinct.select("bits", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
        "mask", F.col("bits").bitwiseAND(F.col("mask")).alias("key"), "bits"
    )
    hot = stored(
        keyed.groupBy("mask", "key").count().filter(F.col("count") > group)
        .select("mask", "key", F.ceil(F.col("count") / group).cast("int").alias("chunks")), "hot",
    )
    chunks = F.coalesce("chunks", F.lit(1))
    mine = F.pmod(F.xxhash64("bits"), chunks).cast("int")
    spread = (
        keyed.join(hot, ["mask", "key"], "left")
        .select("mask", "key", "bits", mine.alias("mine"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .select("mask", "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "bits")
    )
    free = F.col("bits").bitwiseAND(F.bitwise_not("mask"))
    place = ["mask", "key", "low", "high"]
    ordered = spread.repartition(*place).sortWithinPartitions(*place, gray_rank(free))
    return ordered.mapInArrow(_index_join(max_bits, LEAF), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Class of every row of documents ``(doc_id, text)``: ``doc_id, text_hash, bits, component_id, first_hash``.

    ``component_id`` is the smallest doc_id of the component, ``first_hash`` the smallest hash of the texts that carry
    it. A null or blank text has fingerprint zero and links like any other. Rows that repeat are all returned; null
    doc_ids are passed over by the minimum, and a component without a doc_id has a null id. An empty table gives
    an empty one. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, width), "simhash")
    # Nulls last, so that a doc_id wins over none.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    distinct = stored(prints.groupBy("bits").agg(first), "distinct")
    member = components(links_between(distinct, max_bits, blocks))
    whole = stored(distinct.join(member, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    ), "whole")
    # Both sides of the joins are stored, so that a component or fingerprint with very many rows can be split.
    named = stored(whole.groupBy("root").agg(F.min("first").alias("class")), "named")
    classes = stored(whole.join(named, "root").select(
        "bits", F.col("class.doc_id").alias("component_id"), F.col("class.text_hash").alias("first_hash")
    ), "classes")
    return prints.join(classes, "bits")


def keep_first(docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents with one row of every component: the smallest doc_id, of its rows the smallest text hash, once."""
    stays = (
        near_duplicates(docs, width, max_bits)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash")))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    packed = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_text")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    return (
        packed.join(stays, same, "left_semi").dropDuplicates(["_doc", "_text"]).select("_row.*")
    )
