"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

The shingles of a text (five words) are hashed once. The high bits of a hash name one of ``BINS`` bins, and a bin keeps the
least of the rest. An empty bin takes the value of a bin that its own fixed random sequence meets first (optimal
densification), so that two texts fill it alike. ``BITS`` low-order bits of each bin are kept and packed.

Two unequal minima agree in their low bits by chance once in ``2**BITS``; the share of equal bins is corrected for that.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keepwell.llm.shared import pieces, shingle_hashes, stored

WIDTH = 5
BINS = 256
BITS = 4
_TRIES = 4096
#: For every bin the bins that it asks when it is empty, in order.
_ASKED = np.random.Generator(np.random.PCG64(20)).integers(0, BINS, (BINS, _TRIES), dtype=np.uint16)


def densify(values: np.ndarray, full: np.ndarray) -> np.ndarray:
    """``values`` with empty bins filled from full ones; at least one bin must be full."""
    values, empty = values.copy(), np.flatnonzero(~full)
    if full.sum() == 1:
        values[:] = values[full][0]
        return values
    source = values.copy()
    low = 0
    for high in (8, 64, 512, _TRIES):
        if not len(empty):
            return values
        asked = _ASKED[empty, low:high]
        hits = full[asked]
        found = hits.any(axis=1)
        values[empty[found]] = source[asked[found, hits[found].argmax(axis=1)]]
        empty, low = empty[~found], high
    # What all tries missed takes the next full bin.
    at = np.flatnonzero(full)
    values[empty] = source[at[np.searchsorted(at, empty) % len(at)]]
    return values


def fingerprint(text: bytes, width: int = WIDTH) -> bytes:
    """Packed low-order bits of all bins. A text without words has one shingle, the empty one."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        hashes = np.zeros(1, np.uint64)
    ordered = np.sort(hashes)
    bins = (ordered >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    values, full = np.zeros(BINS, np.uint8), np.zeros(BINS, bool)
    values[bins[first]] = (ordered[first] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    full[bins[first]] = True
    values = densify(values, full)
    return ((values[0::2] << BITS) | values[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimate of the share of common shingles, 0 to 1."""
    apart = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    equal = ((apart >> BITS) == 0).sum() + ((apart & ((1 << BITS) - 1)) == 0).sum()
    chance = 0.5**BITS
    return float(min(1.0, max(0.0, (equal / BINS - chance) / (1 - chance))))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_DIGEST = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _row(doc_id, text: str, mine: bytes, following: str, theirs: bytes) -> tuple:
    changed = edited(text, following).encode()
    other = fingerprint(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed).hexdigest(), mine, other, likeness(mine, other), likeness(mine, theirs),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("part", pa.int32()), ("end", pa.string()), ("text", pa.string()),
])


def _walk(batches):
    """Rows of a sorted partition with the next one; the first and the last are given out with their texts."""
    before, part, no_digest = None, None, (None,) * 6
    for batch in pieces(batches):
        out = []
        for part, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))):
            now = (doc_id, text, fingerprint(text.encode()))
            if before is None:
                out.append((doc_id, *no_digest, part, "head", text))
            else:
                out.append((*_row(*before, *now[1:]), part, None, None))
            before = now
        yield _batch(out, _ARROW)
    if before is not None:
        yield _batch([(before[0], *no_digest, part, "tail", before[1])], _ARROW)


def _join_ends(batches):
    for batch in batches:
        names = ("doc_id", "text", "following")
        rows = [
            _row(i, a, fingerprint(a.encode()), b, fingerprint(b.encode()))
            for i, a, b in zip(*(batch.column(c).to_pylist() for c in names))
        ]
        yield _batch(rows, pa.schema(list(_ARROW)[:7]))


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Per row of documents the digest columns of the text, of its edited text and of the next document.

    The next document is the next smaller doc_id, after the last the first; rows with one doc_id follow each other by
    the hash of their text, null doc_ids come last, and a single row follows itself. A null text counts as empty. Other
    columns are ignored; an empty table gives an empty one.

    Rows are range-partitioned and sorted by doc_id, so texts move once; what spans two partitions, one pair for
    each of them, is joined afterwards.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    walked = stored(ranged.mapInArrow(_walk, f"{_DIGEST}, part int, end string, text string"), "minhash")

    heads = walked.filter("end = 'head'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    tails = walked.filter("end = 'tail'").select("part", "doc_id", "text")
    # One number for each partition that has rows.
    around = Window.orderBy("part")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = tails.select(
        "part", F.coalesce(F.lead("part").over(around), F.first("part").over(whole)).alias("next_part")
    )
    pairs = tails.join(after, "part").join(heads, "next_part").select("doc_id", "text", "following")
    inner = walked.filter(F.col("end").isNull()).select(*_COLUMNS)
    return inner.union(pairs.mapInArrow(_join_ends, _DIGEST).select(*_COLUMNS))
