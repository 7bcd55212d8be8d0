"""Texts as bytes in NumPy arrays: blocks of bounded size, words as one Arrow array, ragged copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 8 << 20


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more for the end). A null text has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(batches: Iterator, column: str = "text", limit: int = BLOCK_BYTES, rows: int = 4096) -> Iterator:
    """Arrow batches cut so that the texts of a piece have at most ``limit`` bytes; a longer text is a piece of its own."""
    for batch in batches:
        _, ends = buffer_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            until = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            until = min(max(until, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, until - at)
            at = until


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``starts[i], starts[i] + 1, ...``, ``counts[i]`` of them, for every i in a row."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total, dtype=np.int64)


def words_of_bytes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, shown: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as one binary array, and the byte at which each starts.

    ``inside`` tells for each of the 256 byte values whether it belongs to a word, ``shown`` which byte stands for it
    there. A word ends with its text.
    """
    member = inside[data]
    first = member.copy()
    first[1:] &= ~member[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = member[begins]
    starts = np.flatnonzero(first)
    packed = shown[data[member]]
    at = np.zeros(len(starts) + 1, np.int32)
    if len(starts):
        at[:-1] = (np.cumsum(member, dtype=np.int32)[starts] - 1)
        at[-1] = len(packed)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)]), starts


def small_letters() -> np.ndarray:
    """Every byte as it is, A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table
