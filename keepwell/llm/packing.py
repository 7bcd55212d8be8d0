"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

**Tokens.** A text is cut before every space that a character other than white space follows; the tokenizer's pattern always
starts a word there, so such a chunk has the same tokens wherever it stands. Each distinct chunk of a block of texts
is encoded once, and the ids of the texts are copied together from those of their chunks. Chunks are encoded by byte-pair
ranks taken from the tokenizer's file; a text that holds a special token is given to the tokenizers library as a whole.

**Placing.** Whole windows are cut off a document first. What remains, of length s, is placed online: ``counts[h]`` is the
number of open windows filled to level h, and the piece goes to that level h (0 is a new window) for which the sum
of the squared counts is least after the move from h to h + s. Full windows leave the level array. Ties go to the fullest level.

**Closing.** A task holds at most ``max_open`` open windows. When it has more, and at its end, it closes them: pieces of the
emptiest are cut to fill up the fullest, so that one window at most is left with padding.

Every task packs its own rows: nothing is shuffled, and memory is bounded by a block of texts and the open windows. Sequence
ids are the partition in the upper bits and a running number below, so a repeated task writes the same ids.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from keepwell.llm.bpe import PATTERN, byte_alphabet
from keepwell.llm.spans import blocks, buffer_of, ragged

WINDOW = 1024
MAX_OPEN = 4096
#: First bytes of characters that are surely no white space: ASCII signs, and leads of blocks without any.
_SOLID = np.zeros(256, bool)
for _first, _last in ((0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xEE), (0xF0, 0xF4)):
    _SOLID[_first:_last + 1] = True


def byte_pair_ranks(described: dict) -> dict[bytes, int]:
    """Token to id. Ids must follow the order of the merges, so that the least id is the earliest merge."""
    model, alphabet = described["model"], byte_alphabet()
    if model["type"] != "BPE" or described["normalizer"] or described["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("a byte-level BPE without a normalizer and prefix space is needed")
    special = {t["content"] for t in described["added_tokens"]}
    ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])) or made and made[0] < 256:
        raise ValueError("ids do not follow the order of the merges")
    return ranks


class ChunkEncoder:
    """Ids of blocks of texts, equal to the tokenizers library without added special tokens."""

    def __init__(self, described: str):
        parsed = json.loads(described)
        ranks = byte_pair_ranks(parsed)
        self.library = Tokenizer.from_str(described)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def _ids(self, text: bytes) -> np.ndarray:
        return self.ranks.encode_to_numpy(text.decode(), disallowed_special=()).astype(np.uint32)

    def _of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks in a row, and where those of each begin."""
        data, at = buffer_of(chunks)
        size = np.diff(at)
        joined = np.zeros(len(chunks), bool)
        long = np.flatnonzero(size > 1)
        joined[long] = (data[at[long]] == 0x20) & _SOLID[data[at[long] + 1]]
        together = np.flatnonzero(joined)
        ids = self._ids(data[ragged(at[together], size[together])].tobytes())
        ends = np.cumsum(self.size[ids])
        cuts = np.searchsorted(ends, np.cumsum(size[together]), "left") + 1
        if len(together) and not np.array_equal(ends[cuts - 1], np.cumsum(size[together])):
            raise ValueError("a token crosses the bounds of chunks")
        counts = np.zeros(len(chunks), np.int64)
        counts[together] = np.diff(cuts, prepend=0)
        others = np.flatnonzero(~joined)
        apart = [self._ids(data[at[i]:at[i + 1]].tobytes()) for i in others]
        counts[others] = [len(x) for x in apart]
        begins = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(begins[-1], np.uint32)
        out[ragged(begins[together], counts[together])] = ids
        for i, own in zip(others, apart):
            out[begins[i]:begins[i + 1]] = own
        return out, begins

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        texts = texts.fill_null("")
        whole = {}
        for content in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, content).to_numpy(zero_copy_only=False)).tolist():
                whole[i] = None
        for i in whole:
            whole[i] = np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        data, offsets = buffer_of(texts)
        mark = np.zeros(len(data) + 1, bool)
        mark[:-2] = (data[:-1] == 0x20) & _SOLID[data[1:]] if len(data) else False
        mark[offsets] = True
        starts = np.flatnonzero(mark[:-1])
        at = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        ids, begins = self._of_chunks(coded.dictionary)
        index = coded.indices.to_numpy()
        counts = np.diff(begins)[index]
        joined = ids[ragged(begins[index], counts)]
        ends = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, offsets)]
        return [whole.get(i, joined[ends[i]:ends[i + 1]]) for i in range(len(texts))]


class Piece(NamedTuple):
    """Tokens ``start`` to ``start + len(ids)`` of a document of ``total`` tokens."""

    doc: int | None
    start: int
    ids: np.ndarray
    total: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:length]), self._replace(start=self.start + length, ids=self.ids[length:])


class Packer:
    """Open windows by fill level; ``add`` and ``close`` give the windows that are done."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        if window < 2 or max_open < 1:
            raise ValueError("a window holds two tokens at least, and one window may be open")
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.open = 0

    def best_level(self, length: int) -> int:
        """The level for which the squared counts of open windows grow least; of equal ones the fullest."""
        last = self.window - length
        levels = np.append(0, np.flatnonzero(self.counts[:last + 1]))
        grown = 2 * (self.counts[levels + length] - self.counts[levels]) + (levels > 0) + (levels < last)
        return int(levels[len(levels) - 1 - np.argmin(grown[::-1])])

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.window:
            whole, piece = piece.cut(self.window)
            yield [whole]
        length = len(piece.ids)
        if not length:
            return
        level = self.best_level(length)
        if level:
            held = self.at[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            held = []
        held.append(piece)
        if level + length == self.window:
            yield held
            return
        self.at[level + length].append(held)
        self.counts[level + length] += 1
        self.open += 1
        if self.open >= self.max_open:
            yield from self.close()

    def close(self) -> Iterator[list[Piece]]:
        """All open windows, the emptiest cut up to fill the fullest."""
        held = [(level, pieces) for level in range(self.window - 1, 0, -1) for pieces in self.at[level]]
        self.counts[:] = 0
        self.at = [[] for _ in range(self.window + 1)]
        self.open = 0
        first, last = 0, len(held) - 1
        while first <= last:
            level, pieces = held[first]
            while level < self.window and first < last:
                given = held[last][1]
                piece = given.pop()
                room = self.window - level
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    given.append(rest)
                pieces.append(piece)
                level += len(piece.ids)
                if not given:
                    last -= 1
            yield pieces
            first += 1


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 0, max_open: int = MAX_OPEN
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: the pieces of all documents, each token in one.

    A document's tokens are those of its text and ``end_id`` behind them; ``ids`` are little-endian unsigned 32-bit integers. A null
    text counts as empty and has the one token ``end_id``. Repeated rows and null doc_ids are documents of their own;
    other columns are ignored; an empty table gives an empty one. ``offset`` counts tokens of the sequence without a gap.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        described = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        encoder, packer = ChunkEncoder(described.value), Packer(window, max_open)
        end, first = np.array([end_id], np.uint32), TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        done = held = 0

        def written(windows):
            nonlocal done, held
            for pieces in windows:
                offset = 0
                for p in pieces:
                    size = len(p.ids)
                    out.append((p.doc, p.start, size, p.ids.astype("<u4").tobytes(), p.total, first + done, offset))
                    offset += size
                done += 1
                held += offset

        def batch():
            nonlocal held
            columns = [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*out))]
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays(columns, names)

        for block in blocks(batches, limit=10 << 20):
            for doc, ids in zip(block.column("doc_id").to_pylist(), encoder(block.column("text"))):
                ids = np.concatenate((ids, end))
                written(packer.add(Piece(doc, 0, ids, len(ids))))
                if held >= 1 << 20:
                    yield batch()
        written(packer.close())
        if out:
            yield batch()

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(run, schema)
