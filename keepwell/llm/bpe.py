"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

**Compilation.** The automaton starts as one state with an arc to itself for each byte. Merges are applied in order, each
by a gadget: for the merge ``(u, v)`` the state that ``u`` leads to is copied without its ``v`` arc, all ``u`` arcs are
led to the copy, and every state with a ``u`` arc gets a ``uv`` arc to where ``v`` led. After the last merge a path
is the encoding of the bytes on it, and every byte string has exactly one path.

All arcs with one label lead to the same state, so a state is named by the token that leads to it. A state's arcs are kept as
what its gadget changed: the arcs cut behind it, with their times, and the state it was copied from, to which a
lookup falls back. So the tables are linear in the number of merges: ``cut_keys`` and ``cut_times`` (state x symbol), ``laid``,
``left`` and ``right``. Looked-up arcs are kept in a table of fixed size, which workers fill as they go.

**Encoding.** A text is cut into chunks before every space with a solid character behind it, where the tokenizer's pattern
always starts a word. The distinct chunks of a block are split by the pattern, and the distinct words of those go
through the automaton together, one byte position of all words at a time. The tokens that end at a position are known from a
trie; of these exactly one is an arc of the state in which it starts, and that decides the state of the position. Nothing
is taken back. The arcs on the way from the end to the start are the encoding.

**Decoding** joins the labels of the arcs and reads the bytes as UTF-8.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.spans import blocks, buffer_of, ragged

#: Pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of texts that are encoded together, and of words that are walked together; arcs that a worker keeps; bytes of a long word.
BLOCK_BYTES = 6 << 20
WALKED_BYTES = 1 << 17
KEPT_ARCS = 1 << 20
LONG_WORD = 96
_NEVER = np.int64(1) << 40
#: First bytes of characters that are surely no white space: ASCII signs, and leads of blocks without any.
SOLID = np.zeros(256, bool)
for _first, _last in ((0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xEE), (0xF0, 0xF4)):
    SOLID[_first:_last + 1] = True


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The compiled tables. An arc is a token and carries its id of the vocabulary; the state behind it has the same name."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.special = special
        labels = {i: t for t, i in vocabulary.items()} | {i: t.encode() for t, i in special.items()}
        size = max(labels) + 1
        #: The labels of all arcs in a row.
        self.label_ends = np.cumsum([len(labels.get(i, b"")) for i in range(size)])
        self.label_bytes = np.frombuffer(b"".join(labels.get(i, b"") for i in range(size)), np.uint8)
        #: When an arc was laid (-1: never), and the arcs it was made of.
        self.laid = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        cut: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {vocabulary[bytes([value])]: (0, 0, 0) for value in range(256)}
        for time, (a, b) in enumerate(merges, 1):
            u, v, joined = vocabulary[a], vocabulary[b], vocabulary[a + b]
            # The gadget changes nothing where no state behind u has the arc v.
            if u in made and v in made and _has_arc(made, cut, u, v):
                if joined in made:
                    raise ValueError(f"two merges make token {joined}")
                made[joined] = (time, u, v)
                cut[u, v] = time
        for token, (time, u, v) in made.items():
            self.laid[token], self.left[token], self.right[token] = time, u, v
        keys = np.array([u << 32 | v for u, v in cut], np.int64)
        order = np.argsort(keys)
        self.cut_keys, self.cut_times = keys[order], np.array(list(cut.values()), np.int64)[order]
        self._trie({labels[t]: t for t in made})

    def _trie(self, arcs: dict[bytes, int]) -> None:
        """Nodes for all beginnings of labels: from a node and a byte to a node, and the arc whose label ends there (-1: none)."""
        number = {b"": 0}
        for label in sorted(arcs):
            for size in range(1, len(label) + 1):
                number.setdefault(label[:size], len(number))
        self.arc = np.full(len(number), -1, np.int64)
        keys = np.empty(len(number) - 1, np.int64)
        to = np.empty(len(number) - 1, np.int64)
        for k, (label, node) in enumerate(list(number.items())[1:]):
            keys[k], to[k] = number[label[:-1]] << 8 | label[-1], node
            self.arc[node] = arcs.get(label, -1)
        order = np.argsort(keys)
        self.steps, self.nodes = keys[order], to[order]
        #: Nodes behind the first two bytes (-1: none).
        self.second = np.full(1 << 16, -1, np.int64)
        for label, node in number.items():
            if len(label) == 2:
                self.second[label[0] << 8 | label[1]] = node
        self.first = np.array([number[bytes([value])] for value in range(256)])

    def has_arc(self, states: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        """Whether each state has the arc.

        A state falls back to the one it was copied from, as it was before the copy; an arc stands for its left part
        before it was laid. The arc is missing if the two were cut apart at such a time.
        """
        out = np.ones(len(states), bool)
        rows = np.arange(len(states))
        u, v = states.astype(np.int64), arcs.astype(np.int64)
        until_u = until_v = np.full(len(rows), _NEVER)
        while len(rows):
            keys = u << 32 | v
            at = np.minimum(np.searchsorted(self.cut_keys, keys), len(self.cut_keys) - 1)
            time = np.where(self.cut_keys[at] == keys, self.cut_times[at], _NEVER) if len(self.cut_keys) else np.full(len(rows), _NEVER)
            gone = (time < until_u) & (time <= until_v)
            out[rows[gone]] = False
            laid_u, laid_v = self.laid[u], self.laid[v]
            on = ~gone & ((laid_u > 0) | (laid_v > 0))
            rows, u, v, laid_u, laid_v, until_u, until_v = (x[on] for x in (rows, u, v, laid_u, laid_v, until_u, until_v))
            back, first = laid_u >= laid_v, laid_v >= laid_u
            until_u, until_v = np.where(back, laid_u, until_u), np.where(first, laid_v, until_v)
            u, v = np.where(back, self.right[u], u), np.where(first, self.left[v], v)
        return out

    def labels(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The labels of the ids in a row, and where each ends."""
        size = np.diff(self.label_ends, prepend=0)[ids]
        return self.label_bytes[ragged(self.label_ends[ids] - size, size)], np.cumsum(size)

    def decode(self, ids) -> str:
        return self.labels(np.asarray(ids, np.int64))[0].tobytes().decode("utf-8", "replace")


def _has_arc(made: dict, cut: dict, u: int, v: int) -> bool:
    """``Automaton.has_arc`` while the automaton grows."""
    until_u = until_v = int(_NEVER)
    while True:
        time = cut.get((u, v))
        if time is not None and time < until_u and time <= until_v:
            return False
        (laid_u, _, right), (laid_v, left, _) = made[u], made[v]
        if not laid_u and not laid_v:
            return True
        if laid_u >= laid_v:
            until_u, u = laid_u, right
        if laid_v >= laid_u:
            until_v, v = laid_v, left


def load(path: str) -> Automaton:
    """Compile the byte-level BPE of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, alphabet = described["model"], byte_alphabet()
    if model["type"] != "BPE" or described["normalizer"] or described["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("a byte-level BPE without a normalizer and prefix space is needed")
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    as_bytes = {t: bytes(map(alphabet.__getitem__, t)) for t in model["vocab"] if t not in special}
    vocabulary = {as_bytes[t]: i for t, i in model["vocab"].items() if t not in special}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return Automaton(vocabulary, [(as_bytes[u], as_bytes[v]) for u, v in pairs], special)


class Encoder:
    """Texts to ids, a block of texts at a time."""

    def __init__(self, automaton: Automaton, kept_arcs: int = KEPT_ARCS):
        self.automaton = automaton
        self.find = regex.compile(PATTERN).findall
        self.keys = np.full(kept_arcs, -1, np.int64)
        self.answers = np.zeros(kept_arcs, bool)
        longest_first = sorted(map(regex.escape, automaton.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(longest_first)})").split if longest_first else None

    def _has_arc(self, states: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        """``Automaton.has_arc`` by the table of arcs that were looked up before."""
        keys = states << 32 | arcs
        place = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % len(self.keys)
        known = self.keys[place] == keys
        out = self.answers[place]
        if not known.all():
            new, back = np.unique(keys[~known], return_inverse=True)
            answers = self.automaton.has_arc(new >> 32, new & 0xFFFFFFFF)
            out[~known] = answers[back]
            self.keys[place[~known]] = keys[~known]
            self.answers[place[~known]] = answers[back]
        return out

    def _matches(self, data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Last byte, length and arc of every place where a label stands; ``left`` is the number of bytes up to the word's end."""
        own = self.automaton
        at = np.arange(len(data))
        out = [(at, np.ones(len(at), np.int64), own.arc[own.first[data]])]
        at, size = at[left > 1], 2
        node = own.second[data[at].astype(np.int64) << 8 | data[at + 1]]
        at, node = at[node >= 0], node[node >= 0]
        while len(at):
            arcs = own.arc[node]
            whole = arcs >= 0
            out.append((at[whole] + size - 1, np.full(int(whole.sum()), size), arcs[whole]))
            on = left[at] > size
            at, node = at[on], node[on]
            keys = node << 8 | data[at + size]
            place = np.minimum(np.searchsorted(own.steps, keys), len(own.steps) - 1)
            found = own.steps[place] == keys
            at, node = at[found], own.nodes[place[found]]
            size += 1
        return tuple(np.concatenate(x) for x in zip(*out))

    def _walk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that lie in a row in ``data``, and where those of each end."""
        size = np.diff(offsets)
        word_start = np.repeat(offsets[:-1], size)
        last, length, arcs = self._matches(data, np.repeat(offsets[1:], size) - np.arange(len(data)))
        # State behind each byte, and how long the arc is that ends there.
        state, taken = np.full(len(data), -1, np.int64), np.zeros(len(data), np.int64)
        place = last - word_start[last]
        order = np.argsort(place, kind="stable")
        last, length, arcs, place = last[order], length[order], arcs[order], place[order]
        bounds = np.searchsorted(place, np.arange(int(size.max(initial=0)) + 1))
        for low, high in zip(bounds, bounds[1:]):
            end, long, arc = last[low:high], length[low:high], arcs[low:high]
            start = end - long + 1
            fits = start == word_start[end]
            inner = np.flatnonzero(~fits)
            fits[inner] = self._has_arc(state[start[inner] - 1], arc[inner])
            state[end[fits]], taken[end[fits]] = arc[fits], long[fits]
        kept = np.zeros(len(data), bool)
        at, first = offsets[1:][size > 0] - 1, offsets[:-1][size > 0]
        while len(at):
            kept[at] = True
            at = at - taken[at]
            on = at >= first
            at, first = at[on], first[on]
        return state[kept], np.concatenate(([0], np.cumsum(kept)))[offsets[1:]]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and where those of each begin (one more for the end)."""
        data, offsets = buffer_of(words)
        size = np.diff(offsets)
        short = np.flatnonzero(size <= LONG_WORD)
        counts = np.zeros(len(words), np.int64)
        ends = np.concatenate(([0], np.cumsum(size[short])))
        found = []
        at = 0
        while at < len(short):
            until = max(int(np.searchsorted(ends, ends[at] + WALKED_BYTES, "right")) - 1, at + 1)
            own = short[at:until]
            part, stops = self._walk(data[ragged(offsets[own], size[own])], ends[at:until + 1] - ends[at])
            counts[own] = np.diff(stops, prepend=0)
            found.append(part)
            at = until
        ids = np.concatenate(found) if found else np.empty(0, np.int64)
        apart = {}
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            apart[i] = self._long_word(data[offsets[i]:offsets[i + 1]].tobytes())
            counts[i] = len(apart[i])
        begins = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(begins[-1], np.uint32)
        out[ragged(begins[short], counts[short])] = ids
        for i, own in apart.items():
            out[begins[i]:begins[i + 1]] = own
        return out, begins

    def _long_word(self, word: bytes) -> np.ndarray:
        """The same walk over one word, byte by byte."""
        data = np.frombuffer(word, np.uint8)
        last, length, arcs = self._matches(data, len(word) - np.arange(len(word)))
        order = np.argsort(last, kind="stable")
        known: dict[tuple[int, int], bool] = {}
        state, taken = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end, size, arc in zip((last[order] + 1).tolist(), length[order].tolist(), arcs[order].tolist()):
            start = end - size
            if start:
                pair = (state[start], arc)
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = bool(self._has_arc(np.array([pair[0]]), np.array([arc]))[0])
                if not fits:
                    continue
            state[end], taken[end] = arc, size
        out, at = [], len(word)
        while at:
            out.append(state[at])
            at -= taken[at]
        return np.array(out[::-1], np.uint32)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks in a row, and where those of each begin."""
        data, at = buffer_of(chunks)
        size = np.diff(at)
        joined = np.zeros(len(chunks), bool)
        long = np.flatnonzero(size > 1)
        joined[long] = (data[at[long]] == 0x20) & SOLID[data[at[long] + 1]]
        # Chunks that begin with a space and a solid character are split together, the others one by one, behind them.
        order = np.concatenate((np.flatnonzero(joined), np.flatnonzero(~joined)))
        together = int(joined.sum())
        words = self.find(data[ragged(at[order[:together]], size[order[:together]])].tobytes().decode())
        for i in order[together:].tolist():
            words += self.find(data[at[i]:at[i + 1]].tobytes().decode())
        coded = pa.array(words, pa.string()).dictionary_encode()
        del words
        ids, begins = self._words(coded.dictionary)
        index = coded.indices.to_numpy()
        ends = np.cumsum(np.diff(buffer_of(coded.dictionary)[1])[index])
        bounds = np.cumsum(size[order])
        cuts = np.searchsorted(ends, bounds, "left") + 1 if len(bounds) else bounds
        if len(bounds) and not np.array_equal(ends[cuts - 1], bounds):
            raise ValueError("a word crosses the bounds of chunks")
        counts = np.diff(begins)[index]
        in_order = ids[ragged(begins[index], counts)]
        stops = np.cumsum(counts)[cuts - 1] if len(cuts) else cuts
        first = np.empty(len(chunks), np.int64)
        total = np.empty(len(chunks), np.int64)
        total[order] = np.diff(stops, prepend=0)
        first[order] = stops - total[order]
        return in_order[ragged(first, total)], np.concatenate(([0], np.cumsum(total)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each begin (one more for the end). A null text has none."""
        texts = texts.fill_null("")
        marked = np.zeros(len(texts), bool)
        for content in self.automaton.special:
            marked |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if marked.any():
            return self._with_special(texts, marked)
        data, offsets = buffer_of(texts)
        mark = np.zeros(len(data) + 1, bool)
        if len(data):
            mark[:-2] = (data[:-1] == 0x20) & SOLID[data[1:]]
        mark[offsets] = True
        starts = np.flatnonzero(mark[:-1])
        at = np.append(starts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        ids, begins = self._chunks(coded.dictionary)
        index = coded.indices.to_numpy()
        counts = np.diff(begins)[index]
        ends = np.concatenate(([0], np.cumsum(counts)))
        return ids[ragged(begins[index], counts)], ends[np.searchsorted(starts, offsets)]

    def _with_special(self, texts: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold special tokens are cut there; the parts between are texts of their own."""
        parts, of = [], []
        for i, text in enumerate(texts.to_pylist()):
            own = self.cut(text) if marked[i] else [text]
            parts += own
            of += [i] * len(own)
        special = np.array([self.automaton.special.get(p, -1) for p in parts], np.int64)
        ids, begins = self(pa.array([p if s < 0 else "" for p, s in zip(parts, special.tolist())], pa.string()))
        counts = np.where(special >= 0, 1, np.diff(begins))
        out = np.empty(int(counts.sum()), np.uint32)
        first = np.cumsum(counts) - counts
        plain = special < 0
        out[ragged(first[plain], counts[plain])] = ids
        out[first[~plain]] = special[~plain]
        ends = np.bincount(np.array(of), counts, len(texts)).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(ends)))


def _packed(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Little-endian unsigned 32-bit integers of each text as binary values."""
    at = (begins * 4).astype(np.int64)
    values = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(ids.astype("<u4"))])
    return values.cast(pa.binary())


def encode(docs: DataFrame, automaton: Automaton, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids of each whole text as the binary column ``ids``; a null text counts as empty.

    Ids are little-endian unsigned 32-bit integers. The automaton is broadcast; its size is that of the vocabulary. Rows
    stay as they are, repeated rows and null doc_ids too; an existing column called ``ids`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    others = [c for c in docs.columns if c != ids]
    schema = docs.select(*others, F.lit(b"").alias(ids)).schema

    def run(batches):
        encoder = Encoder(shared.value)
        for block in blocks(batches, text, BLOCK_BYTES):
            packed = _packed(*encoder(block.column(text)))
            yield pa.RecordBatch.from_arrays([*block.columns, packed], [*block.schema.names, ids])

    return docs.select(*others).mapInArrow(run, schema)


def decode(rows: DataFrame, automaton: Automaton, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of the packed ids as ``text``; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(automaton)
    others = [c for c in rows.columns if c != text]
    schema = rows.select(*others, F.lit("").alias(text)).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [shared.value.decode(np.frombuffer(p or b"", "<u4")) for p in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text])

    return rows.select(*others).mapInArrow(run, schema)


def digests(rows: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded and decoded rows."""
    return rows.select(
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def round_trip(docs: DataFrame, automaton: Automaton, *keep: str, ids: str | None = None) -> DataFrame:
    """The kept columns with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: each text encoded, and its ids decoded again.

    The digests are of the packed ids and of the decoded text in UTF-8. Texts do not leave the task; packed ids do if ``ids``
    names a column for them. A null text counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    told = [F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")]
    schema = rows.select(*keep, *told, *([F.lit(b"").alias(ids)] if ids else [])).schema

    def run(batches):
        encoder = Encoder(shared.value)
        for block in blocks(batches, limit=BLOCK_BYTES):
            found, begins = encoder(block.column("text"))
            packed = found.astype("<u4").tobytes()
            labels, ends = shared.value.labels(found)
            ends = np.concatenate(([0], ends))[begins]
            own, decoded = [], []
            for k in range(block.num_rows):
                own.append(hashlib.sha256(packed[4 * begins[k]:4 * begins[k + 1]]).hexdigest())
                text = labels[ends[k]:ends[k + 1]].tobytes().decode("utf-8", "replace")
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in keep), pa.array(np.diff(begins)), pa.array(own), pa.array(decoded),
                 *([_packed(found, begins)] if ids else [])],
                schema.names,
            )

    return rows.mapInArrow(run, schema)
