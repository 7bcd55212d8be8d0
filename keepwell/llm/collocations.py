"""Collocations of two and three words by weighted acyclic automata.

1. **Shards.** A task takes its texts in blocks. The n-grams of a block and language are sorted, counted, and cut at the bounds of
   prefix ranges. Each slice becomes a weighted acyclic automaton: its arcs are words, the weight of a final state is a count.
   Sorted n-grams with a common prefix are neighbours, so a state is complete when its run ends; it is then looked up in a
   register and shared with an equal state.
2. **Union.** The automata of one prefix range meet in one task and are united, weights of equal paths summed up.
   Paths that weigh less than ``min_count`` are dropped: a phrase occurs no more often than its parts, so
   no candidate and no part of one is lost.
3. **Composition.** The parts of a range's phrases are in other ranges. The range sends each of them an automaton of the parts it asks
   for, once per part, weighted with the greatest count of a longer phrase around it. The owner composes it with its counts and
   sends the product back; the weights tell it which of its phrases lie inside a longer candidate.
4. Scores are exact integers. Every range keeps its first phrases, and these are merged in steps.

Bounds of ranges are split points of n-grams of a bounded sample of documents, about ``SAMPLED`` for each range. They decide how even
the ranges are, never the result. A frequent first word, or pair, is cut into several ranges by the words behind it, and
every n-gram reaches the shuffle once per block. One range, about the n-grams of ``range_bytes`` of text, is held
by a task at a time.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.shared import change_points, stored, top_rows
from keepwell.llm.spans import blocks, buffer_of, ragged, small_letters, words_of_bytes

MIN_COUNT = 10
TOP = 2000
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 6 << 20
#: Documents of the sample at least, split candidates for each range and of one document at most, bytes of a word in a split.
SAMPLE_DOCS = 1000
SAMPLED = 16
SPLIT_BYTES = 48
#: N-grams of a range that are held apart before they are united.
HELD = 1 << 21

_SMALL = small_letters()
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_INSIDE = ~_BREAK
_INSIDE[list(b" \t")] = False
_BITS = 21
_MASK = (1 << _BITS) - 1


class Grams(NamedTuple):
    """Weighted n-grams: ``columns[k]`` is the number of word k + 1 among the sorted ``words``, from 1; 0 is no word. Rows are sorted."""

    words: pa.Array
    columns: tuple[np.ndarray, np.ndarray, np.ndarray]
    weights: np.ndarray

    def take(self, rows) -> Grams:
        return Grams(self.words, tuple(c[rows] for c in self.columns), self.weights[rows])

    def trimmed(self) -> Grams:
        """Without the words that no row has."""
        used = np.zeros(len(self.words) + 1, bool)
        for c in self.columns:
            used[c] = True
        used[0] = False
        number = np.cumsum(used)
        number[~used] = 0
        return Grams(self.words.take(pa.array(np.flatnonzero(used[1:]))), tuple(number[c] for c in self.columns), self.weights)


def _sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, and the number of each word among them, from 1."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64)


def _packed(columns, limit: int) -> np.ndarray | None:
    """One integer for each row, in the order of the rows, if word numbers are small enough."""
    if limit > _MASK:
        return None
    a, b, c = columns
    return a.astype(np.int64) << 2 * _BITS | b.astype(np.int64) << _BITS | c


def summed(words: pa.Array, columns, weights: np.ndarray) -> Grams:
    """The rows sorted, weights of equal rows added up."""
    keys = _packed(columns, len(words))
    order = np.argsort(keys, kind="stable") if keys is not None else np.lexsort(columns[::-1])
    columns, weights = tuple(c[order] for c in columns), weights[order]
    starts = change_points(keys[order]) if keys is not None else change_points(*columns)
    return Grams(words, tuple(c[starts] for c in columns), np.add.reduceat(weights, starts) if len(starts) else weights)


def united(parts: list[Grams]) -> Grams:
    """The union of automata given by their paths."""
    words, number = _sorted_words(pa.concat_arrays([p.words for p in parts]))
    columns, first = ([], [], []), 0
    for p in parts:
        table = np.concatenate(([0], number[first:first + len(p.words)]))
        first += len(p.words)
        for out, c in zip(columns, p.columns):
            out.append(table[c])
    return summed(words, tuple(map(np.concatenate, columns)), np.concatenate([p.weights for p in parts]))


def counted(texts: pa.Array) -> Grams:
    """Counts of all n-grams of one to three words within the pieces of the texts."""
    data, offsets = buffer_of(texts)
    found, starts = words_of_bytes(data, offsets, _INSIDE, _SMALL)
    words, number = _sorted_words(found)
    # Breaks and texts before a word tell its piece.
    piece = np.cumsum(_BREAK[data], dtype=np.int64)[starts] + np.searchsorted(offsets, starts, "right") if len(starts) else starts
    columns = [number, np.zeros_like(number), np.zeros_like(number)]
    for step in (1, 2):
        same = piece[step:] == piece[:-step]
        columns[step][:-step][same] = number[step:][same]
    if len(words) <= _MASK:
        keys, weights = np.unique(_packed(columns, len(words)), return_counts=True)
        paths = Grams(words, (keys >> 2 * _BITS, keys >> _BITS & _MASK, keys & _MASK), weights.astype(np.int64))
    else:
        paths = summed(words, columns, np.ones(len(number), np.int64))
    # Every path counts for its beginnings; sorted paths with one beginning are neighbours.
    a, b, c = paths.columns
    none = np.zeros_like(a)
    out = []
    for own, begin in (((a, none, none), a > 0), ((a, b, none), b > 0), ((a, b, c), c > 0)):
        own = tuple(x[begin] for x in own)
        starts = change_points(*own)
        totals = np.add.reduceat(paths.weights[begin], starts) if len(starts) else np.empty(0, np.int64)
        out.append((tuple(x[starts] for x in own), totals))
    return summed(words, tuple(np.concatenate([o[0][k] for o in out]) for k in range(3)), np.concatenate([o[1] for o in out]))


def _shared_states(starts: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each run of arcs the number of its state, and the first run of each state. Equal runs have one state."""
    size = len(columns[0])
    lengths = np.diff(np.append(starts, size))
    mixed = np.zeros(size, np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    digest = np.add.reduceat(mixed, starts) + lengths.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    _, first, state = np.unique(digest, return_index=True, return_inverse=True)
    # The register decides by the arcs themselves, not by their digest.
    like = first[state]
    equal = lengths[like] == lengths
    at, pair = ragged(starts[equal], lengths[equal]), ragged(starts[like[equal]], lengths[equal])
    same = np.ones(len(at), bool)
    for column in columns:
        same &= column[at] == column[pair]
    bounds = np.cumsum(lengths[equal]) - lengths[equal]
    equal[np.flatnonzero(equal)] = np.logical_and.reduceat(same, bounds) if len(bounds) else True
    others = np.flatnonzero(~equal)
    state[others] = len(first) + np.arange(len(others))
    return state, np.concatenate((first, others))


class Automaton(NamedTuple):
    """Weighted acyclic automaton of n-grams. Arcs of all states of one depth lie in a row; target 0 has no arcs."""

    words: pa.Array
    #: For each depth: first arc of each state (and the end), word of each arc, its weight, the state it leads to.
    depths: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, grams: Grams) -> Automaton:
        """Built from sorted n-grams, the deepest states first."""
        a, b, c = grams.columns
        # Arcs of a depth are the distinct prefixes of that length; a prefix that is no row weighs nothing.
        depths: list[tuple] = []
        below, target_of = None, None
        for depth, prefix in ((2, (a, b, c)), (1, (a, b)), (0, (a,))):
            rows = np.flatnonzero(prefix[-1] > 0)
            starts = rows[change_points(*(p[rows] for p in prefix))] if len(rows) else rows
            longer = grams.columns[depth + 1][starts] if depth < 2 else np.zeros(len(starts), np.int64)
            weights = np.where(longer > 0, 0, grams.weights[starts])
            targets = np.zeros(len(starts), np.int64)
            if below is not None and len(below):
                # Arc of this depth above each run of the depth below it.
                targets[np.searchsorted(starts, below, "right") - 1] = target_of + 1
            labels = prefix[-1][starts]
            if not len(starts):
                runs, below, target_of, kept = starts, starts, starts, starts
            else:
                runs = change_points(*(p[starts] for p in prefix[:-1])) if depth else np.zeros(1, np.int64)
                state, kept = _shared_states(runs, [labels, weights, targets])
                below, target_of = starts[runs], state
            lengths = np.diff(np.append(runs, len(starts)))[kept] if len(starts) else runs
            arcs = ragged(runs[kept], lengths) if len(starts) else runs
            depths.append((np.concatenate(([0], np.cumsum(lengths))), labels[arcs], weights[arcs], targets[arcs]))
        return cls(grams.words, depths[::-1])

    def grams(self) -> Grams:
        """All paths with a weight, sorted."""
        out = []
        path: tuple = ()
        states = np.zeros(1, np.int64)
        for first, labels, weights, targets in self.depths:
            counts = np.diff(first)[states] if len(first) > 1 else np.zeros(len(states), np.int64)
            arcs = ragged(first[states] if len(first) > 1 else states, counts)
            path = (*(np.repeat(p, counts) for p in path), labels[arcs])
            out.append((path, weights[arcs]))
            states = targets[arcs]
            path, states = tuple(p[states > 0] for p in path), states[states > 0] - 1
        columns = [np.concatenate([p[k] if k < len(p) else np.zeros(len(w), np.int64) for p, w in out]) for k in range(3)]
        weights = np.concatenate([w for _, w in out])
        some = weights > 0
        return summed(self.words, tuple(c[some] for c in columns), weights[some])

    def to_bytes(self) -> bytes:
        body, at = buffer_of(self.words)
        arrays = [np.diff(at), body, *(np.diff(d[0]) if k == 0 else d[k] for d in self.depths for k in range(4))]
        parts = []
        for x in arrays:
            x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
            parts += [struct.pack("<BQ", x.itemsize, len(x)), x.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def from_bytes(cls, packed: bytes) -> Automaton:
        plain = zstandard.ZstdDecompressor().decompress(packed)
        arrays, at = [], 0
        while at < len(plain):
            width, size = struct.unpack_from("<BQ", plain, at)
            arrays.append(np.frombuffer(plain, f"<u{width}", size, at + 9))
            at += 9 + width * size
        ends = np.concatenate(([0], np.cumsum(arrays[0], dtype=np.int64)))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(arrays[0]), [None, pa.py_buffer(ends), pa.py_buffer(arrays[1])]
        ).cast(pa.binary())
        depths = []
        for k in range(3):
            sizes, labels, weights, targets = (x.astype(np.int64) for x in arrays[2 + 4 * k:6 + 4 * k])
            depths.append((np.concatenate(([0], np.cumsum(sizes))), labels, weights, targets))
        return cls(words, depths)


class Ranges:
    """Prefix ranges: the sorted split points of each language, numbered through."""

    def __init__(self, splits: dict[str, list[tuple[bytes, bytes, bytes]]]):
        self.splits, self.first, self.count = splits, {}, 0
        for lang in sorted(splits):
            self.first[lang] = self.count
            self.count += len(splits[lang]) + 1

    def cut(self, lang: str, grams: Grams) -> Iterator[tuple[int, Grams]]:
        """The non-empty slices of sorted n-grams with their ranges. A language without splits is in one range."""
        if lang not in self.splits:
            if len(grams.weights):
                yield sum(lang.encode()) % max(self.count, 1), grams
            return
        a, b, c = grams.columns
        bounds = [0]
        known = grams.words
        for split in self.splits[lang]:
            low, high = bounds[-1], len(a)
            for column, word in zip((a, b, c), split):
                at = _place(known, word) + 1
                low, high = low + np.searchsorted(column[low:high], at, "left"), low + np.searchsorted(column[low:high], at, "right")
                if low == high or at > len(known) or known[at - 1].as_py() != word:
                    break
            bounds.append(int(low))
        bounds.append(len(a))
        for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
            if high > low:
                yield self.first[lang] + k, grams.take(slice(low, high)).trimmed()


def _place(words: pa.Array, word: bytes) -> int:
    """How many of the sorted words are less than ``word``."""
    low, high = 0, len(words)
    while low < high:
        middle = (low + high) // 2
        if words[middle].as_py() < word:
            low = middle + 1
        else:
            high = middle
    return low


def _ranges(docs: DataFrame, range_bytes: int) -> Ranges:
    """Split points from a sample that follows the number of ranges."""
    rows = docs.count()
    if not rows:
        return Ranges({})

    def run(batches):
        for batch in blocks(batches):
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            found, starts = words_of_bytes(*buffer_of(texts), _INSIDE, _SMALL)
            offsets = buffer_of(texts)[1]
            bounds = np.searchsorted(starts, offsets)
            out = []
            for i, lang in enumerate(langs):
                low, high = int(bounds[i]), int(bounds[i + 1])
                for at in range(low, high, max(16, -(-(high - low) // 64))):
                    three = [w[:SPLIT_BYTES] for w in found.slice(at, min(3, high - at)).to_pylist()]
                    out.append((lang, *three, *[b""] * (3 - len(three)), 0))
                out.append((lang, b"", b"", b"", int(offsets[i + 1] - offsets[i])))
            columns = list(zip(*out))
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "a", "b", "c", "size"])

    def sampled(count: int) -> list:
        part = docs.sample(min(1.0, count / rows), 11) if count < rows else docs
        return part.mapInArrow(run, "lang string, a binary, b binary, c binary, size long").collect()

    found = sampled(SAMPLE_DOCS)
    sizes = [r.size for r in found if r.size]
    wanted = max(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        int(sum(sizes) / max(len(sizes), 1) * rows / range_bytes),
    )
    if len(found) < SAMPLED * wanted and rows > SAMPLE_DOCS:
        found = sampled(int(SAMPLE_DOCS * SAMPLED * wanted / max(len(found), 1)) + 1)
    points: dict[str, set] = {}
    total = 0
    for r in found:
        if r.a:
            points.setdefault(r.lang, set()).add((bytes(r.a), bytes(r.b), bytes(r.c)))
            total += 1
    splits = {}
    share = sum(map(len, points.values()))
    for lang, own in points.items():
        ordered = sorted(own)
        parts = max(1, round(wanted * len(own) / share))
        chosen = {ordered[k * len(ordered) // parts] for k in range(1, parts)}
        splits[lang] = sorted(chosen)
    return Ranges(splits)


_ROW = "range int, lang string, source int, asks boolean, n long, automaton binary"


def _written(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in _ROW.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(k)[i].as_py() for k in range(batch.num_columns))


def _shards(docs: DataFrame, ranges) -> DataFrame:
    """The automata of blocks of texts, cut by range."""
    def run(batches):
        for block in blocks(batches, limit=BLOCK_BYTES):
            texts, langs = block.column("text"), block.column("lang")
            for lang in sorted(langs.unique().to_pylist()):
                grams = counted(texts.filter(pc.equal(langs, lang)))
                for number, part in ranges.value.cut(lang, grams):
                    yield _written([(number, lang, 0, False, 0, Automaton.of(part).to_bytes())])

    return docs.mapInArrow(run, _ROW)


def _unions(shards: DataFrame, count: int, min_count: int) -> DataFrame:
    """One automaton for each range and language, without light paths; ``n`` is the number of words counted in it."""
    def run(batches):
        held: dict[tuple, list[Grams]] = {}
        for number, lang, _, _, _, packed in _rows(batches):
            parts = held.setdefault((number, lang), [])
            parts.append(Automaton.from_bytes(packed).grams())
            if len(parts) > 1 and sum(len(p.weights) for p in parts[1:]) > HELD:
                parts[:] = [united(parts)]
        for (number, lang), parts in held.items():
            grams = united(parts)
            words = int(grams.weights[grams.columns[1] == 0].sum())
            heavy = grams.take(grams.weights >= min_count).trimmed()
            yield _written([(number, lang, 0, False, words, Automaton.of(heavy).to_bytes())])

    return shards.repartitionById(count, F.col("range")).mapInArrow(run, _ROW)


def _parts(grams: Grams) -> Grams:
    """The parts that scores of the phrases need; a pair weighs as much as the most frequent three words around it, and else 0."""
    a, b, c = grams.columns
    none = np.zeros_like(a)
    two, three = (b > 0) & (c == 0), c > 0
    asked = [((x[m], none[m], none[m]), none[m]) for x, m in ((a, two | three), (b, two), (c, three))]
    asked += [((x[three], y[three], none[three]), grams.weights[three]) for x, y in ((a, b), (b, c))]
    columns = tuple(np.concatenate([p[0][k] for p in asked]) for k in range(3))
    weights = np.concatenate([p[1] for p in asked])
    order = np.lexsort((weights, *columns[::-1]))
    columns, weights = tuple(x[order] for x in columns), weights[order]
    starts = change_points(*columns)
    last = np.append(starts[1:], len(weights)) - 1 if len(starts) else starts
    return Grams(grams.words, tuple(x[last] for x in columns), weights[last])


def _asked(unions: DataFrame, ranges) -> DataFrame:
    """The automata of parts, one for each range that is asked. Weights are raised by 1, as a path must weigh something."""
    def run(batches):
        for number, lang, _, _, _, packed in _rows(batches):
            parts = _parts(Automaton.from_bytes(packed).grams())
            for target, own in ranges.value.cut(lang, parts._replace(weights=parts.weights + 1)):
                yield _written([(target, lang, number, True, 0, Automaton.of(own).to_bytes())])

    return unions.mapInArrow(run, _ROW)


def _found(grams: Grams, words: pa.Array, columns) -> np.ndarray:
    """The rows of ``grams`` that equal the given ones over their own words; all must be there."""
    table = np.concatenate(([0], pc.fill_null(pc.index_in(words, value_set=grams.words), -1).to_numpy() + 1))
    columns = [table[c] for c in columns]
    own, wanted = _packed(grams.columns, len(grams.words)), _packed(columns, len(grams.words))
    if own is None:
        place = {key: i for i, key in enumerate(zip(*(c.tolist() for c in grams.columns)))}
        return np.array([place[key] for key in zip(*(c.tolist() for c in columns))], np.int64)
    at = np.searchsorted(own, wanted)
    if len(wanted) and (at.max() >= len(own) or not np.array_equal(own[at], wanted)):
        raise ValueError("a part of a phrase has no count")
    return at


def _answered(unions: DataFrame, asked: DataFrame, count: int, overlap: int) -> DataFrame:
    """Counts of the parts, sent back to who asked; and the range's own automaton, ``asks`` false, of the phrases that stay.

    The latter has all its paths; those dropped for a longer phrase are told by a second automaton with ``source`` 1.
    """
    def run(batches):
        own = grams = inside = None

        def settled():
            dropped = 100 * inside >= overlap * grams.weights
            dropped &= (grams.columns[1] > 0) & (inside > 0)
            yield _written([(own[0], own[1], 0, False, 0, Automaton.of(grams).to_bytes())])
            if dropped.any():
                yield _written([(own[0], own[1], 1, False, 0, Automaton.of(grams.take(dropped).trimmed()).to_bytes())])

        for number, lang, source, asks, _, packed in _rows(batches):
            if not asks:
                if own is not None:
                    yield from settled()
                own, grams = (number, lang), Automaton.from_bytes(packed).grams()
                inside = np.zeros(len(grams.weights), np.int64)
                continue
            parts = Automaton.from_bytes(packed).grams()
            at = _found(grams, parts.words, parts.columns)
            np.maximum.at(inside, at, parts.weights - 1)
            answer = parts._replace(weights=grams.weights[at])
            yield _written([(source, lang, 0, True, 0, Automaton.of(answer).to_bytes())])
        if own is not None:
            yield from settled()

    together = unions.select("range", "lang", "source", "asks", "n", "automaton").union(asked)
    placed = together.repartitionById(count, F.col("range")).sortWithinPartitions("range", "lang", "asks")
    return placed.mapInArrow(run, _ROW)


def exact_scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``floor(10^6 a a / (left right))`` in integers of any size."""
    most = max((int(x.max(initial=0)) for x in (a, left, right)), default=0)
    if most < 3_000_000:
        return 1_000_000 * a * a // (left * right)
    exact = (1_000_000 * x * x // (y * z) for x, y, z in zip(a.tolist(), left.tolist(), right.tolist()))
    return np.fromiter(exact, np.int64, len(a))


def _best_of_range(grams: Grams, dropped: np.ndarray, counts: dict, top: int) -> list[tuple]:
    """``(phrase, a, l, r, score)`` of the first phrases of a range."""
    rows = np.flatnonzero((grams.columns[1] > 0) & ~dropped)
    a, b, c = (x[rows] for x in grams.columns)
    none = np.zeros_like(a)
    f = grams.weights[rows]
    three = c > 0

    def count(*columns):
        at = _found(counts, grams.words, columns)
        return counts.weights[at]

    left, right = count(a, none, none), np.zeros_like(f)
    right[~three] = count(b[~three], none[~three], none[~three])
    right[three] = count(b[three], c[three], none[three])
    score = exact_scores(f, left, right)
    left2, right2 = count(a[three], b[three], none[three]), count(c[three], none[three], none[three])
    score2 = exact_scores(f[three], left2, right2)
    lower = score2 < score[three]
    at = np.flatnonzero(three)[lower]
    left[at], right[at], score[at] = left2[lower], right2[lower], score2[lower]
    order = np.lexsort((-f, -score))
    if len(order) > top:
        # Ties with the last are told apart by the phrase.
        edge = order[top - 1]
        order = order[(score[order] > score[edge]) | (score[order] == score[edge]) & (f[order] >= f[edge])]
    texts = [[w.decode("utf-8") for w in grams.words.take(pa.array(x[order][x[order] > 0] - 1)).to_pylist()] for x in (a, b, c)]
    third = iter(texts[2])
    out = []
    for k, i in enumerate(order.tolist()):
        words = [texts[0][k], texts[1][k], *([next(third)] if three[i] else [])]
        out.append((" ".join(words), int(f[i]), int(left[i]), int(right[i]), int(score[i])))
    out.sort(key=lambda row: (-row[4], -row[1], row[0].encode()))
    return out[:top]


def _scored(answered: DataFrame, count: int, top: int) -> DataFrame:
    """``lang, phrase, a, l, r, score``: the first phrases of each range."""
    schema = "lang string, phrase string, a long, l long, r long, score long"

    def run(batches):
        own = grams = dropped = None
        answers: list[Grams] = []

        def settled():
            best = _best_of_range(grams, dropped, united(answers), top) if answers else []
            columns = list(zip(*[(own[1], *row) for row in best])) or [[]] * 6
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)

        for number, lang, source, asks, _, packed in _rows(batches):
            paths = Automaton.from_bytes(packed).grams()
            if asks:
                answers.append(paths)
            elif source:
                dropped[_found(grams, paths.words, paths.columns)] = True
            else:
                if own is not None:
                    yield from settled()
                own, grams, answers = (number, lang), paths, []
                dropped = np.zeros(len(grams.weights), bool)
        if own is not None:
            yield from settled()

    placed = answered.repartitionById(count, F.col("range")).sortWithinPartitions("range", "lang", "asks", "source")
    return placed.mapInArrow(run, schema)


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, overlap: int = 50, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    Every row of ``docs`` counts, repeated ones again; a null text is empty, a null language ``und``; ids and other columns are
    ignored. A language without candidates has no rows; an empty table gives an empty result. Ties of score go by the more
    frequent phrase, then by the bytes of the phrase. A phrase is dropped if a longer candidate around it has at least
    ``overlap`` percent of its occurrences.
    """
    if min_count < 1:
        raise ValueError("a phrase occurs once at least")
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = _ranges(docs, range_bytes)
    count = max(ranges.count, 1)
    shared = spark.sparkContext.broadcast(ranges)
    unions = stored(_unions(_shards(docs, shared), count, min_count), "unions")
    answered = _answered(unions, _asked(unions, shared), count, overlap)
    best = top_rows(
        _scored(answered, count, top), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, count
    )
    words = unions.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
