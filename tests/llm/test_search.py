"""Ranked search, collocations and packing against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import samples
from tokenizers import Tokenizer

from keepwell.llm import ball_search, collocations, packing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def own_terms(text):
    return [t.translate(LOWER) for t in TERMS.findall(text or "")]


def ranking(docs, items, top=10):
    texts = [(d, own_terms(t)) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    n, length = len(texts), sum(len(t) for _, t in texts)
    df = Counter(x for _, t in texts for x in set(t))
    out = []
    for item, text in items:
        asked, scores = Counter(own_terms(text)), []
        for doc, t in texts:
            tf, m = Counter(t), 25 + 75 * len(t) * n // length
            score = sum(
                c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
                for x, c in asked.items() if x in tf
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_ranking(spark):
    data = samples.rows()
    words = own_terms(samples.prose(5, 200))
    items = [(i, samples.prose(i, 25) if i % 3 else " ".join(words[i:i + 9] * 2)) for i in range(40)]
    items += [(90, None), (91, " .,"), (92, "nosuchterm"), (93, "日本語 ÜNÏCODE Ünïcode"), (93, "a1 the"), (None, "text words few")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS score", "1 AS rank")
    found = ball_search.search(samples.table(spark, clash=True), benchmark)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == ranking([(d, t) for d, t, *_ in data], items)
    assert ball_search.search(samples.table(spark, []), benchmark).count() == 0
    assert ball_search.search(samples.table(spark), benchmark.limit(0)).count() == 0
    assert ball_search.search(samples.table(spark, [(1, " ", "en", "s", 1), (2, None, "en", "s", 1)]), benchmark).count() == 0


def test_ranking_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ball_search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(ball_search, "SAMPLE_ROWS", 8)
    items = [(i, samples.prose(i, 30)) for i in range(9)]
    found = ball_search.search(samples.table(spark), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == ranking([(d, t) for d, t, *_ in samples.rows()], items)


def test_tree_prunes_and_loses_nothing():
    draw = np.random.default_rng(4)
    rows = []
    for group in range(40):  # forty tight groups far from each other
        base = draw.choice(400, 12, replace=False)
        rows += [{int(t): int(draw.integers(900, 1000)) for t in base} for _ in range(50)]
    sizes = [len(r) for r in rows]
    columns = np.array([t for r in rows for t in sorted(r)])
    values = np.array([r[t] for r in rows for t in sorted(r)])
    tree = ball_search.BallTree(np.concatenate(([0], np.cumsum(sizes))), columns, values, 400, leaf=16)
    visited = []
    for group in range(0, 2000, 97):
        ids = np.array(sorted(rows[group]))
        looked = []
        tree.values, kept = _Watched(tree.values, looked), tree.values
        got = tree.search(ids, np.ones(len(ids), np.int64), 1, 5, list(range(len(rows))))
        tree.values = kept
        scores = sorted(((-sum(r.get(int(t), 0) for t in ids), i) for i, r in enumerate(rows)))[:5]
        assert sorted((-s, i) for s, i in got) == scores
        visited.append(sum(looked) / 12)
    assert np.mean(visited) < len(rows) / 3
    # Every member lies in the ball of each node above it.
    for number, (first, last, _, _) in enumerate(tree.nodes):
        centre = tree.centres[number].astype(np.float64)
        for at in range(first, last):
            point = np.zeros(400)
            own = slice(tree.rows[at], tree.rows[at + 1])
            point[tree.columns[own]] = tree.values[own]
            assert np.linalg.norm(point - centre) <= tree.radii[number]


class _Watched:
    """Values that note how many of them are read."""

    def __init__(self, values, looked):
        self.values, self.looked = values, looked

    def __getitem__(self, part):
        self.looked.append(part.stop - part.start)
        return self.values[part]


def phrases(docs, min_count=10, top=2000):
    counts = defaultdict(Counter)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for i in range(len(words)):
                for k in (1, 2, 3):
                    if i + k <= len(words):
                        counts[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, own in counts.items():
        n = sum(f for g, f in own.items() if len(g) == 1)
        strong = {g: f for g, f in own.items() if len(g) > 1 and f >= min_count}
        around = Counter()
        for g, f in strong.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    around[part] = max(around[part], f)
        rows = []
        for g, a in strong.items():
            if len(g) == 2 and around[g] and 100 * around[g] >= 50 * a:
                continue
            score, _, left, right = min((10**6 * a * a // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


PAIRS = [("Hot pair hot pair a hot pair b. Hot pair c", "en")] * 30 + [("x\ty  z, x y z; x y\x0bw", None), ("\x01a b \x01a B", "de")] * 12


@pytest.mark.parametrize("top", [2000, 7])
def test_phrases(spark, top):
    docs = [(t, lang) for _, t, lang, *_ in samples.rows()] + PAIRS
    table = spark.createDataFrame([(t, lang, "x") for t, lang in docs], "text string, lang string, n string")
    found = collocations.collocations(table, min_count=10, top=top, range_bytes=2000)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == phrases(docs, top=top)
    assert collocations.collocations(table.limit(0)).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], "text string, lang string")
    assert collocations.collocations(blank).count() == 0


def test_automaton_round_trip_and_union():
    texts = [pa.array([t for t, _ in PAIRS[:20]]), pa.array([samples.prose(i) for i in range(20)] + [t for t, _ in PAIRS])]
    parts = [collocations.counted(t) for t in texts]
    for grams in parts:
        again = collocations.Automaton.from_bytes(collocations.Automaton.of(grams).to_bytes()).grams()
        assert again.words.equals(grams.words) and np.array_equal(again.weights, grams.weights)
        assert all(np.array_equal(x, y) for x, y in zip(again.columns, grams.columns))
    whole = collocations.united(parts)
    straight = collocations.counted(pa.concat_arrays(texts))
    assert whole.words.equals(straight.words) and np.array_equal(whole.weights, straight.weights)
    # Slices between split points add up to the whole, also where a split falls inside a prefix.
    ranges = collocations.Ranges({"en": sorted({(b"hot", b"pair", b"b"), (b"hot", b"zz", b""), (b"m", b"", b""), (b"b", b"", b"")})})
    slices = list(ranges.cut("en", straight))
    assert sum(len(g.weights) for _, g in slices) == len(straight.weights) and len(slices) > 3
    assert np.array_equal(collocations.united([g for _, g in slices]).weights, straight.weights)


def test_equal_states_are_shared():
    grams = collocations.counted(pa.array(["a x q. b x q. c x q. d y q"]))
    automaton = collocations.Automaton.of(grams)
    # Behind a, b, c the arc x leads to one state; behind d the arc y leads to the same one.
    first, _, _, targets = automaton.depths[0]
    assert len(first) == 2 and len(automaton.depths[2][0]) == 2
    words = automaton.words.to_pylist()
    states = dict(zip((words[k - 1] for k in automaton.depths[0][1]), targets.tolist()))
    assert states[b"a"] == states[b"b"] == states[b"c"] != states[b"d"]


def test_scores_beyond_64_bits():
    a, left, right = (np.array([x]) for x in (3 * 10**9, 4 * 10**9, 9 * 10**9))
    assert collocations.exact_scores(a, left, right)[0] == 10**6 * (3 * 10**9) ** 2 // (36 * 10**18)


def test_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = samples.rows() + [(6000 + i, samples.prose(i, 40 * i), "en", "s0", 0) for i in range(60)]
    found = packing.pack(samples.table(spark, rows, clash=True), path, window=256, max_open=16).collect()
    texts = Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)) for d, t, *_ in rows)
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    unique = [(d, ids) for (d, ids), n in texts.items() if sum(m for (e, _), m in texts.items() if e == d) == 1]
    assert len(unique) > 90
    for doc, ids in unique:
        pieces = sorted(by_doc[doc], key=lambda p: p[0])
        assert tuple(np.concatenate([p[1] for p in pieces]).tolist()) == ids
        assert [p[0] for p in pieces] == np.cumsum([0, *[len(p[1]) for p in pieces]])[:-1].tolist()
        assert {p[2] for p in pieces} == {len(ids)}
    total = sum(len(ids) * n for (_, ids), n in texts.items())
    assert sum(r.length for r in found) == total
    assert total / (256 * len(windows)) > 0.96
    assert packing.pack(samples.table(spark, []), path).count() == 0


def test_level_of_least_squares():
    packer = packing.Packer(window=10, max_open=100)
    for level, count in ((2, 3), (4, 1), (6, 5), (7, 2)):
        packer.counts[level] = count

    def grown(level, length):
        after = packer.counts.copy()
        after[level] -= level > 0
        after[level + length] += level + length < 10
        return int((after[1:10] ** 2).sum())

    for length in range(1, 10):
        possible = [h for h in range(0, 11 - length) if h == 0 or packer.counts[h]]
        least = min(grown(h, length) for h in possible)
        assert packer.best_level(length) == max(h for h in possible if grown(h, length) == least)


AWKWARD = [" ", "  ", "\n", " \n", "\t", "a", "the", "é", "日", "　", "\xa0", " ", "\x1c", "\x85", "'ll", "12", "$$", "🎉", "\x00", "<|endoftext|>"]


def test_chunks_have_the_tokens_of_their_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    draw = np.random.default_rng(1)
    texts = ["".join(draw.choice(AWKWARD, draw.integers(0, 30))) for _ in range(3000)] + ["", None, "x" * 5000]
    found = packing.ChunkEncoder(open(path, encoding="utf-8").read())(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_checksums_of_the_query(spark):
    from keepwell.llm.catalog import op13_packing

    rows = op13_packing(spark, "/root/testdata/sf0.001").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs}
    for r in rows:
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
