"""Quality rules, token counts, encoding and line dedup against plain Python."""

import hashlib
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import samples
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from keepwell.llm import bpe, line_dedup, quality_rules, token_counts
from keepwell.llm.shared import stored

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def figures(text):
    text = text or ""
    own = words(text)
    windows = [tuple(own[i:i + 8]) for i in range(len(own) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if words(x)]
    base = len(own) < 20 or 100 * len(covered) > 30 * len(own)
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), base


REPEATS = [
    (7000, "a b c d e f g h " * 4, "en", "s0", 0),
    (7001, samples.prose(1) + " one two three four five six seven eight nine " + samples.prose(2) + " one two three four five six seven eight nine", "en", "s0", 0),
    (7002, "same line here\n" * 9 + samples.prose(4), "en", "s1", 0),
    (7003, " ".join(f"{w}%%%" for w in words(samples.prose(6))), "en", "s1", 0),
    (7004, " ".join(f"{w.upper()}!!" for w in words(samples.prose(8))), "en", "s1", 0),
    (7005, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22", "en", "s1", 0),
]


@pytest.fixture(scope="module")
def data():
    return samples.rows() + REPEATS


def test_figures(spark, data):
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_rules.judge(samples.table(spark, data), ["doc_id"])
    got = sorted((str(r.doc_id), *[r[c] for c in shown]) for r in found.collect())
    assert got == sorted((str(d), *figures(t)) for d, t, *_ in data)


def test_verdicts(spark, data):
    docs = samples.table(spark, data, clash=True)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(30)) <= ids and {7001, 5000} <= ids
    assert not ids & {7000, 7003, 7004, 7005, 3000, 3001, 3002, None}


def test_order_does_not_change_verdicts(spark, data):
    docs = samples.table(spark, data)
    shown = ["doc_id", "n_words", "kept"]
    one = quality_rules.judge(docs, ["doc_id"]).select(shown).collect()
    other = quality_rules.judge(docs, ["doc_id"], quality_rules.RULES[::-1]).select(shown).collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


def test_rules_that_reject_come_first(spark):
    never = quality_rules.Rule("never", lambda: F.col("n_words") < 0)
    order = quality_rules.order_rules(samples.table(spark, samples.rows() + REPEATS[3:4] * 20), (never, quality_rules.RULES[1]))
    assert [r.name for r in order] == ["symbols", "never"]


def test_token_counts(spark, data):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    more = [(8000 + i, t, "en", "s0", 0) for i, t in enumerate(["a  b", "  ", "\n", "▁x ▁▁ y", "a\n\n\n b\r\n", "<s> </s>\x00", "x" * 3000, "word\n" * 50])]
    found = token_counts.count_tokens(samples.table(spark, data + more, clash=True), path, 300)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect())
    counts = [(str(d), len((t or "").encode()), len(library.encode(t or ""))) for d, t, *_ in data + more]
    assert got == sorted((*c, c[2] > 300) for c in counts)


def test_token_counts_without_a_full_cache(monkeypatch):
    model = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    monkeypatch.setattr(token_counts, "CACHED", 3)
    lengths, library = token_counts.Lengths(model, {"▁the": 1}), sentencepiece.SentencePieceProcessor(model_proto=model)
    text = samples.prose(9, 200)
    assert lengths.count(text) == len(library.encode(text)) and len(lengths) <= 4


@pytest.fixture(scope="module")
def automaton():
    return bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoding_and_decoding(spark, data, automaton):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = samples.table(spark, data, clash=True)
    rows = bpe.digests(bpe.decode(bpe.encode(docs, automaton), automaton), "doc_id").collect()
    at_once = bpe.round_trip(docs, automaton, "doc_id", "bits")
    assert sorted(map(str, rows)) == sorted(map(str, at_once.drop("bits").collect()))
    packed = bpe.round_trip(docs, automaton, "doc_id", ids="ids").filter("octet_length(ids) = 4 * n_tokens AND sha2(ids, 256) = ids_sha256")
    assert packed.count() == len(rows)
    want = []
    for doc_id, text, *_ in data:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), back.encode())]
        want.append((str(doc_id), len(ids), *sha))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)


def test_every_kind_of_character(automaton):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = bpe.Encoder(automaton, kept_arcs=1000)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["a" * n for n in range(1, 70)] + ["ab" * 90, " " * 40 + "x", "<|endoftext|><|endoftext|>", "'s'S n't", "tiontion" * 40]
    ids, begins = encoder(pa.array(texts))
    for k, want in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[begins[k]:begins[k + 1]]
        assert own.tolist() == want.ids, texts[k]
        assert automaton.decode(own) == texts[k]


def small_automaton(merges):
    vocabulary = {bytes([b]): b for b in range(256)} | {u + v: 256 + i for i, (u, v) in enumerate(merges)}
    return bpe.Automaton(vocabulary, merges, {})


def test_equal_parts_join_from_the_left():
    encoder = bpe.Encoder(small_automaton([(b"a", b"a"), (b"aa", b"aa"), (b"aa", b"b")]))
    # The last is longer than words that are walked together.
    cases = (("aaa", [256, 97]), ("aaaaaab", [257, 258]), ("aaaaab", [257, 97, 98]), ("a" * 402 + "b", [257] * 100 + [258]))
    for word, want in cases:
        assert encoder(pa.array([word]))[0].tolist() == want
    assert not encoder.automaton.has_arc(np.array([97]), np.array([256]))[0]


def test_arcs_of_two_states():
    """ab, then abc, then bc: by hand, which arcs the states a and ab have among a, b, c, ab, abc, bc."""
    own = small_automaton([(b"a", b"b"), (b"ab", b"c"), (b"b", b"c")])
    arcs = np.array([97, 98, 99, 256, 257, 258])
    # Behind a: b was cut by the first gadget. bc was laid where b led at that time, so a has no arc bc either.
    assert own.has_arc(np.full(6, 97), arcs).tolist() == [True, False, True, True, True, False]
    # The state behind ab is a copy of that behind b, without c; bc begins with b, which it keeps.
    assert own.has_arc(np.full(6, 256), arcs).tolist() == [True, True, False, True, True, True]


@pytest.mark.parametrize("merges", [
    [(b"a", b"b"), (b"ab", b"a"), (b"b", b"a"), (b"aba", b"b"), (b"a", b"a")],
    [(b"a", b"a"), (b"aa", b"a"), (b"aa", b"aa"), (b"b", b"aa"), (b"a", b"b")],
    [(b"b", b"a"), (b"a", b"ba"), (b"ba", b"ba"), (b"aba", b"baba")],
])
def test_every_word_has_one_path(merges):
    own = small_automaton(merges)
    encoder = bpe.Encoder(own)
    labels = {97: b"a", 98: b"b"} | {256 + i: u + v for i, (u, v) in enumerate(merges) if own.laid[256 + i] >= 0}

    def paths(word, state=None):
        if not word:
            return [[]]
        out = []
        for arc, label in labels.items():
            if word.startswith(label) and (state is None or own.has_arc(np.array([state]), np.array([arc]))[0]):
                out += [[arc, *rest] for rest in paths(word[len(label):], arc)]
        return out

    def merged(word):
        parts = [word[i:i + 1] for i in range(len(word))]
        for u, v in merges:
            i = 0
            while i + 1 < len(parts):
                if (parts[i], parts[i + 1]) == (u, v):
                    parts[i:i + 2] = [u + v]
                i += 1
        return [next(t for t, x in labels.items() if x == p) for p in parts]

    for size in range(1, 9):
        for bits in range(2**size):
            word = bytes(97 + (bits >> k & 1) for k in range(size))
            found = paths(word)
            assert found == [merged(word)]
            assert encoder(pa.array([word.decode()]))[0].tolist() == found[0]


def dropped(data, min_docs):
    table = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = [[(x, x.strip(SPACE).translate(table)) for x in (t or "").split("\n")] for _, t, *_ in data]
    holders = Counter(k for lines in split for k in {k for _, k in lines})
    for (doc_id, *_), lines in zip(data, split):
        stay = [x for x, k in lines if not k or holders[k] < min_docs]
        yield str(doc_id), len(lines), len(lines) - len(stay), "\n".join(stay)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_line_dedup(spark, data, batches, fanout):
    lines = ["  Shared LINE\t", "shared line", "ÄB", "äb", "Ab", " "]
    more = [(9000 + i, "\n".join(lines[: i % 7] + [samples.prose(50 + i, 10)]), "en", "s0", 0) for i in range(24)]
    docs = samples.table(spark, data + more, clash=True)
    found = line_dedup.drop_shared_lines(docs, 3, 1, batches, fanout)
    got = sorted((str(r.row.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in found.collect())
    assert got == sorted(dropped(data + more, 3))


def test_many_shared_lines_in_one_text(spark):
    """Twelve texts of 100,000 lines that all of them share: seconds, since the work on a text is linear."""
    text = "\n".join(f"line {i} of all" for i in range(100_000))
    docs = stored(spark.range(12).select(F.col("id").alias("doc_id"), F.concat(F.lit(text + "\nown "), F.col("id").cast("string")).alias("text")), "long")
    begun = time.monotonic()
    found = line_dedup.drop_shared_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert time.monotonic() - begun < 60
    assert sorted(map(tuple, found)) == [(i, 100_001, 100_000, f"own {i}") for i in range(12)]


def test_runs_are_merged_where_they_lie(spark):
    runs = line_dedup._Runs(spark, 4)
    keys = stored(spark.range(1000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("line"), F.lit(12).cast("long").alias("n")), "keys")
    name = runs.add(keys.filter("hash(line) % 2 = 0"))
    fresh = runs.without_settled(keys, name, 10)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert fresh.count() == keys.filter("hash(line) % 2 != 0").count()
    both = runs.merged([name, runs.add(keys), runs.add(keys.limit(10))])
    assert both.count() == 1000 and both.agg(F.sum("n")).first()[0] == 12 * (1000 + keys.filter("hash(line) % 2 = 0").count() + 10)
    runs.forget()


def test_line_dedup_of_documents(spark):
    data = [(i, f"Common\nown {i}", "en", "s0", 0) for i in range(12)] + [(99, None, "en", "s0", None)]
    docs = samples.table(spark, data, clash=True)
    kept = line_dedup.without_shared_lines(docs)
    assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert {(r.doc_id, r.text, r.n_chars) for r in kept.collect()} == {(i, f"own {i}", len(f"own {i}")) for i in range(12)} | {(99, None, None)}


def test_empty_tables(spark, automaton):
    none = samples.table(spark, [])
    assert quality_rules.keep_good(none).count() == 0
    assert token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert bpe.decode(bpe.encode(none, automaton), automaton).count() == 0
    assert line_dedup.drop_shared_lines(none).count() == 0
