"""Mixing, sharding, the classifier, MinHash and WARC against plain Python."""

import base64
import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs
import pytest
import samples
import zstandard
from pyspark.sql import functions as F

from keepwell.llm import classifier, minhash, mixing, sharding, warc
from keepwell.llm.shared import numbered


@pytest.fixture(scope="module")
def data():
    return samples.rows()


def word_count(text):
    return max(1, len((text or "").encode().split()))


def test_numbers_are_gapless(spark):
    frame = spark.range(500).withColumn("g", F.when(F.col("id") % 3 == 0, 1))
    found = numbered(frame.na.fill(0), ["g"], F.xxhash64("id"), [F.col("id")], "place", 7).collect()
    for group in (0, 1):
        places = sorted(r.place for r in found if r.g == group)
        assert places == list(range(len(places)))


@pytest.mark.parametrize("limit", [1.0, 1.5, 3.0])
def test_repetition_limit(spark, data, limit):
    rows = mixing.measured(samples.table(spark, data))
    mixture = mixing.plan(rows, None, limit)
    passes = [r.budget / r.tokens for r in mixture.sources.collect()]
    assert min(passes) == pytest.approx(1) and max(passes) <= limit + 1e-3
    assert max(passes) == pytest.approx(limit, rel=1e-3) or mixture.exponent == 0


def test_target_entropy(spark, data):
    rows = mixing.measured(samples.table(spark, data))
    natural = [r.tokens for r in rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()]
    entropy = -sum(n / sum(natural) * math.log(n / sum(natural)) for n in natural)
    target = (entropy + math.log(len(natural))) / 2
    weights = [r.weight for r in mixing.plan(rows, target, None).sources.collect()]
    assert sum(weights) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(target, abs=1e-2)


def test_draws(spark, data):
    unique = [r for r in data if r[0] not in (None, 2001)]
    found = mixing.draws(samples.table(spark, unique, clash=True), None, 1.5, 500).collect()
    plan = {r.source: r for r in mixing.plan(mixing.measured(samples.table(spark, unique)), None, 1.5).sources.collect()}
    draws = Counter(r.doc_id for r in found)
    assert set(draws) == {r[0] for r in unique} and max(draws.values()) == 2
    for source, p in plan.items():
        mine = [(i, word_count(t)) for i, t, _, s, _ in unique if s == source]
        content = {i: hashlib.md5((t or "").encode()).hexdigest() for i, t, *_ in unique}

        def key(epoch, doc_id):
            return hashlib.md5(f"17:{epoch}:{doc_id}:{content[doc_id]}".encode()).hexdigest()

        left, again = p.rest, set()
        for i, n in sorted(mine, key=lambda x: key(p.epochs, x[0])):
            if left > 0:
                again.add(i)
            left -= n
        assert {i for i, _ in mine if draws[i] == p.epochs + 1} == again
    blocks = defaultdict(list)
    for r in found:
        blocks[r.block].append(r.place)
    assert all(sorted(b) == list(range(len(b))) for b in blocks.values())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_budget_holds_for_rows_of_one_id(spark, doc_id):
    rows = [(doc_id, f"{samples.prose(i, 9)} {i}", "en", "small", 0) for i in range(200)]
    rows += [(1000 + i, samples.prose(i, 30), "en", "large", 0) for i in range(400)]
    docs = samples.table(spark, rows)
    found = mixing.draws(docs, None, 1.5).collect()
    plan = {r.source: r for r in mixing.plan(mixing.measured(docs), None, 1.5).sources.collect()}
    for source, p in plan.items():
        own = [r for r in found if r.source == source]
        longest = max(r.tokens for r in own)
        assert p.budget <= sum(r.tokens for r in own) < p.budget + longest
        assert sum(r.tokens for r in own) <= 1.5 * p.tokens + longest


def test_mixed_documents(spark, data):
    docs = samples.table(spark, data, clash=True)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {r[0] for r in data}


def check_shards(found, data, shards=8):
    assert len(found) == len(data)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots[s]) == list(range(len(slots[s]))) for s in range(shards))
    assert {r.law for r in found} <= {"rows"} and all(r.grown_shard is None for r in found)


def test_shards(spark, data):
    more = data + [(6000 + i, f"text {i // 4}", "en", "s0", 0) for i in range(60)]
    found = sharding.shard_documents(samples.table(spark, more, clash=True)).collect()
    check_shards(found, more)
    import zlib

    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in more)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == want
    where = {r.doc_id: r["shard"] for r in found}
    assert all(len({where[6000 + i] for i in range(k, k + 4)}) == 1 for k in range(0, 60, 4))


@pytest.mark.parametrize("texts", [["one"] * 50, ["a"] * 30 + ["b"] * 30 + list("cdefg"), [f"t{i // 2}" for i in range(64)], ["x"], []])
def test_shards_of_large_groups(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    check_shards(sharding.shard_documents(samples.table(spark, rows)).collect(), rows)


def test_propagation_cuts_fewer_links(spark):
    cells = spark.createDataFrame([(bytes([k]), s, 1) for k in range(40) for s in (k % 4, (k + 1) % 4, (k + 2) % 4)], "key binary, label int, n long")
    moved = sharding.propagate(cells, [31] * 4)
    load = {r.label: r.n for r in moved.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert sum(load.values()) == 120 and max(load.values()) <= 31
    assert moved.count() < 0.6 * cells.count()


def sites(spark, sizes, seed=3):
    """Documents of two kinds; the share of good ones differs by host."""
    import random

    draw, docs, labels = random.Random(seed), [], []
    for host, (size, share) in enumerate(sizes):
        for _ in range(size):
            good, i = draw.random() < share, len(docs)
            words = samples.prose(i, 40).split()
            docs.append((i, " ".join(words if good else [w.upper() + "!!" for w in words]), "en", f"h{host}", 0))
            labels.append((i, int(good)))
    return docs, labels


def test_classifier_on_held_out_documents(spark):
    docs, labels = sites(spark, [(150, 0.9), (150, 0.2), (4, 0.5)])
    held = {i for i, _ in labels if i % 3 == 0}
    known = spark.createDataFrame([x for x in labels if x[0] not in held] + [(None, 1), (1, None)], "doc_id long, quality int")
    found = classifier.classify(samples.table(spark, docs, clash=True), known, F.col("source"), F.col("lang")).collect()
    right = [r.kept == bool(labels[r.doc_id][1]) for r in found if r.doc_id in held]
    assert sum(right) >= 0.95 * len(right)
    assert len(found) == len(docs) and all(0 <= r.quality <= 1 for r in found)


def test_sparse_sites_stay_near_the_level_above(spark):
    rows = [(i, "big", "p", 0.9) for i in range(500)] + [(1000 + i, "bad", "p", 0.1) for i in range(500)]
    rows += [(2000, "small", "p", 0.1), (2001, "small", "q", 0.1), (2002, None, None, 0.5)]
    out = {r.doc_id: r for r in classifier.posteriors(spark.createDataFrame(rows, "doc_id long, host string, path string, score double")).collect()}
    assert len(out) == len(rows)
    assert out[0].host_posterior > 0.85 and out[1000].host_posterior < 0.15
    assert 0.2 < out[2000].host_posterior < 0.6
    assert out[2000].quality < out[0].quality


def plain_posteriors(rows):
    """The same by loops: ``rows`` are (doc_id, host, path, score, label)."""
    value = {i: s if label is None else label for i, _, _, s, label in rows}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, host, path, *_ in rows:
        hosts[host].append(value[i])
        paths[host, path].append(value[i])
    mean = sum(value.values()) / len(value)

    def strength(groups, above):
        between = sum(len(g) * (sum(g) / len(g) - above[k]) ** 2 for k, g in groups.items()) / len(groups)
        chance = sum(above[k] * (1 - above[k]) for k in groups) / len(groups)
        size = sum(map(len, groups.values())) / len(groups)
        return 1 / min(0.99, max(1e-4, (between / chance - 1) / max(size - 1, 1.0))) - 1

    strong = strength(hosts, dict.fromkeys(hosts, mean))
    host_mean = {h: (sum(g) + strong * mean) / (len(g) + strong) for h, g in hosts.items()}
    strong_path = strength(paths, {k: host_mean[k[0]] for k in paths})

    def odds(p):
        p = min(max(p, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    out = {}
    for i, host, path, score, _ in rows:
        h = (sum(hosts[host]) - value[i] + strong * mean) / (len(hosts[host]) - 1 + strong)
        p = (sum(paths[host, path]) - value[i] + strong_path * h) / (len(paths[host, path]) - 1 + strong_path)
        out[i] = h, p, 1 / (1 + math.exp(-(odds(score) + odds(p) - odds(mean))))
    return out


def test_posteriors_by_loops(spark):
    draw = np.random.default_rng(6)
    rows = []
    for host, share in (("a", 0.8), ("b", 0.3), ("c", 0.5), (None, 0.9), ("", 0.1), ("sparse", 0.6)):
        for path in ("x", "y", None, ""):
            for _ in range(1 if host == "sparse" else int(draw.integers(3, 20))):
                score = float(np.clip(draw.normal(share, 0.15), 0.01, 0.99))
                label = float(draw.random() < share) if draw.random() < 0.3 else None
                rows.append((len(rows), host, path, score, label))
    table = spark.createDataFrame(rows, "doc_id long, host string, path string, score double, label double")
    want = plain_posteriors(rows)
    for r in classifier.posteriors(table).collect():
        assert np.allclose([r.host_posterior, r.path_posterior, r.quality], want[r.doc_id], atol=1e-9), r
    # Null and empty sites are apart: their posteriors follow their own shares.
    means = {host: np.mean([want[i][0] for i, h, *_ in rows if h == host]) for host in (None, "")}
    assert means[None] > 0.6 > 0.4 > means[""]


def test_classifier_takes_awkward_rows(spark, data):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    found = classifier.classify(samples.table(spark, data), labels, F.col("source"), F.col("lang"))
    assert found.count() == len(data)
    for known, score in ((labels.filter("quality = 1"), 1.0), (labels.limit(0), 0.5)):
        same = classifier.classify(samples.table(spark, data), known, F.col("source"), F.col("lang")).collect()
        assert len(same) == len(data) and {r.score for r in same} == {score}
    assert classifier.classify(samples.table(spark, []), labels, F.col("source"), F.col("lang")).count() == 0


def order(rows):
    import xxhash

    def place(row):
        text = (row[1] or "").encode()
        digest = xxhash.xxh64_intdigest(text, 42)
        return (row[0] is None, -(row[0] or 0), digest - (1 << 64) if digest >> 63 else digest)

    return sorted(rows, key=place)


@pytest.mark.parametrize("size", [0, 1, 2, None])
def test_fingerprints_with_edits(spark, data, size):
    rows = data[:size]
    ordered = order(rows)
    want = []
    for k, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        changed = minhash.edited(text, following)
        a, b, c = (minhash.fingerprint(x.encode()) for x in (text, changed, following))
        want.append((str(doc_id), len(text), hashlib.sha256(changed.encode()).hexdigest(), bytes(a), bytes(b), minhash.likeness(a, b), minhash.likeness(a, c)))
    found = minhash.fingerprints_with_edits(samples.table(spark, rows, clash=True)).collect()
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint), r.near_edited, r.near_next) for r in found]
    assert sorted(got) == sorted(want)


def shingles(text):
    own = text.lower().split()
    return {tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))}


def test_likeness_follows_the_common_shingles():
    apart = []
    for seed in range(60):
        own = samples.prose(seed, 40 + 20 * seed).split()
        other = own[: len(own) * (seed % 10) // 10] + samples.prose(seed + 500, 200).split()
        a, b = " ".join(own), " ".join(other)
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        apart.append(minhash.likeness(minhash.fingerprint(a.encode()), minhash.fingerprint(b.encode())) - true)
    assert abs(sum(apart) / len(apart)) < 0.02 and max(map(abs, apart)) < 0.15
    same = minhash.fingerprint(b"A  b c")
    assert same == minhash.fingerprint(b"a b\nC") and minhash.likeness(same, same) == 1
    assert minhash.likeness(minhash.fingerprint(b""), minhash.fingerprint(b" \n")) == 1


PAGES = [
    (5, "http://a.example/x y\r\nz", "<p>one</p>"), (3, "http://b.example/é", "<p>one</p>"), (4, None, "<p>two</p>\r\n\r\nWARC/1.1\r\n"),
    (3, "http://c.example/", "<p>one</p>"), (7, "http://d.example/", None), (2, "http://e.example/", ""), (None, "http://f.example/", "<p>one</p>"),
    (None, None, "alone"), (9, "http://g.example/", "x" * 700_000), (10, "http://g.example/", "ü" * 300_000), (11, "u", "x" * 700_000),
]


def page_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "'r' AS record_id")


@pytest.mark.parametrize("least", [0, 100])
def test_archive(spark, least):
    found = warc.archive(spark, page_table(spark, PAGES), min_bytes=least).collect()
    first = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        own = len(body) < least or first.get(html or "") in (None, page_id)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((str(page_id), len(body), digest, "response" if own else "revisit", None if own else first[html or ""]))
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len({r.record_id for r in found}) == len(PAGES)


def test_many_tasks_read_the_frames(spark, tmp_path):
    long = F.concat(F.col("id").cast("string"), F.repeat(F.lit(samples.prose(1, 100)), 900))
    pages = spark.range(64).select(F.col("id").alias("page_id"), F.lit("https://x").alias("url"), long.alias("html"))
    index = warc.write(pages.repartition(3), f"file://{tmp_path}")
    assert index.select("bundle", "frame").distinct().count() == 64
    records = warc.read(index.select("bundle").distinct())
    tasks = records.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 64
    assert max(r["count"] for r in tasks) < 24


def test_records_are_found_by_their_place(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", samples.prose(i, 3000)) for i in range(40)]
    index = warc.write(page_table(spark, rows), str(tmp_path / "out"))
    assert index.select("bundle", "frame").distinct().count() > 1
    wanted = index.filter("page_id % 7 = 0").select("record_id")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.fetch(index, wanted).collect()}
    assert got == {i: html for i, _, html in rows if i % 7 == 0}


def test_bundles_are_plain_zstandard(spark, tmp_path):
    index = warc.write(page_table(spark, PAGES), str(tmp_path / "out"))
    for path in {r.bundle for r in index.collect()}:
        with pyarrow.fs.LocalFileSystem().open_input_file(path) as file:
            table = warc.read_seek_table(file, file.size())
            file.seek(0)
            packed = file.read()
        plain = b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(packed[a:a + n]) for a, n in table)
        assert plain.startswith(warc.VERSION) and sum(n for _, n in table) < len(packed)


def test_empty_tables(spark):
    none = samples.table(spark, [])
    assert mixing.draws(none).count() == 0 and mixing.mixed(none).count() == 0
    assert warc.archive(spark, page_table(spark, [])).count() == 0
