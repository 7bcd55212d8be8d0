import numpy as np
import pytest
import samples
import xxhash

from keepwell.llm import simhash
from keepwell.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(bits, max_bits=4):
    """Least index of each component, all pairs compared."""
    label = list(range(len(bits)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (int(bits[i]) ^ int(bits[j])).bit_count() <= max_bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(bits))]


def cloud(seed, size=400, centres=6):
    """Fingerprints that crowd around a few centres."""
    draw = np.random.default_rng(seed)
    out = draw.integers(0, 1 << 64, centres, dtype=np.uint64)[draw.integers(0, centres, size)]
    for _ in range(5):
        out = out ^ (np.uint64(1) << draw.integers(0, 64, size, dtype=np.uint64)) * draw.integers(0, 2, size, dtype=np.uint64)
    return np.unique(out)


def gray(values):
    for step in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> np.uint64(step))
    return values


@pytest.mark.parametrize("text", ["", " \n", "One two", "one TWO three four", samples.prose(1, 500), "é É ß x\x0by"])
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == brute_print(text)


@pytest.mark.parametrize("leaf", [4, 32])
def test_index_of_a_group(leaf):
    bits = cloud(leaf)
    bits = bits[np.argsort(gray(bits))]
    assert simhash.group_labels(bits, 4, leaf).tolist() == brute_classes(bits)


@pytest.mark.parametrize("group", [16, 16_384])
def test_links_span_the_components(spark, group):
    bits = cloud(7, 300)
    signed = bits.view(np.int64).tolist()
    frame = spark.createDataFrame([(b,) for b in signed], "bits long")
    links = simhash.links_between(frame, group=group)
    assert links.count() < 40 * len(bits)
    found = {r.node: r.root for r in components(links).collect()}
    want = brute_classes(bits)
    classes = {}
    for b, c in zip(signed, want):
        classes.setdefault(c, []).append(b)
    for members in classes.values():
        assert {found.get(b, b) for b in members} == {min(members)}


@pytest.mark.parametrize("clash", [False, True])
def test_documents(spark, clash):
    data = samples.rows()
    found = simhash.near_duplicates(samples.table(spark, data, clash)).collect()
    assert len(found) == len(data)
    bits = [brute_print(text) for _, text, *_ in data]
    classes = brute_classes(bits)
    least = {}
    for c, (doc_id, *_) in zip(classes, data):
        least[c] = min([x for x in (least.get(c), doc_id) if x is not None], default=None)
    want = sorted((str(d), b, str(least[c])) for (d, *_), b, c in zip(data, bits, classes))
    assert sorted((str(r.doc_id), r.bits % (1 << 64), str(r.component_id)) for r in found) == want


def test_one_row_of_each_class_stays(spark):
    docs = samples.table(spark, clash=True)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids))
    classes = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert set(ids) == classes


def test_empty(spark):
    assert simhash.near_duplicates(samples.table(spark, [])).count() == 0
    assert simhash.keep_first(samples.table(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(50)] + [(90, 91), (91, 90), (95, 95)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(51)} | {90: 90, 91: 90}
