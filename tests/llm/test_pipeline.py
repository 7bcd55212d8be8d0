"""The pipeline, stage by stage and as a whole, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import samples
from pyspark.sql import functions as F
from test_simhash import brute_classes, brute_print
from test_texts import REPEATS, dropped, figures
from tokenizers import Tokenizer

SHARED = "\n".join(["A license line of all", "And one more"])


@pytest.fixture(scope="module")
def data():
    named = [r for r in samples.rows() if r[0] not in (None, 2001)]
    more = [(9000 + i, f"{SHARED}\n{samples.prose(300 + i, 40)}", "en", "s1", 0) for i in range(14)]
    return named + REPEATS + more


def good(text):
    own = (text or "").encode().split()
    n, chars, symbols, duplicates, _, base = figures(text)
    text = text or ""
    wordless = sum(not any(c.isalpha() for c in w.decode()) for w in own)
    letters, capitals = (sum(map(f, text)) for f in (str.isalpha, str.isupper))
    return not (
        base or chars < 2 * n or chars > 20 * n or 10 * symbols > 3 * n or 10 * duplicates > 5 * len(text.split("\n"))
        or 10 * text.count("!") > 5 * n or 10 * capitals > 5 * chars or 10 * letters < 5 * chars or 10 * wordless > 4 * n
    )


def cleaned(data):
    kept = {i: text for i, _, _, text in dropped(data, 10)}
    return [(i, kept[str(i)], *rest) for i, _, *rest in data]


def first_of_each(data):
    classes = brute_classes([brute_print(r[1]) for r in data])
    least = {}
    for c, r in zip(classes, data):
        least[c] = min(least.get(c, r), r, key=lambda x: x[0])
    return list(least.values())


def copies(data, limit=1.5):
    words = {r[0]: max(1, len((r[1] or "").encode().split())) for r in data}
    tokens = Counter()
    for i, _, _, source, _ in data:
        tokens[source] += words[i]
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}

    def fits(x):
        passes = [p ** x / p for p in share.values()]
        return max(passes) <= limit * min(passes)

    low, high = 0.0, 0.0 if fits(0.0) else 1.0
    for _ in range(20 if high else 0):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    least = min(p ** high / p for p in share.values())
    out = Counter()
    for s, p in share.items():
        whole, rest = divmod(math.floor(p ** high / p / least * tokens[s] + 0.5), tokens[s])
        mine = {r[0]: hashlib.md5((r[1] or "").encode()).hexdigest() for r in data if r[3] == s}
        for i in sorted(mine, key=lambda i: hashlib.md5(f"17:{whole}:{i}:{mine[i]}".encode()).hexdigest()):
            out[i] += whole + (rest > 0)
            rest -= words[i]
    return out


def table(spark, data):
    return samples.table(spark, data, clash=True)


def run_stage(spark, name, data):
    docs = table(spark, data)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    if name != "bpe":
        assert out.columns == docs.columns
    return out.collect()


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash", "mixing", "bpe"]


def test_quality_stage(spark, data):
    assert {r.doc_id for r in run_stage(spark, "quality_rules", data)} == {r[0] for r in data if good(r[1])}


def test_line_stage(spark, data):
    found = {r.doc_id: r.text or "" for r in run_stage(spark, "line_dedup", data)}
    assert found == {r[0]: r[1] for r in cleaned(data)}
    assert not any("license line" in t for t in found.values())


def test_near_duplicate_stage(spark, data):
    assert sorted(r.doc_id for r in run_stage(spark, "simhash", data)) == sorted(r[0] for r in first_of_each(data))


def test_mixing_stage(spark, data):
    named = [(i, t, lang, s or "s9", n) for i, t, lang, s, n in data]
    assert Counter(r.doc_id for r in run_stage(spark, "mixing", named)) == copies(named)


def test_whole(spark, data, tmp_path):
    table(spark, data).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rest = first_of_each(cleaned([r for r in data if good(r[1])]))
    draws, want = copies(rest), []
    for doc_id, text, _, source, _ in rest:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), back.encode())]
        want += [(doc_id, source, len(ids), *sha)] * draws[doc_id]
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)


def test_empty(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
