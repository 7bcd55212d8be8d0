"""Token counts by a two-tier lookup on the map side.

The vocabulary of a sentencepiece BPE with white space marks is checked: no piece holds a mark after another character, and
none holds a line feed. Then no merge crosses from another character to a mark, or a line feed, and the tokens of a
text are those of its pre-tokens.

* The first tier is a table of the lengths of frequent pre-tokens, fitted on a sample of documents, broadcast to all
  workers. It has at most ``FREQUENT`` entries of at most ``SHORT`` characters.
* What it misses is encoded by the library once and kept in a bounded table of the worker.

No pre-token of the corpus is shuffled; only the sample's counts are, at most ``FREQUENT`` for each of its partitions.
The sample decides how fast the lookup is, never its result.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.shared import pieces

MARK = "▁"
FREQUENT = 32_768
SHORT = 64
SAMPLE_DOCS = 2_000
CACHED = 200_000
PRE_TOKENS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")


class Lengths(dict):
    """Pre-token to number of tokens: the frequent ones, then the worker's own, then the library."""

    def __init__(self, model: bytes, frequent: dict[str, int]):
        super().__init__(frequent)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.room = len(frequent) + CACHED
        self.frequent = frequent

    def __missing__(self, token: str) -> int:
        # Behind a line feed there is no mark that the library adds; it and the feed are a token each.
        length = len(self.library.encode("\n" + token)) - 2
        if len(token) <= SHORT:
            if len(self) >= self.room:
                self.clear()
                self.update(self.frequent)
            self[token] = length
        return length

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKENS.findall(MARK + text.replace(" ", MARK)) if text else []


def check_model(model: bytes) -> None:
    """Refuse a model whose pieces can cross the bounds of pre-tokens, or that changes a text before it."""
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if library.is_control(i) or library.is_byte(i) or library.is_unknown(i):
            continue
        if "\n" in piece or " " in piece or re.search(f"[^{MARK}]{MARK}", piece):
            raise ValueError(f"piece {piece!r} crosses the bounds of pre-tokens")
    probe = "  ﬁ ① é  A\t"
    if library.decode(library.encode(probe)) != probe or library.encode("") != []:
        raise ValueError("the model changes texts before it splits them")


def frequent_lengths(docs: DataFrame, model: bytes, sample_docs: int = SAMPLE_DOCS, frequent: int = FREQUENT) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of about ``sample_docs`` documents."""
    rows = docs.count()
    if not rows:
        return {}
    sample = docs.select("text").sample(min(1.0, sample_docs / rows), 7)

    def run(batches):
        lengths, seen = Lengths(model, {}), Counter()
        for batch in pieces(batches):
            for text in batch.column("text").to_pylist():
                seen.update(t for t in pre_tokens(text or "") if len(t) <= SHORT)
                if len(seen) > 8 * frequent:
                    seen = Counter(dict(seen.most_common(frequent)))
        found = seen.most_common(frequent)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64()),
             pa.array([lengths[t] for t, _ in found], pa.int32())],
            ["token", "n", "length"],
        )

    counted = sample.mapInArrow(run, "token string, n long, length int").groupBy("token")
    seen = counted.agg(F.sum("n").alias("n"), F.first("length").alias("length")).filter("n > 1")
    # The sample bounds these rows; from one partition the driver gets the best of them only once.
    best = seen.coalesce(1).orderBy(F.desc("n"), "token").limit(frequent)
    return {r.token: r.length for r in best.collect()}


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; a null text counts as empty, with no tokens.

    Repeated rows and null doc_ids stay; other columns are ignored; an empty table gives an empty one.
    """
    model = Path(model_path).read_bytes()
    check_model(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent_lengths(rows, model)))

    def run(batches):
        lengths = Lengths(*shared.value)
        for batch in pieces(batches):
            texts = batch.column("text")
            counts = np.array([lengths.count(t) for t in texts.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.compute.binary_length(texts.cast(pa.binary())).cast(pa.int64()),
                 pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
