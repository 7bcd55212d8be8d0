"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base figures are computed for every document. The rules that follow are independent of each other, so their order does
not change a verdict, only how much is computed: the cascade is one ``CASE`` that stops at the first rule that
rejects. The order comes from a sample of documents: the time that a rule takes on it, and the share that it rejects.
Rules with many rejections for their cost come first.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.llm.shared import SPACE, filtered, stored, words_of

WINDOW = 8
SAMPLE_DOCS = 2_000
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """A name and the condition that rejects, over the columns ``text``, ``words`` and the base figures."""

    name: str
    rejects: Callable[[], Column]


def _count(pattern: str) -> Column:
    """Number of characters of a text outside the runs that ``pattern`` matches."""
    return F.length(F.regexp_replace("text", pattern, ""))


#: Each share is compared in whole numbers, so that no rounding decides.
RULES = (
    Rule("mean_word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("duplicate_lines", lambda: 10 * F.col("n_dup_lines") > 5 * F.size(F.split("text", "\n", -1))),
    Rule("exclamations", lambda: 10 * _count("[^!]+") > 5 * F.col("n_words")),
    Rule("capitals", lambda: 10 * _count(r"[^\p{Lu}]+") > 5 * F.col("word_chars")),
    Rule("letters", lambda: 10 * _count(r"[^\p{L}]+") < 5 * F.col("word_chars")),
    Rule("wordless", lambda: 10 * F.size(F.filter("words", lambda w: ~w.rlike(r"\p{L}"))) > 4 * F.col("n_words")),
)


def base_figures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``text`` (null: empty), ``words``, the base figures and ``base_failed``."""
    text = F.coalesce("text", F.lit(""))
    worded = docs.select(*keep, text.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))
    figures = worded.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.when(F.size("words") > WINDOW, hashes).alias("_hashes"),
    ).select(
        "*", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines")
    ).drop("_lines")
    # Windows that occur again, found as neighbours in sorted order; only texts that have any get this far.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    figures = figures.select("*", F.when(repeats, placed).alias("_placed")).drop("_hashes")

    def again(x: Column, i: Column) -> Column:
        before, after = F.get("_placed", i - 1)["h"], F.get("_placed", i + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    twice = F.sort_array(F.transform(F.filter("_placed", again), lambda x: x["i"]))
    figures = figures.select("*", twice.alias("_twice")).drop("_placed")
    gaps = F.zip_with(
        F.slice("_twice", F.lit(2), F.size("_twice")), "_twice", lambda b, a: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))
    )
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda s, x: s + x), F.lit(0))
    figures = figures.withColumn("n_repeat_words", covered.cast("long")).drop("_twice")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return figures.withColumn("base_failed", failed)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_docs: int = SAMPLE_DOCS) -> list[Rule]:
    """The rules by rejections per second on about ``sample_docs`` documents that pass the base figures."""
    rows = docs.count()
    if not rows:
        return list(rules)
    sampled = docs.select("text").sample(min(1.0, sample_docs / rows), 7)
    sample = stored(base_figures(sampled, []), "rules").filter(~F.col("base_failed"))

    def timed(condition: Column) -> tuple[float, int]:
        start = time.perf_counter()
        count = sample.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - start, count

    # Whole numbers of all columns that rules read: what a rule costs beyond reading them.
    idle = F.length("text") + F.size("words") + F.col("word_chars") + F.col("n_symbols") + F.col("n_dup_lines") < 0
    timed(idle)
    floor, _ = timed(idle)
    gain = {}
    for rule in rules:
        seconds, rejected = timed(rule.rejects())
        gain[rule.name] = rejected / max(seconds - floor, 1e-3)
    return sorted(rules, key=lambda r: -gain[r.name])


def judge(docs: DataFrame, keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row's columns ``keep`` (all: packed as ``row``), base figures, ``base_failed``, ``kept`` and ``rejected_by``.

    ``rejected_by`` names the first rule that rejected, in the order of this run. A null or blank text has no words and fails
    the base figures. Rows that repeat are judged each; an empty table gives an empty one.
    """
    source = docs.select(F.struct("*").alias("row"), "text") if keep is None else docs.select(*keep, F.col("text").alias("text"))
    named = ["row"] if keep is None else keep
    figures = base_figures(source, named)
    cascade = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order_rules(docs, rules):
        cascade = cascade.when(rule.rejects(), F.lit(rule.name))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return figures.select(*named, *shown, cascade.alias("rejected_by")).withColumn("kept", F.col("rejected_by").isNull())


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, all columns as they are."""
    return filtered(judge(docs), "kept").select("row.*")
