"""From documents to token ids: rules, line dedup, near-duplicates, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. ``run`` writes the result of a
stage to the shared folder, reads it again for the next one, and deletes what the stage before had written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import bpe, line_dedup, mixing, quality_rules, simhash
from keepwell.llm.shared import release, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base figures and all rules let pass."""
    return quality_rules.keep_good(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them hold."""
    return line_dedup.without_shared_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates."""
    return simhash.keep_first(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them, once at least."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the text that they decode to."""
    automaton = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.round_trip(docs, automaton, "doc_id", "source", ids="ids")


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_shared_lines),
    ("simhash", one_of_each_group),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

#: SQL cannot express the fingerprints and the encoding; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
