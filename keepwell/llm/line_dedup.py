"""Line deduplication over levelled sorted runs of line hashes.

Documents are taken in batches. The distinct line keys of a batch, with the number of its documents that hold them,
form a sorted run, written in sorted buckets by key. A new batch is merge-anti-joined with the keys that the runs have settled
already (seen in enough documents): the batch is dealt into the same buckets, the runs stay where they are. The rest is added
as a run of its own. When a level holds ``FANOUT`` runs they are compacted, counts added up, into one run of the next level. At
the end the runs are merged once, and lines whose key was found in at least ``min_docs`` documents are dropped from every
document.

A key is 16 bytes of MD5; a line that many documents share is counted before its shuffle and meets the documents
again in a join whose small side holds settled keys only.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.llm.shared import SPACE, lower_ascii, scratch_path, stored

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2


def lines_of(text: Column) -> Column:
    """Lines between line feeds; a null text is one empty line, like an empty one."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """Of every line, what is left without white space at both ends and with A-Z in lower case.

    In steps, since what a lambda names twice is worked out twice.
    """
    return F.transform(F.transform(lines_of(text), lambda x: F.btrim(x, F.lit(SPACE))), lower_ascii)


def _hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def line_hashes(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """Hashes of the distinct keys of a text that have at least ``min_chars`` code points."""
    keys = line_keys(text)
    # Distinct as strings: Spark compares binary values of an array pair by pair.
    return F.transform(F.array_distinct(F.transform(F.filter(keys, lambda k: F.length(k) >= min_chars), F.md5)), F.unhex)


def _row_id() -> tuple[Column, Column]:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.xxhash64(F.col("text"))


class _Runs:
    """Runs of one pass: tables in as many sorted buckets by line, so that a batch meets them in a merge that moves no run."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def add(self, run: DataFrame) -> str:
        """Write a run; returns its name."""
        name, path = f"run_{uuid.uuid4().hex}", scratch_path(self.spark, "run")
        dealt = run.select("line", "n").repartition(self.buckets, "line")
        writer = dealt.write.bucketBy(self.buckets, "line").sortBy("line").format("parquet")
        writer.option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def without_settled(self, fresh: DataFrame, name: str, min_docs: int) -> DataFrame:
        """The lines of ``fresh`` that the run has not counted ``min_docs`` times."""
        return fresh.join(self.spark.table(name).filter(F.col("n") >= min_docs).hint("merge"), "line", "left_anti")

    def merged(self, names: list[str]) -> DataFrame:
        """One run for several, counts added up.

        The files are read as they are: over bucketed tables Spark 4.1 leaves out the exchange between a union and its
        aggregate, though the union does not put equal buckets together.
        """
        plain = [self.spark.read.schema("line binary, n long").parquet(self.paths[name]) for name in names]
        return reduce(DataFrame.union, plain).groupBy("line").agg(F.sum("n").alias("n"))

    def forget(self) -> None:
        """Drop the names of the tables; their files are in the scratch folder."""
        for name in self.paths:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def shared_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``(line)``: hashes of the keys that at least ``min_docs`` documents hold. Every row is a document."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64(*_row_id()), F.lit(batches)).cast("int").alias("batch")
    # Hashes first and rows of lines then, or every line would carry the whole text.
    each = docs.select(batch, line_hashes(F.col("text"), min_chars).alias("lines")).select("batch", F.explode("lines").alias("line"))
    counted = each.groupBy("batch", "line").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "lines")
    counted.write.partitionBy("batch").parquet(path)
    arrived = spark.read.schema("line binary, n long, batch int").parquet(path)

    runs = _Runs(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        levels: list[list[str]] = [[]]
        for number in range(batches):
            fresh = arrived.filter(F.col("batch") == number).drop("batch")
            for run in [run for level in levels for run in level]:
                fresh = runs.without_settled(fresh, run, min_docs)
            levels[0].append(runs.add(fresh))
            for depth, level in enumerate(levels):
                if len(level) >= fanout:
                    if depth + 1 == len(levels):
                        levels.append([])
                    levels[depth + 1].append(runs.add(runs.merged(level)))
                    level.clear()
        merged = runs.merged([run for level in levels for run in level])
        return stored(merged.filter(F.col("n") >= min_docs).select("line"), "shared")
    finally:
        runs.forget()


def drop_shared_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, with ``n_lines``, ``n_dropped`` and ``kept_text``.

    ``n_lines`` counts before dropping. A null or empty text is one empty line, which has no key and stays. Repeated
    rows count as documents of their own, null doc_ids too. Columns of ``docs`` keep their names inside ``row``. The work on a
    text is linear in its lines: what is dropped is a set of positions.
    """
    gone = shared_lines(docs, min_docs, min_chars, batches, fanout)
    number, content = _row_id()
    every = F.transform(line_keys(F.col("text")), lambda k: F.when(F.length(k) >= min_chars, _hash(k)))
    # Equal rows have equal lines: one of them tells the positions for all.
    places = docs.select(number.alias("_id"), content.alias("_hash"), every.alias("_every")).select(
        "_id", "_hash", F.posexplode("_every").alias("place", "line")
    )
    holders = (
        places.filter("line is not null").join(gone, "line", "left_semi")
        .groupBy("_id", "_hash").agg(F.collect_set("place").alias("_gone"))
    )
    split = (
        docs.select(F.struct("*").alias("row"), number.alias("_id"), content.alias("_hash"))
        .join(holders, ["_id", "_hash"], "left")
        # Named twice below, so the lines are split once and not for each of them.
        .select("row", "_gone", lines_of(F.col("row.text")).alias("_lines"))
        .select("row", "_gone", "_lines", F.size("_lines").alias("_size"))
    )
    stays = F.array_except(F.sequence(F.lit(0), F.col("_size") - 1), F.col("_gone"))
    out = split.select(
        "row", "_size", F.when(F.col("_gone").isNotNull(), F.transform(stays, lambda at: F.get("_lines", at))).alias("_stays"),
        F.size("_lines").alias("_again"),
    )
    return out.select(
        "row", F.col("_size").cast("long").alias("n_lines"),
        F.when(F.col("_stays").isNull(), F.lit(0)).otherwise(F.col("_size") - F.size("_stays")).cast("long").alias("n_dropped"),
        F.when(F.col("_stays").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(F.array_join("_stays", "\n")).alias("kept_text"),
    )


def without_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents with the kept lines as their text and, where there is such a column, ``n_chars`` to match.

    A document that loses no line stays as it is, a null text too; one that loses all of them has an empty text.
    """
    kept = drop_shared_lines(docs, min_docs, min_chars)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    chars = F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    changed = {"text": text, "n_chars": chars}
    return kept.select(*[(changed.get(c) if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])
