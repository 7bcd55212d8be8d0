"""What the operators share: words and shingles, stored intermediate tables, ranks within groups."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keepwell.session import shared_folder

#: The white space that separates words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[ \t\n\x0B\f\r]+"

_kept: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder of the shared checkpoint folder; removed when Python ends while its session lives."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _kept.append((spark, path))
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate folders."""
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _discard_all() -> None:
    for spark, path in _kept:
        if spark.sparkContext._jsc is not None:
            discard(spark, path)


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of tables from ``stored`` that later ones have replaced. No DataFrame may read them any more."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            discard(df.sparkSession, path)
            _kept[:] = [kept for kept in _kept if kept[1] != path]


def filtered(df: DataFrame, condition: str) -> DataFrame:
    """The rows that meet ``condition``, decided after the projections below and not inside them.

    A filter over a computed column is otherwise pushed down with its expression copied in, and an array that an
    inner function reads is then built again for each of its elements. Row ids are not deterministic, which holds it.
    """
    held = df.withColumn("_held", F.monotonically_increasing_id())
    return held.filter(F.expr(condition) & (F.col("_held") >= 0)).drop("_held")


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order; none for a null or blank text."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def shingle_hashes(text: bytes, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words of a UTF-8 text, A-Z in lower case, repeats included.

    A text with fewer words gives one shingle, one without words gives none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:].tolist()))
    return np.fromiter(found, np.uint64, len(starts))


def change_points(*columns: np.ndarray) -> np.ndarray:
    """Start of every run of equal rows in sorted columns."""
    size = len(columns[0])
    if not size:
        return np.empty(0, np.int64)
    new = np.zeros(size, bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def numbered(df: DataFrame, group: list[str], spread: Column, order: list[Column], name: str, buckets: int = 1024) -> DataFrame:
    """Gapless number from 0 of each row within its group, ordered by bucket and then by ``order``.

    Rows of a group are dealt to ``buckets`` by ``spread``. Bucket counts are summed up within a group, so no
    task sorts more than one bucket of one group.
    """
    dealt = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("_place", place)
        .join(offsets, [*group, "_bucket"])
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_bucket", "_place", "_before")
    )


def pieces(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches cut into short ones, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrays(batches: Iterator, *names: str) -> Iterator[list[np.ndarray]]:
    """The named columns of Arrow batches as NumPy arrays."""
    for batch in batches:
        yield [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def top_rows(df: DataFrame, group: list[str], order: list[Column], count: int, parts: int, fan: int = 64) -> DataFrame:
    """The first ``count`` rows of each group, with ``rank`` from 1; ties beyond ``order`` fall as they come.

    ``parts`` is about how many tasks bring rows of one group. They are merged in steps, so that no window holds more
    than a few times ``fan * count`` rows.
    """
    step = df
    while parts > 1:
        parts = -(-parts // fan)
        dealt = step.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        place = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
        step = dealt.withColumn("rank", place).filter(F.col("rank") <= count).drop("_part", "rank")
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return step.withColumn("rank", place).filter(F.col("rank") <= count)
