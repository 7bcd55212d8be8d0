"""Train and test parts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from keepwell.operators.ranking import with_position


def with_holdout(matrix: DataFrame, train_share: float = 0.80, key: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Column ``split``: the first ``int(train_share * n)`` rows by ``key``, which is unique, are ``train``.

    Only the keys are ranked, to find the last one of the training part; the rows stay where they are.
    """
    placed = with_position(matrix.select(*key), *[F.asc(c) for c in key])
    edge = F.floor(F.col("total_rows") * F.lit(float(train_share)))
    last = placed.filter(F.col("position") == edge - 1).select(*key).first()
    if last is None:
        return matrix.withColumn("split", F.lit("test"))
    types = {f.name: f.dataType for f in matrix.schema.fields}
    bound = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in key])
    return matrix.withColumn("split", F.when(F.struct(*key) <= bound, "train").otherwise("test"))


def with_cutoff_split(matrix: DataFrame, test_from: date) -> DataFrame:
    """Column ``split`` by cohort: cutoffs before ``test_from`` train."""
    return matrix.withColumn("split", F.when(F.col("cutoff_date") < F.lit(test_from), "train").otherwise("test"))


def expanding_folds(matrix: DataFrame, cutoffs: Sequence[date], folds: int = 5) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Fold i trains on the cohorts before its test cohort; the last ``folds`` cohorts test."""
    ordered = sorted(set(cutoffs))
    for at in range(max(1, len(ordered) - folds), len(ordered)):
        yield (
            matrix.filter(F.col("cutoff_date") < F.lit(ordered[at])),
            matrix.filter(F.col("cutoff_date") == F.lit(ordered[at])),
        )


def fold_sizes(matrix: DataFrame, cutoffs: Sequence[date], folds: int = 5) -> DataFrame:
    """(fold, test_cutoff, train_rows, test_rows, train_positives, test_positives); one pass for all folds."""
    ordered = sorted(set(cutoffs))
    tests = ordered[max(1, len(ordered) - folds):]
    day, truth = F.col("cutoff_date"), F.col("churn_label") == 1
    counts = []
    for i, test in enumerate(tests):
        before, at = day < F.lit(test), day == F.lit(test)
        for name, condition in (
            ("train_rows", before), ("test_rows", at), ("train_positives", before & truth), ("test_positives", at & truth)
        ):
            counts.append(F.count(F.when(condition, True)).alias(f"{name}_{i}"))
    rows = [
        F.struct(
            F.lit(i + 1).alias("fold"),
            F.lit(test).alias("test_cutoff"),
            *[F.col(f"{n}_{i}").alias(n) for n in ("train_rows", "test_rows", "train_positives", "test_positives")],
        )
        for i, test in enumerate(tests)
    ]
    return matrix.agg(*counts).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def stratified_folds(matrix: DataFrame, folds: int = 5, key: Sequence[str] = ("customer_id",), label: str = "churn_label", seed: int = 0) -> DataFrame:
    """Column ``fold`` from 1: rows of each class are dealt out in a seeded hash order, so folds differ by one row per class at most.

    ``key`` is unique. A null label is a class of its own. Only keys and labels are ranked, over range partitions.
    """
    if folds < 2:
        raise ValueError("two folds at least")
    slim = matrix.select(*key, F.col(label).alias("_class"), F.xxhash64(F.lit(seed), *key).alias("_hash"))
    placed = with_position(slim, F.asc_nulls_first("_class"), F.asc("_hash"), *[F.asc(c) for c in key])
    # One row per class.
    starts = placed.groupBy("_class").agg(F.min("position").alias("_start")).collect()
    start = F.coalesce(*[F.when(F.col("_class").eqNullSafe(F.lit(r["_class"])), F.lit(r["_start"])) for r in starts]) if starts else F.lit(0)
    dealt = placed.select(*key, ((F.col("position") - start) % folds + 1).cast("int").alias("fold"))
    return matrix.join(dealt, list(key))


def fold_parts(folded: DataFrame, folds: int = 5) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Train and test rows of each fold of ``stratified_folds``."""
    for fold in range(1, folds + 1):
        yield folded.filter(F.col("fold") != fold).drop("fold"), folded.filter(F.col("fold") == fold).drop("fold")
