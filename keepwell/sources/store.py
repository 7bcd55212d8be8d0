"""Writing and reading the derived tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.operators.constraints import insert_if_absent, split_by_rules
from keepwell.sources.ledger import Ledger
from keepwell.sources.schemas import KEYS, RULES


def write_fact(df: DataFrame, path: str, day: str, key: str) -> None:
    """Store a fact table by date range, sorted by date and key, so that each file covers few days and a
    window scan skips the others by their statistics."""
    df.repartitionByRange(day, key).sortWithinPartitions(day, key).write.mode("overwrite").parquet(path)


def write_matrix(matrix: DataFrame, path: str, version: str | None = None) -> None:
    """Store the matrix by cutoff, replacing only the cutoffs it holds; sorted by customer within files."""
    rows = matrix if version is None else matrix.withColumn("pipeline_version", F.lit(version))
    (
        rows.repartition("cutoff_date", F.pmod(F.xxhash64("customer_id"), F.lit(_files(rows))))
        .sortWithinPartitions("cutoff_date", "customer_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("cutoff_date")
        .parquet(path)
    )


def _files(df: DataFrame) -> int:
    """Files per cutoff: as many as there are shuffle partitions, so that one cutoff is not one task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def read_matrix(spark: SparkSession, path: str, cutoff: date | None = None) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored if cutoff is None else stored.filter(F.col("cutoff_date") == F.lit(cutoff))


def write_labels(labels: DataFrame, path: str) -> None:
    labels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cutoff_date").parquet(path)


def append_new(spark: SparkSession, rows: DataFrame, path: str, table: str, order: list[str]) -> None:
    """Append the valid rows whose key the stored table does not hold yet.

    A plain append: if it fails and is repeated, files of the first attempt may stay. ``commit_new`` is safe to repeat.
    """
    stored = spark.read.parquet(path)
    fresh = insert_if_absent(stored, rows, KEYS[table], order, RULES.get(table, ()))
    fresh.write.mode("append").parquet(path)


def commit_new(ledger: Ledger, batch: str, rows: DataFrame, table: str, order: list[str]) -> bool:
    """Append the valid rows whose key the ledger does not hold yet; a batch that is repeated after a failure adds nothing twice."""
    valid = split_by_rules(rows, RULES[table])[0] if table in RULES else rows
    return ledger.commit(batch, valid, order)


def prediction_log(predicted: DataFrame) -> DataFrame:
    """Predictions in the shape of the log, with the time of the statement."""
    return predicted.select(
        "customer_id",
        F.current_timestamp().alias("prediction_date"),
        "model_version",
        "churn_probability",
        "churn_flag",
        "decision_threshold",
        F.col("recommended_action").alias("action_triggered"),
    )


def append_predictions(log: DataFrame, path: str) -> DataFrame:
    """Append the predictions that keep the rules of the log; returns those that break one, with the rules.

    A plain append, not to be repeated; ``scoring.log_once`` and ``commit_new`` log each key once.
    """
    accepted, broken = split_by_rules(log, RULES["ml_predictions_log"])
    accepted.withColumn("prediction_day", F.to_date("prediction_date")).write.mode("append").partitionBy(
        "prediction_day"
    ).parquet(path)
    return broken


def preview(df: DataFrame, *order: str, rows: int = 10) -> DataFrame:
    """The first rows by ``order``."""
    return (df.orderBy(*order) if order else df).limit(rows)
