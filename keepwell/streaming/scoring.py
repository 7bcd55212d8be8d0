"""Scoring a stream of requests and logging each prediction once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keepwell.operators.constraints import validate_requests
from keepwell.operators.decisions import predictions, with_serving_defaults
from keepwell.operators.learning import TrainedModel, scores
from keepwell.sources.ledger import Ledger

Scorer = Callable[[DataFrame], DataFrame]


def read_requests(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of scoring requests."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_requests(
    requests: DataFrame,
    scorer: Scorer,
    threshold: float,
    version: str,
    key: Sequence[str] = ("customer_id",),
    segments: Sequence[str] | None = None,
) -> DataFrame:
    """Valid requests scored; works on a stream and on a table alike, as no step keeps state.

    ``scorer`` adds the column ``score``. Invalid requests are left out here; ``rejected`` lists them, and ``counted``
    says how many there were of each.
    """
    checked = validate_requests(requests, segments) if segments else validate_requests(requests)
    good = checked.filter(F.size("errors") == 0).drop("errors")
    return predictions(scorer(with_serving_defaults(good)), threshold, version, "score", key)


def rejected(requests: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    checked = validate_requests(requests, segments) if segments else validate_requests(requests)
    return checked.filter(F.size("errors") > 0)


def model_scorer(model: TrainedModel) -> Scorer:
    """Scores by the fitted pipeline; it transforms a stream as it does a table."""
    return lambda requests: scores(model.pipeline, requests)


def counted(requests: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    """One row: requests in total, to be scored, and rejected."""
    checked = validate_requests(requests, segments) if segments else validate_requests(requests)
    good = F.count_if(F.size("errors") == 0)
    return checked.agg(F.count(F.lit(1)).alias("total"), good.alias("scored"), (F.count(F.lit(1)) - good).alias("rejected"))


def once_per_key(scored: DataFrame, key: Sequence[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of event time; older keys are forgotten."""
    return scored.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def log_predictions(scored: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to Parquet, one folder per stream and micro-batch.

    The stream is named by its checkpoint folder: a batch that is run again after a failure overwrites its own folder, so a
    retry adds nothing twice, and a stream that starts over with a new checkpoint never touches the folders of another.
    Requests later than the watermark are dropped by the engine; ``numRowsDroppedByWatermark`` of the query's progress
    counts them.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("stream", F.lit(stream)).withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("stream", "batch")
            .parquet(path)
        )

    writer = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def log_once(scored: DataFrame, ledger: Ledger, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to a ledger: each key once, also beyond the watermark, after a new checkpoint and over several streams.

    A micro-batch is a batch of the ledger, named by the stream and its number; one that is run again finds itself committed.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        ledger.commit(f"{stream}-{batch_id:012d}", batch)

    writer = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
