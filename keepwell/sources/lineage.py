"""Fingerprints, lineage records and the model registry."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from keepwell.operators.learning import TrainedModel

LINEAGE = (
    "artifact string, path string, rows bigint, columns array<string>, fingerprint string, "
    "churn_rate double, cutoff_date date, recorded_at timestamp"
)
REGISTRY = (
    "version string, path string, threshold double, features array<string>, "
    "facts map<string,double>, metrics map<string,double>, recorded_at timestamp"
)


def _fingerprint(df: DataFrame) -> list[Column]:
    # Fifteen hexadecimal digits of MD5 over the columns as text: any engine can repeat it.
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(df.columns)])
    row_hash = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("fingerprint")
    ]


def fingerprint(df: DataFrame) -> DataFrame:
    """(rows, fingerprint): sum of row hashes. The order of rows does not matter, repeated rows do."""
    return df.agg(*_fingerprint(df))


def lineage_record(df: DataFrame, artifact: str, path: str, cutoff: date | None = None) -> DataFrame:
    """One row that describes an artifact, from one pass over it; the label's mean is its churn rate."""
    rate = F.avg("churn_label") if "churn_label" in df.columns else F.lit(None).cast("double")
    return df.agg(*_fingerprint(df), rate.alias("churn_rate")).select(
        F.lit(artifact).alias("artifact"),
        F.lit(path).alias("path"),
        "rows",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        "fingerprint",
        "churn_rate",
        F.lit(cutoff).cast("date").alias("cutoff_date"),
        F.current_timestamp().alias("recorded_at"),
    )


def record(df: DataFrame, artifact: str, path: str, lineage_path: str, cutoff: date | None = None) -> None:
    lineage_record(df, artifact, path, cutoff).write.mode("append").parquet(lineage_path)


def latest_records(lineage: DataFrame) -> DataFrame:
    """The newest record of each artifact."""
    rest = [c for c in lineage.columns if c != "artifact"]
    newest = F.max_by(F.struct(*rest), "recorded_at").alias("_row")
    return lineage.groupBy("artifact").agg(newest).select("artifact", "_row.*")


def as_manifest(records: DataFrame) -> DataFrame:
    """(artifact, entry) with each record as a JSON text."""
    rest = [c for c in records.columns if c != "artifact"]
    return records.select("artifact", F.to_json(F.struct(*rest)).alias("entry"))


def from_manifest(manifest: DataFrame) -> DataFrame:
    """The records behind the JSON texts of a manifest."""
    entry = ", ".join(f for f in LINEAGE.split(", ") if not f.startswith("artifact "))
    return manifest.select("artifact", F.from_json("entry", entry).alias("entry")).select("artifact", "entry.*")


def save_model(spark: SparkSession, model: TrainedModel, folder: str, metrics: dict[str, float] | None = None) -> str:
    """Save the pipeline with a record of it, and append that record to the registry; returns the model's path.

    A version is saved once: a path that exists is an error.
    """
    path = f"{folder}/models/churn_{model.version}"
    model.pipeline.write().save(f"{path}/pipeline")
    row = (
        model.version, path, model.threshold, list(model.features),
        {k: float(v) for k, v in model.facts.items()},
        {k: float(v) for k, v in (metrics or {}).items() if v is not None},
        datetime.now(timezone.utc),
    )
    entry = spark.createDataFrame([row], REGISTRY)
    entry.write.parquet(f"{path}/record")
    entry.write.mode("append").parquet(f"{folder}/registry")
    return path


def _newest(spark: SparkSession, path: str) -> Row | None:
    try:
        entries = spark.read.schema(REGISTRY).parquet(path)
    except AnalysisException:
        return None
    return entries.orderBy(F.desc("version"), F.desc("recorded_at")).first()


def load_latest_model(spark: SparkSession, folder: str) -> TrainedModel:
    """The model of the highest registered version; without a registry, of the highest version saved."""
    row = _newest(spark, f"{folder}/registry") or _newest(spark, f"{folder}/models/*/record")
    if row is None:
        raise FileNotFoundError(f"no model saved in {folder}")
    pipeline = PipelineModel.load(f"{row['path']}/pipeline")
    return TrainedModel(pipeline, row["threshold"], row["version"], tuple(row["features"]), dict(row["facts"]))
