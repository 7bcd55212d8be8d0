"""Training, scoring and explaining the churn classifier."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from keepwell.operators.boosting import fit_boosted
from keepwell.operators.constraints import require_columns, require_rows
from keepwell.operators.decisions import predictions
from keepwell.operators.evaluation import best_threshold
from keepwell.operators.smote import smote
from keepwell.params import CATEGORICAL_FEATURES, NUMERIC_FEATURES, Oversampling, Params
from keepwell.session import settle, shared_folder

LABEL = "churn_label"
# A hash that puts the rows to fit on in a fixed order.
ORDER = "_order"


@dataclass(frozen=True)
class TrainedModel:
    pipeline: PipelineModel
    threshold: float
    version: str
    features: tuple[str, ...] = NUMERIC_FEATURES + CATEGORICAL_FEATURES
    facts: dict[str, float] = field(default_factory=dict)


def preprocessor(
    numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES
) -> Pipeline:
    """Centred and scaled numerics, then one slot per known category value; unknown values are all zeros.

    The indexer puts unknown values last and the encoder leaves the last slot out. The scaler divides by the
    sample deviation.
    """
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(numeric), outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=list(categorical), outputCols=[f"_{c}_index" for c in categorical],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"_{c}_index" for c in categorical], outputCols=[f"_{c}_slots" for c in categorical],
            dropLast=True,
        ),
        VectorAssembler(inputCols=["_scaled", *[f"_{c}_slots" for c in categorical]], outputCol="features"),
    ])


def class_weight(train: DataFrame, label: str = LABEL) -> tuple[int, int, float]:
    """(negatives, positives, negatives / positives); the weight is 1 without positives."""
    row = train.agg(
        F.count(F.when(F.col(label) == 0, True)).alias("neg"), F.count(F.when(F.col(label) == 1, True)).alias("pos")
    ).first()
    return row["neg"], row["pos"], row["neg"] / row["pos"] if row["pos"] else 1.0


def with_points(encoded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bigint ``point`` and array ``vector``. A single whole-number key is the point itself; other keys are hashed."""
    single = len(key) == 1 and encoded.schema[key[0]].dataType.simpleString() in ("bigint", "int")
    point = F.col(key[0]).cast("bigint") if single else F.xxhash64(*key)
    return encoded.select(point.alias("point"), vector_to_array("features").alias("vector"), LABEL)


def oversampled(
    encoded: DataFrame, key: Sequence[str], settings: Oversampling = Oversampling()
) -> DataFrame:
    """(features, label, order) of the given rows and of the synthetic minority rows. ``encoded`` is stored.

    The rarer class is the minority; equal classes are left as they are.
    """
    negatives, positives, _ = class_weight(encoded)
    rare, rare_rows, common_rows = (1, positives, negatives) if positives < negatives else (0, negatives, positives)
    real = encoded.select("features", F.col(LABEL).cast("double").alias(LABEL), F.xxhash64(*key).alias(ORDER))
    if rare_rows < 2 or rare_rows == common_rows:
        return real
    minority = settle(with_points(encoded.filter(F.col(LABEL) == rare), key).drop(LABEL))
    made = smote(minority, common_rows, settings)
    return real.unionByName(
        made.select(
            array_to_vector("vector").alias("features"), F.lit(float(rare)).alias(LABEL),
            F.xxhash64("point", "copy").alias(ORDER),
        )
    )


def scores(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with the positive-class probability as ``score``."""
    added = [c for c in model.transform(features.limit(0)).columns if c not in features.columns]
    return model.transform(features).withColumn("score", vector_to_array("probability")[1]).drop(*added)


def rows_to_fit(train: DataFrame, key: Sequence[str], rows: int, seed: int) -> DataFrame:
    """At most ``rows`` labelled rows, those first in a seeded hash order of the key. For callers who want few; ``fit`` reads all."""
    return train.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(rows)


def fit(
    train: DataFrame,
    params: Params = Params(),
    key: Sequence[str] = ("customer_id",),
    tune_on: DataFrame | None = None,
) -> TrainedModel:
    """Encode, oversample, boost, and tune the threshold on the training rows or on ``tune_on``.

    All training rows are read. The same rows give the same model however they are spread over tasks.
    """
    require_columns(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    shared_folder(train.sparkSession)
    train = settle(train)
    negatives, positives, weight = class_weight(train)
    encoder = preprocessor().fit(train)
    encoded = settle(encoder.transform(train).select(*key, "features", LABEL))
    weighted = oversampled(encoded, key, params.oversampling).withColumn(
        "_weight", F.when(F.col(LABEL) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
    )
    boosted = fit_boosted(settle(weighted), params.boosting, params.seed, LABEL, "_weight", ORDER)
    pipeline = PipelineModel(stages=[*encoder.stages, boosted])
    threshold = best_threshold(scores(pipeline, train if tune_on is None else tune_on), params.threshold)
    # Two fits within a second keep their own versions.
    version = f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    facts = {
        "n_train": float(negatives + positives),
        "n_pos": float(positives),
        "n_neg": float(negatives),
        "churn_rate_train": positives / (negatives + positives) if negatives + positives else 0.0,
    }
    return TrainedModel(pipeline, threshold, version, facts=facts)


def score(features: DataFrame, model: TrainedModel, key: Sequence[str] = ("customer_id",), empty_ok: bool = True) -> DataFrame:
    """Predictions with flag, action and risk level."""
    require_columns(features, model.features)
    if not empty_ok:
        require_rows(features)
    return predictions(scores(model.pipeline, features), model.threshold, model.version, "score", key)


def feature_importance(
    pipeline: PipelineModel,
    train_like: DataFrame,
    top: int = 15,
    numeric: Sequence[str] = NUMERIC_FEATURES,
) -> DataFrame:
    """(feature, importance) of the most important features, categories as ``column_value``."""
    boosted = pipeline.stages[-1]
    meta = pipeline.transform(train_like.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {}
    for attributes in meta.values():
        for attribute in attributes:
            names[attribute["idx"]] = attribute["name"]
    labelled = {}
    for place, name in names.items():
        if place < len(numeric):
            labelled[place] = numeric[place]
        else:
            labelled[place] = name.replace("_slots_", "_").lstrip("_")
    weights = boosted.featureImportances.toArray()
    spark = train_like.sparkSession
    # One row per model input.
    listed = [(labelled.get(i, f"feature_{i}"), float(w)) for i, w in enumerate(weights)]
    return (
        spark.createDataFrame(listed, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )
