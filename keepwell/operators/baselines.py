"""Rule baselines over the feature matrix. Each adds nothing but a 0/1 column expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.numeric import share
from keepwell.operators.quantiles import quantiles

# Weights of the composite score.
RFM_WEIGHTS = {"recency_days": 0.5, "frequency_orders": 0.3, "monetary_total": 0.2}


def _none() -> Column:
    return F.lit(0)


def recency_percentile(matrix: DataFrame, percentile: float = 0.75, accuracy: int | None = None) -> Column:
    """Recency at or above the given percentile of this very set."""
    if "recency_days" not in matrix.columns:
        return _none()
    cut = quantiles(matrix, {"recency_days": [percentile]}, accuracy=accuracy)
    value = cut.get((), {}).get("recency_days", {}).get(percentile)
    if value is None:
        return _none()
    return F.coalesce((F.col("recency_days") >= F.lit(value)).cast("int"), _none())


def recency_fixed(matrix: DataFrame, days: float = 60) -> Column:
    if "recency_days" not in matrix.columns:
        return _none()
    return F.coalesce((F.col("recency_days") > days).cast("int"), _none())


def low_frequency(matrix: DataFrame, min_orders: int = 2) -> Column:
    if "frequency_orders" not in matrix.columns:
        return _none()
    return F.coalesce((F.col("frequency_orders") < min_orders).cast("int"), _none())


def rfm_score(matrix: DataFrame, weights: Mapping[str, float] = RFM_WEIGHTS) -> Column:
    """Weighted sum of the min-max scaled columns, frequency and amount inverted; 0..1, high is risk.

    A constant column scales to 0, and weights are shared out over the columns that exist. The ranges are a
    one-row subquery.
    """
    present = [c for c in weights if c in matrix.columns]
    if not present:
        return F.lit(0.0)
    ranges = matrix.agg(
        F.struct(*[x for c in present for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]).alias("r")
    ).scalar()
    total = sum(weights[c] for c in present)
    score = F.lit(0.0)
    for c in present:
        low, high = ranges[f"{c}_lo"], ranges[f"{c}_hi"]
        scaled = F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.lit(0.0))
        part = scaled if c == "recency_days" else F.lit(1.0) - scaled
        score = score + part * F.lit(weights[c] / total)
    return score


def rfm_composite(matrix: DataFrame, threshold: float = 0.60, weights: Mapping[str, float] = RFM_WEIGHTS) -> Column:
    if not any(c in matrix.columns for c in weights):
        return _none()
    return F.coalesce((rfm_score(matrix, weights) >= threshold).cast("int"), _none())


BASELINES: dict[str, Callable[[DataFrame], Column]] = {
    "recency_p75": recency_percentile,
    "recency_60d": recency_fixed,
    "frequency_lt_2": low_frequency,
    "rfm_composite": rfm_composite,
}


def with_baselines(matrix: DataFrame, rules: Mapping[str, Callable[[DataFrame], Column]] = BASELINES) -> DataFrame:
    return matrix.withColumns({name: rule(matrix) for name, rule in rules.items()})


def evaluate_baselines(
    matrix: DataFrame,
    rules: Mapping[str, Callable[[DataFrame], Column]] = BASELINES,
    label: str = "churn_label",
) -> DataFrame:
    """recall, precision, f1, auc of each 0/1 prediction and its positives, from one pass of counts."""
    predicted = with_baselines(matrix, rules)
    truth = F.col(label) == 1
    counts = [F.count(F.lit(1)).alias("n"), F.count(F.when(truth, True)).alias("p")]
    for name in rules:
        flagged = F.col(name) == 1
        counts += [
            F.count(F.when(flagged, True)).alias(f"{name}__flagged"),
            F.count(F.when(flagged & truth, True)).alias(f"{name}__hit"),
        ]
    n, p = F.col("n"), F.col("p")
    rows = []
    for name in rules:
        flagged, hit = F.col(f"{name}__flagged"), F.col(f"{name}__hit")
        recall = share(hit, p)
        false_rate = share(flagged - hit, n - p)
        two_classes = (p > 0) & (p < n)
        rows.append(
            F.struct(
                F.lit(name).alias("baseline"),
                recall.alias("recall"),
                share(hit, flagged).alias("precision"),
                share(2 * hit, flagged + p).alias("f1"),
                F.when(two_classes, (recall + 1.0 - false_rate) / 2.0).otherwise(F.lit(0.5)).alias("auc_roc"),
                flagged.alias("positives"),
                share(flagged, n).alias("positive_rate"),
            )
        )
    return predicted.agg(*counts).select(F.explode(F.array(*rows)).alias("row")).select("row.*")
