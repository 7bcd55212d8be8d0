"""From scores to actions, money, guardrails and drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.numeric import share
from keepwell.operators.quantiles import quantiles

# Action names, risk levels and their lower bounds.
CALL = "IMMEDIATE_CALL_SCHEDULED"
PRIORITY = "PRIORITY_COUPON_SENT"
STANDARD = "STANDARD_COUPON_SENT"
NO_ACTION = "NO_ACTION_REQUIRED"

# Stand-ins for absent request fields.
SERVING_DEFAULTS = {"avg_satisfaction_score": 3.5, "avg_delivery_days": 5.0}

# Cost of each action and yearly value of a customer.
ACTION_COSTS = {"none": 0.0, "coupon": 5.0, "advisor": 15.0, "free_shipping": 3.0}
CUSTOMER_VALUE = 120.0

# Least acceptable metrics.
GUARDRAILS = {"precision": 0.30, "auc_roc": 0.65, "auc_pr": 0.40, "lift_at_20": 1.50}
MAX_IMPUTED_PCT = 40.0
PSI_LIMIT = 0.25


def recommended_action(probability: Column, flag: Column) -> Column:
    return (
        F.when(probability >= 0.75, CALL).when(probability >= 0.50, PRIORITY).when(flag == 1, STANDARD).otherwise(NO_ACTION)
    )


def risk_level(probability: Column) -> Column:
    return (
        F.when(probability >= 0.75, "CRITICAL")
        .when(probability >= 0.50, "HIGH")
        .when(probability >= 0.25, "MEDIUM")
        .otherwise("LOW")
    )


def with_serving_defaults(requests: DataFrame, window_days: int = 90) -> DataFrame:
    """Requests completed for scoring: stand-ins for absent scores and deliveries, spending per day derived."""
    filled = requests.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(v)) if c in requests.columns else F.lit(v)
        for c, v in SERVING_DEFAULTS.items()
    })
    derived = F.col("monetary_total") / float(window_days)
    given = F.col("spending_intensity") if "spending_intensity" in requests.columns else F.lit(None)
    return filled.withColumn("spending_intensity", F.coalesce(given, derived))


def predictions(
    scored: DataFrame, threshold: float, version: str, probability: str = "probability", key: Sequence[str] = ("customer_id",)
) -> DataFrame:
    """Probability to four digits (half even), flag on the unrounded probability, action on the rounded one."""
    raw = F.col(probability)
    rounded = F.bround(raw, 4)
    flag = (raw >= threshold).cast("int")
    return scored.select(
        *key,
        rounded.alias("churn_probability"),
        flag.alias("churn_flag"),
        F.lit(version).alias("model_version"),
        F.lit(float(threshold)).alias("decision_threshold"),
        recommended_action(rounded, flag).alias("recommended_action"),
        risk_level(rounded).alias("risk_level"),
    )


def batch_summary(predicted: DataFrame) -> DataFrame:
    return predicted.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum("churn_flag"), F.lit(0)).cast("bigint").alias("churn_count"),
        F.max("model_version").alias("model_version"),
    )


def campaign_roi(confusions: DataFrame, value: float = CUSTOMER_VALUE, cost: float = ACTION_COSTS["coupon"]) -> DataFrame:
    """(value * tp - spend) / spend with spend = cost * (tp + fp)."""
    spend = F.lit(cost) * (F.col("tp") + F.col("fp"))
    return confusions.select(
        "tp", "fp", spend.alias("spend"), F.try_divide(F.lit(value) * F.col("tp") - spend, spend).alias("roi")
    )


def best_action(
    scored: DataFrame,
    retained_if_churning: Mapping[str, float],
    costs: Mapping[str, float] = ACTION_COSTS,
    value: float = CUSTOMER_VALUE,
    probability: str = "churn_probability",
) -> DataFrame:
    """The action of highest expected utility.

    A customer who stays is worth ``value``; one about to leave stays with the chance given per action.
    Ties go to the cheaper action, then to its name.
    """
    p = F.col(probability)
    options = [
        F.struct(
            (F.lit(value) * ((1 - p) + p * F.lit(float(retained_if_churning.get(name, 0.0)))) - F.lit(cost)).alias("utility"),
            F.lit(-cost).alias("_cheap"),
            F.lit(name).alias("action"),
        )
        for name, cost in sorted(costs.items(), reverse=True)
    ]
    return scored.withColumn("_best", F.array_max(F.array(*options))).select(
        "*", F.col("_best.action").alias("best_action"), F.col("_best.utility").alias("expected_utility")
    ).drop("_best")


def imputed_shares(raw: DataFrame, columns: Sequence[str], most: float = MAX_IMPUTED_PCT) -> DataFrame:
    """(metric, value, maximum, passed): the share of each column that imputation has to fill, in percent."""
    counted = raw.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("metric"),
            F.coalesce(100.0 * F.col(c) / F.nullif(F.col("_rows"), F.lit(0)), F.lit(0.0)).alias("value"),
            F.lit(most).alias("maximum"),
            (100 * F.col(c) <= most * F.col("_rows")).alias("passed"),
        )
        for c in columns
    ]
    return counted.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def guardrails(metrics: DataFrame, limits: Mapping[str, float] = GUARDRAILS) -> DataFrame:
    """(metric, value, minimum, passed) from one row of metrics."""
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
            F.lit(limit).alias("minimum"),
            F.coalesce(F.col(name) >= limit, F.lit(False)).alias("passed"),
        )
        for name, limit in limits.items()
    ]
    return metrics.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def stability_index(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-4,
    accuracy: int | None = None,
) -> DataFrame:
    """Population stability index of ``current`` against ``baseline`` over the baseline's quantile bins.

    Equal edges are merged; an empty bin counts as the share ``floor``. NULLs are left out. ``baseline``
    should be stored.
    """
    probs = [i / bins for i in range(1, bins)]
    cells = quantiles(baseline, {c: probs for c in columns}, accuracy=accuracy).get((), {})
    edges = {c: sorted({e for e in cells.get(c, {}).values() if e is not None}) for c in columns}
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        bucket = F.lit(0)
        for edge in edges[c]:
            bucket = bucket + (value > F.lit(edge)).cast("int")
        parts.append(F.struct(F.lit(c).alias("feature"), F.when(value.isNotNull(), bucket).alias("bucket")))

    def counted(df: DataFrame, side: str) -> DataFrame:
        cells_ = df.select(F.explode(F.array(*parts)).alias("cell")).select("cell.*").filter("bucket IS NOT NULL")
        return cells_.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias(side))

    # One row per feature and bin from here on.
    both = counted(baseline, "_b").join(counted(current, "_c"), ["feature", "bucket"], "full").fillna(0, ["_b", "_c"])
    totals = both.groupBy("feature").agg(F.sum("_b").alias("_nb"), F.sum("_c").alias("_nc"))
    rates = both.join(totals, "feature").select(
        "feature",
        F.greatest(share(F.col("_b"), F.col("_nb")), F.lit(floor)).alias("b"),
        F.greatest(share(F.col("_c"), F.col("_nc")), F.lit(floor)).alias("c"),
    )
    term = (F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b"))
    return rates.groupBy("feature").agg(F.sum(term).alias("psi")).withColumn("retrain", F.col("psi") > PSI_LIMIT)


def pseudonymised(df: DataFrame, column: str = "customer_id", salt: str = "") -> DataFrame:
    return df.withColumn(column, F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), 256))
