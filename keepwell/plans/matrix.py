"""The feature matrix: one row per customer and cutoff, with label."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from keepwell.operators import features as feats
from keepwell.operators.quantiles import grouped_quantiles
from keepwell.params import MATRIX_NUMERIC, Params
from keepwell.session import settle
from keepwell.sources.tables import Bundle

MATRIX_COLUMNS = (
    "customer_id", "cutoff_date", *MATRIX_NUMERIC, "customer_segment", "preferred_category", "churn_label",
)


# Medians of up to so many groups are sent to every task.
BROADCAST_GROUPS = 10_000


def assemble(
    bundle: Bundle,
    params: Params,
    cutoffs: Sequence[date] | None = None,
    censor_future_delivery: bool = False,
    iso_year: bool = False,
) -> DataFrame:
    """All features and the label before imputation.

    Without given labels the label comes out of the same aggregation as the order features. With given
    labels they set the population and the features are joined to it.
    """
    cutoffs = list(cutoffs or [params.cutoff])
    days = params.observation_days
    key = feats.group_key(cutoffs)
    derive = bundle.labels is None
    base = feats.order_rollup(
        bundle.orders, cutoffs, days, params.prediction_days if derive else None, censor_future_delivery, iso_year
    )
    base = base.select(*feats.KEY, *feats.ORDER_FEATURES, *(["churn_label"] if derive else []))
    if not derive:
        base = _on(bundle.labels.select(*feats.KEY, "churn_label"), base, key)
    diversity = feats.category_diversity(bundle.orders, bundle.items, cutoffs, days)
    support = feats.support_features(bundle.tickets, cutoffs, days)
    people = bundle.customers.select("customer_id", "registration_date", "customer_segment", "preferred_category")
    whole = _on(_on(base, diversity, key), support, key).join(people, "customer_id", "left")
    tenure = F.datediff(F.col("cutoff_date"), F.col("registration_date"))
    return whole.withColumn("days_since_registration", tenure).select(
        "customer_id",
        "cutoff_date",
        *[F.col(c).cast("double").alias(c) for c in MATRIX_NUMERIC],
        "customer_segment",
        "preferred_category",
        F.col("churn_label").cast("int").alias("churn_label"),
    )


def _on(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return left.join(right if len(key) > 1 else right.drop("cutoff_date"), key, "left")


def fit_medians(matrix: DataFrame, by: Sequence[str] = ("cutoff_date",), accuracy: int | None = None) -> DataFrame:
    """Medians of the numeric columns, one row per group (a cutoff by default). ``matrix`` should be stored.

    ``accuracy`` takes the built-in sketch. Groups are rows of a table throughout, however many there are.
    """
    named = [f"_med_{c}" for c in MATRIX_NUMERIC]
    if accuracy is not None:
        sketches = [F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(n) for c, n in zip(MATRIX_NUMERIC, named)]
        return settle(matrix.groupBy(*by).agg(*sketches))
    long = grouped_quantiles(matrix, {c: [0.5] for c in MATRIX_NUMERIC}, by)
    wide = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(n) for c, n in zip(MATRIX_NUMERIC, named)]
    return settle(long.groupBy(*by).agg(*wide))


def impute(matrix: DataFrame, fit: DataFrame, by: Sequence[str] = ("cutoff_date",), zero_tickets: bool = False) -> DataFrame:
    """Fill numeric gaps with the fitted medians and the two categories with their defaults.

    Customers without tickets get the median ticket count; ``zero_tickets`` gives them 0. Without any ticket there is
    no median, and the count is 0. Medians of up to ``BROADCAST_GROUPS`` groups are broadcast: joined by group, all rows of a
    cutoff would come together in one task. More groups are joined by shuffle. ``fit`` should be stored.
    """
    if zero_tickets:
        matrix = matrix.fillna({"support_tickets_90d": 0.0})
    if fit.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        fit = F.broadcast(fit)
    joined = matrix.join(fit, list(by), "left")
    filled = joined.select(
        *[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in MATRIX_NUMERIC else F.col(c) for c in matrix.columns]
    )
    return filled.fillna(
        {"support_tickets_90d": 0.0, "customer_segment": "STANDARD", "preferred_category": "Unknown"}
    )


def feature_matrix(
    bundle: Bundle,
    params: Params,
    cutoffs: Sequence[date] | None = None,
    accuracy: int | None = None,
    zero_tickets: bool = False,
    **options,
) -> DataFrame:
    """Assembled and imputed. The assembled rows are stored once: the medians and the result both read them."""
    raw = settle(assemble(bundle, params, cutoffs, **options))
    return impute(raw, fit_medians(raw, accuracy=accuracy), zero_tickets=zero_tickets)
