"""The consolidated data-quality report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from keepwell.operators import audit, profile
from keepwell.params import NUMERIC_FEATURES
from keepwell.session import settle

FACT_JOINS = (
    ("dim_customers", "fact_orders", "customer_id"),
    ("fact_orders", "fact_order_items", "order_id"),
    ("dim_customers", "fact_support_tickets", "customer_id"),
)


def join_name(left: str, right: str) -> str:
    return f"{left} ⋈ {right}"


def explosion_factors(tables: Mapping[str, DataFrame], empty: float | None = None) -> DataFrame:
    """Row-count ratios of the three critical joins."""
    return audit.stack([
        audit.explosion_factor(tables[a], tables[b], join_name(a, b), empty) for a, b, _ in FACT_JOINS
    ])


def join_fanouts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return audit.stack([audit.join_fanout(tables[a], tables[b], key, join_name(a, b)) for a, b, key in FACT_JOINS])


def quality_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    parents: Sequence[tuple[str, str, str]],
    raw_matrix: DataFrame,
    matrix: DataFrame,
    labels: DataFrame,
) -> dict[str, DataFrame]:
    """Every audit and profile by name. ``matrix`` (imputed) and ``raw_matrix`` should be stored.

    The audits that other parts read again, a few rows each, are worked out once and stored.
    """
    integrity = settle(audit.key_integrity(tables, keys, parents))
    invariants = settle(audit.business_invariants(tables))
    missing = settle(audit.missingness(raw_matrix))
    coverage = settle(audit.feature_coverage(labels, matrix))
    return {
        "overview": matrix.agg(
            F.count(F.lit(1)).alias("n_customers"),
            F.lit(len(matrix.columns) - 3).alias("n_features"),
            F.avg("churn_label").alias("churn_rate"),
            F.count(F.when(F.col("churn_label") == 1, True)).alias("n_churn"),
            F.count(F.when(F.col("churn_label") == 0, True)).alias("n_no_churn"),
        ),
        "key_integrity": integrity,
        "explosion_factors": explosion_factors(tables, empty=0.0),
        "join_fanouts": join_fanouts(tables),
        "business_invariants": invariants,
        "missingness": missing,
        "missing_ranking": audit.missing_ranking(missing),
        "feature_coverage": coverage,
        "stop_go_summary": audit.stop_go_summary(integrity, invariants, coverage),
        "stop_go_reasons": audit.stop_go_reasons(integrity, missing, matrix),
        "class_balance": profile.class_balance(matrix),
        "histograms": profile.histograms(matrix),
        "describe": profile.describe(matrix),
        "correlations": profile.correlations(matrix, [*NUMERIC_FEATURES, "churn_label"]),
        "target_correlation": profile.target_correlation(matrix),
    }
