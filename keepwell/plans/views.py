"""The audits as SQL views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from keepwell.operators import audit
from keepwell.plans.report import explosion_factors
from keepwell.sources.schemas import KEYS, PARENTS

# The tables whose keys the view reports.
KEYED = ("dim_customers", "fact_orders", "fact_support_tickets", "fact_order_items")


def audit_views(
    tables: Mapping[str, DataFrame],
    labels: DataFrame,
    store: DataFrame,
    keys: Mapping[str, Sequence[str]] = KEYS,
    parents: Sequence[tuple[str, str, str]] = PARENTS,
) -> dict[str, DataFrame]:
    """The five audit views by name; all lazy."""
    integrity = audit.key_integrity({t: tables[t] for t in KEYED}, keys, parents)
    invariants = audit.business_invariants(tables)
    coverage = audit.feature_coverage(labels, store)
    return {
        "v_key_integrity": integrity.select(
            "table_name", "total_rows", "duplicate_keys", "dup_rate_pct", "orphan_rows", "orphan_rate_pct"
        ),
        "v_explosion_factors": explosion_factors(tables),
        "v_business_invariants": invariants,
        "v_feature_coverage": coverage,
        "v_stop_go_summary": audit.stop_go_summary(integrity, invariants, coverage),
    }


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, view in views.items():
        view.createOrReplaceTempView(name)
