"""Registered queries: cleaning, audits and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepwell.catalog.base import (
    CUTOFF, EARLIER, MONTH, STAR_KEYS, YEAR, matrices, matrix, raw_matrix, rounded, scratch, sql, star,
)
from keepwell.catalog.feature_queries import CLEAN
from keepwell.functions.dates import parse_date
from keepwell.operators import audit, cleaning, features as feats, profile
from keepwell.operators.constraints import constraint_audit, keep_one_per_key, split_by_rules
from keepwell.params import MATRIX_NUMERIC, NUMERIC_FEATURES
from keepwell.plans import report
from keepwell.plans.training import clean_bundle
from keepwell.plans.views import audit_views as audit_views_of, register_views
from keepwell.session import settle
from keepwell.sources import store
from keepwell.sources.retail import Retail
from keepwell.sources.schemas import PARENTS, RULES

# -- cleaning -----------------------------------------------------------------------------------------


def parse_dates(spark, folder):
    """Dates arriving as text, some of them no dates."""
    raw = Retail(spark, folder).raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.col("o_orderpriority"), F.lit("?")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
    )
    return raw.withColumn("order_date", parse_date("order_date"))


def fix_delivery(spark, folder):
    return cleaning.fix_delivery_after_order(Retail(spark, folder).orders).select(
        "order_id", "order_date", "delivery_date"
    )


def _refunds(spark, folder):
    """Orders whose returns are booked as negative amounts."""
    orders = Retail(spark, folder).orders_head
    signed = F.when(F.col("order_status") == "RETURNED", -F.col("total_amount")).otherwise(F.col("total_amount"))
    return orders.withColumn("total_amount", signed).select("order_id", "total_amount")


def fix_amounts(spark, folder):
    return rounded(cleaning.fix_positive_amounts(_refunds(spark, folder)))


def fix_satisfaction(spark, folder):
    return cleaning.fix_satisfaction_range(Retail(spark, folder).tickets).select("ticket_id", "satisfaction_score")


def drop_sparse_columns(spark, folder):
    return cleaning.drop_sparse_columns(Retail(spark, folder).orders_head, 0.40)


def _gappy(spark, folder):
    orders = Retail(spark, folder).orders_head
    method = F.when(F.col("order_status") != "CANCELLED", F.col("payment_method"))
    return orders.select("order_id", method.alias("payment_method"), "order_status", "channel")


def impute_mode(spark, folder):
    return cleaning.impute_mode(_gappy(spark, folder), cleaning.MODE_COLUMNS)


def impute_median(spark, folder):
    return rounded(cleaning.impute_median(fix_satisfaction(spark, folder), "satisfaction_score"))


def cap_iqr(spark, folder):
    tickets = Retail(spark, folder).tickets.select("ticket_id", "satisfaction_score")
    return rounded(cleaning.cap_iqr(tickets, "satisfaction_score", 1.5))


def dedupe_keep_last(spark, folder):
    return keep_one_per_key(
        Retail(spark, folder).lines, ["order_id", "line_number"], ["product_id", "quantity", "unit_price"]
    )


def clean_orders(spark, folder):
    return rounded(cleaning.clean_orders(Retail(spark, folder).orders).data)


def clean_support_tickets(spark, folder):
    cleaned = cleaning.clean_support_tickets(Retail(spark, folder).tickets).data
    return rounded(cleaned.select("ticket_id", "customer_id", "created_date", "ticket_type", "satisfaction_score"))


def clean_customers(spark, folder):
    return cleaning.clean_customers(Retail(spark, folder).customers()).data


def cleaning_report(spark, folder):
    return clean_bundle(Retail(spark, folder).bundle(), MONTH).report.drop("value")


# -- audits -------------------------------------------------------------------------------------------


def key_integrity(spark, folder):
    """All tables, the labels and the stored matrix, written and read again, by their composite keys."""
    tables = star(spark, folder)
    head = Retail(spark, folder).orders_head
    labels = feats.churn_labels(head, [EARLIER, CUTOFF])
    path = scratch(spark, "matrix")
    store.write_matrix(feats.order_rollup(head, [CUTOFF], parts=()), path)
    whole = {**tables, "ml_churn_labels": labels, "ml_feature_store": store.read_matrix(spark, path)}
    both = ("customer_id", "cutoff_date")
    return audit.key_integrity(whole, {**STAR_KEYS, "ml_churn_labels": both, "ml_feature_store": both}, PARENTS)


def orphans(spark, folder):
    """Lines whose order is not known at the cutoff."""
    tables = Retail(spark, folder)
    known = tables.orders_head.filter(F.col("order_date") <= F.lit(CUTOFF))
    return audit.orphan_rows(tables.lines, known, "order_id").select("order_id", "line_number", "product_id")


def orphan_rates(spark, folder):
    """Every reference of the star schema, against orders and customers known at the cutoff."""
    tables = star(spark, folder)
    retail = Retail(spark, folder)
    known = retail.orders_head.filter(F.col("order_date") <= F.lit(CUTOFF))
    parents = {**tables, "fact_orders": known, "dim_customers": known.select("customer_id").distinct()}
    return audit.stack([
        audit.orphan_counts(tables[child], parents[parent], f"{child}.{column}", column)
        for child, column, parent in PARENTS
    ])


def duplicate_keys(spark, folder):
    tables = star(spark, folder)
    return audit.stack([audit.duplicate_keys(df, name, STAR_KEYS[name]) for name, df in tables.items()])


def explosion_factors(spark, folder):
    return report.explosion_factors(star(spark, folder))


def true_join_fanout(spark, folder):
    return report.join_fanouts(star(spark, folder))


def business_invariants(spark, folder):
    return audit.business_invariants(star(spark, folder))


def constraint_audits(spark, folder):
    tables = star(spark, folder)
    labels = feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF])
    return audit.stack([
        constraint_audit(df, name) for name, df in {**tables, "ml_churn_labels": labels}.items()
    ])


def constraint_filter(spark, folder):
    """Rejected orders with the rules they break."""
    _, bad = split_by_rules(Retail(spark, folder).orders, RULES["fact_orders"])
    return bad.select("order_id", "order_date", "delivery_date", F.concat_ws(",", "broken_rules").alias("broken_rules"))


def missingness(spark, folder):
    return audit.missingness(raw_matrix(spark, folder))


def missing_ranking(spark, folder):
    return audit.missing_ranking(audit.missingness(raw_matrix(spark, folder)))


def _coverage(spark, folder):
    """Labels of two cutoffs against features stored for one of them."""
    head = Retail(spark, folder).orders_head
    labels = feats.churn_labels(head, [EARLIER, CUTOFF])
    return audit.feature_coverage(labels, feats.order_rollup(head, [CUTOFF], parts=()))


def feature_coverage(spark, folder):
    return _coverage(spark, folder)


def stop_go_summary(spark, folder):
    tables = star(spark, folder)
    keys = audit.key_integrity(tables, STAR_KEYS, PARENTS)
    return audit.stop_go_summary(keys, audit.business_invariants(tables), _coverage(spark, folder))


def audit_views(spark, folder):
    """The checks that fail, with the rows of the views behind them, asked in SQL."""
    head = Retail(spark, folder).orders_head
    labels = feats.churn_labels(head, [EARLIER, CUTOFF])
    views = audit_views_of(star(spark, folder), labels, feats.order_rollup(head, [CUTOFF], parts=()), STAR_KEYS)
    register_views(views)
    return spark.sql("""
        SELECT 'key' AS kind, table_name AS subject, duplicate_keys + coalesce(orphan_rows, 0) AS amount
        FROM v_key_integrity WHERE dup_rate_pct > 0 OR orphan_rate_pct > 0
        UNION ALL SELECT 'invariant', invariant_name, violations FROM v_business_invariants WHERE violations > 0
        UNION ALL SELECT 'coverage', stop_go_status, customers_without_features FROM v_feature_coverage
        UNION ALL SELECT 'join', join_name, n_right FROM v_explosion_factors WHERE explosion_factor > 1
        UNION ALL SELECT 'gate', check_name, CAST(NULL AS BIGINT) FROM v_stop_go_summary WHERE status = 'FAIL'""")


def _reasons(spark, folder, params):
    tables = star(spark, folder)
    raw, whole = matrices(spark, folder, params)
    keys = audit.key_integrity(tables, STAR_KEYS, PARENTS)
    return audit.stop_go_reasons(keys, audit.missingness(raw), whole)


def stop_go_month(spark, folder):
    return _reasons(spark, folder, MONTH)


def stop_go_year(spark, folder):
    return _reasons(spark, folder, YEAR)


# -- profiles -----------------------------------------------------------------------------------------


def describe_features(spark, folder):
    return profile.describe(matrix(spark, folder))


def correlation_matrix(spark, folder):
    return profile.correlations(matrix(spark, folder, YEAR), [*NUMERIC_FEATURES, "churn_label"])


def target_correlation(spark, folder):
    return profile.target_correlation(matrix(spark, folder, YEAR))


def class_balance(spark, folder):
    return profile.class_balance(feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF], 90, YEAR.prediction_days))


def quality_overview(spark, folder):
    """The head of the consolidated report, and how many rows its other parts have."""
    raw, whole = matrices(spark, folder, YEAR)
    labels = feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF], 90, YEAR.prediction_days)
    parts = report.quality_report(star(spark, folder), STAR_KEYS, PARENTS, raw, settle(whole), labels)
    sizes = {f"n_{name}": F.lit(parts[name].count()).cast("bigint") for name in (
        "key_integrity", "explosion_factors", "business_invariants", "missingness", "stop_go_summary", "class_balance", "describe"
    )}
    return parts["overview"].withColumn("churn_rate", F.round("churn_rate", 6)).withColumns(sizes)


def quality_report_values(spark, folder):
    """The consolidated report by value, in long form: every figure of its audits and of the class balance."""
    raw, whole = matrices(spark, folder, MONTH)
    labels = feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF])
    parts = report.quality_report(star(spark, folder), STAR_KEYS, PARENTS, raw, settle(whole), labels)
    figures = [
        ("key_integrity", "table_name", "duplicate_keys", "duplicate_keys"), ("key_integrity", "table_name", "orphan_rows", "orphan_rows"),
        ("explosion_factors", "join_name", "explosion_factor", "explosion_factor"),
        ("business_invariants", "invariant_name", "violations", "violations"), ("missingness", "column_name", "null_pct", "null_pct"),
        ("missingness", "column_name", "over_threshold", "int(over_threshold)"),
        ("feature_coverage", "stop_go_status", "customers_without_features", "customers_without_features"),
        ("stop_go_summary", "check_name", "passed", "int(status = 'PASS')"), ("class_balance", "string(churn_label)", "cnt", "cnt"),
        ("describe", "feature", "cnt", "cnt"),
    ]
    rows = [
        parts[name].selectExpr(f"'{name}' AS section", f"{subject} AS subject", f"'{figure}' AS figure", f"round(double({value}), 4) AS amount")
        for name, subject, figure, value in figures
    ]
    return audit.stack(rows).filter("amount IS NOT NULL")


def histogram(spark, folder):
    return rounded(profile.histograms(settle(rounded(matrix(spark, folder, YEAR)))), 3)


QUERIES = {
    "parse_dates": parse_dates,
    "fix_delivery": fix_delivery,
    "fix_amounts": fix_amounts,
    "fix_satisfaction": fix_satisfaction,
    "drop_sparse_columns": drop_sparse_columns,
    "impute_mode": impute_mode,
    "impute_median": impute_median,
    "cap_iqr": cap_iqr,
    "dedupe_keep_last": dedupe_keep_last,
    "clean_orders": clean_orders,
    "clean_support_tickets": clean_support_tickets,
    "clean_customers": clean_customers,
    "cleaning_report": cleaning_report,
    "key_integrity": key_integrity,
    "orphans": orphans,
    "orphan_rates": orphan_rates,
    "duplicate_keys": duplicate_keys,
    "explosion_factors": explosion_factors,
    "true_join_fanout": true_join_fanout,
    "business_invariants": business_invariants,
    "constraint_audit": constraint_audits,
    "constraint_filter": constraint_filter,
    "missingness": missingness,
    "missing_ranking": missing_ranking,
    "feature_coverage": feature_coverage,
    "stop_go_summary": stop_go_summary,
    "audit_views": audit_views,
    "stop_go_reasons_month": stop_go_month,
    "stop_go_reasons_year": stop_go_year,
    "describe_features": describe_features,
    "correlation_matrix": correlation_matrix,
    "target_correlation": target_correlation,
    "class_balance": class_balance,
    "histogram": histogram,
    "quality_overview": quality_overview,
    "quality_report_values": quality_report_values,
}


# -- SQL ----------------------------------------------------------------------------------------------

_TWO = [EARLIER, CUTOFF]
_KNOWN = f"SELECT * FROM orders_head WHERE order_date <= DATE '{CUTOFF}'"


def _keys(table: str, source: str, key: str, orphan: str | None = None) -> str:
    lost, rate = ("CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)")
    if orphan:
        lost = orphan
        rate = f"round({orphan} * 100.0 / greatest((SELECT count(*) FROM {source}), 1), 4)"
    return f"""
        SELECT '{table}' AS table_name, count(*) AS total_rows, count(DISTINCT {key}) AS distinct_keys,
               count(*) - count(DISTINCT {key}) AS duplicate_keys,
               round((count(*) - count(DISTINCT {key})) * 100.0 / greatest(count(*), 1), 4) AS dup_rate_pct,
               {lost} AS orphan_rows, {rate} AS orphan_rate_pct
        FROM {source}"""


def _lost(child: str, column: str, parent: str) -> str:
    return f"(SELECT count(*) FROM {child} c LEFT JOIN {parent} p ON c.{column} = p.{column} WHERE p.{column} IS NULL)"


_STAR_KEY_SQL = " UNION ALL ".join([
    _keys("dim_customers", "dim_customers", "customer_id"),
    _keys("dim_products", "dim_products", "product_id"),
    _keys("fact_orders", "fact_orders", "order_id", _lost("fact_orders", "customer_id", "dim_customers")),
    _keys("fact_order_items", "fact_order_items", "(order_id, line_number)",
          _lost("fact_order_items", "order_id", "fact_orders")),
    _keys("fact_support_tickets", "fact_support_tickets", "ticket_id",
          _lost("fact_support_tickets", "customer_id", "dim_customers")),
])


def _orphan_rate(child: str, column: str, parent: str) -> str:
    return f"""
        SELECT '{child}.{column}' AS table_name, count(*) AS checked_rows,
               count(*) FILTER (WHERE p.k IS NULL) AS orphan_rows,
               round(count(*) FILTER (WHERE p.k IS NULL) * 100.0 / greatest(count(*), 1), 4) AS orphan_rate_pct
        FROM {child} c LEFT JOIN (SELECT DISTINCT {column} AS k FROM {parent}) p ON c.{column} = p.k"""


def _duplicates(table: str, key: str, text: str) -> str:
    return f"SELECT '{table}' AS table_name, {text} AS key_value, count(*) AS cnt FROM {table} GROUP BY {key} HAVING count(*) > 1"


def _explosion(a: str, b: str) -> str:
    return f"""
        SELECT '{a} ⋈ {b}' AS join_name, (SELECT count(*) FROM {a}) AS n_left, (SELECT count(*) FROM {b}) AS n_right,
               round(CAST((SELECT count(*) FROM {b}) AS DOUBLE) / greatest((SELECT count(*) FROM {a}), 1), 3)
                   AS explosion_factor"""


def _fanout(a: str, b: str, key: str) -> str:
    joined = f"(SELECT count(*) FROM {a} JOIN {b} USING ({key}))"
    return f"""
        SELECT '{a} ⋈ {b}' AS join_name, (SELECT count(*) FROM {a}) AS n_left, {joined} AS n_joined,
               round(CAST({joined} AS DOUBLE) / greatest((SELECT count(*) FROM {a}), 1), 3) AS fanout"""


def _invariant(name: str, table: str, bad: str, guard: str) -> str:
    return f"""
        SELECT '{name}' AS invariant_name, count(*) AS total_checked, count(*) FILTER (WHERE {bad}) AS violations,
               round(count(*) FILTER (WHERE {bad}) * 100.0 / greatest(count(*), 1), 4) AS violation_rate_pct
        FROM {table} WHERE {guard}"""


_INVARIANT_SQL = " UNION ALL ".join([
    _invariant("delivery_date >= order_date", "fact_orders", "delivery_date < order_date", "delivery_date IS NOT NULL"),
    _invariant("resolved_date >= created_date (support)", "fact_support_tickets", "resolved_date < created_date",
               "resolved_date IS NOT NULL"),
    _invariant("total_amount >= 0 (orders)", "fact_orders", "total_amount < 0", "true"),
])

_CONSTRAINT_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{rule.name}' AS rule_name, count(*) AS rows_checked, "
    f"count(*) FILTER (WHERE NOT ({rule.holds})) AS violations FROM {table}"
    for table in ("dim_customers", "dim_products", "fact_orders", "fact_order_items", "fact_support_tickets",
                  "ml_churn_labels")
    for rule in RULES[table]
)
_LABELS = {"ml_churn_labels": "SELECT * FROM churn_labels"}

_MATRIX_COLUMNS = ("customer_id", "cutoff_date", *MATRIX_NUMERIC, "customer_segment", "preferred_category")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _missing(column: str) -> str:
    kind, treatment = audit.MISSING_KINDS.get(column, (None, None))
    empty = f"count(*) FILTER (WHERE {column} IS NULL)"
    if kind is None:
        kind_sql = f"CASE WHEN {empty} > 0 THEN '{audit.DEFAULT_KIND[0]}' ELSE '{audit.NO_KIND[0]}' END"
        treatment_sql = f"CASE WHEN {empty} > 0 THEN '{audit.DEFAULT_KIND[1]}' ELSE '{audit.NO_KIND[1]}' END"
    else:
        kind_sql, treatment_sql = _quoted(kind), _quoted(treatment)
    return f"""
        SELECT '{column}' AS column_name, {empty} AS null_count,
               round({empty} * 100.0 / greatest(count(*), 1), 2) AS null_pct, {kind_sql} AS missing_type,
               {treatment_sql} AS treatment, round({empty} * 100.0 / greatest(count(*), 1), 2) > 40 AS over_threshold
        FROM raw_matrix"""


_MISSING_SQL = " UNION ALL ".join(_missing(c) for c in _MATRIX_COLUMNS)
_MORE = {
    "key_report": _STAR_KEY_SQL,
    "invariant_report": _INVARIANT_SQL,
    "missing_report": _MISSING_SQL,
    "without_features": f"""
        SELECT customer_id FROM churn_labels EXCEPT
        SELECT customer_id FROM churn_labels WHERE cutoff_date = DATE '{CUTOFF}'""",
    "coverage_report": f"""
        SELECT customers_with_labels, customers_with_labels - missing AS customers_with_features,
               missing AS customers_without_features,
               round((customers_with_labels - missing) * 100.0 / greatest(customers_with_labels, 1), 2) AS coverage_pct,
               CASE missing WHEN 0 THEN '{audit.COVERAGE_GO}' ELSE '{audit.COVERAGE_STOP}' END AS stop_go_status
        FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM churn_labels)) AS customers_with_labels,
                     (SELECT count(*) FROM without_features) AS missing)""",
}
_REASONS_SQL = """
    SELECT 'duplicates' AS criterion, table_name AS subject, CAST(dup_rate_pct AS DOUBLE) AS amount
    FROM key_report WHERE duplicate_keys > 0
    UNION ALL SELECT 'orphans', table_name, orphan_rate_pct FROM key_report WHERE orphan_rows > 0
    UNION ALL SELECT 'nulls', column_name, null_pct FROM missing_report WHERE over_threshold
    UNION ALL SELECT 'negative delivery', 'avg_delivery_days', CAST(count(*) AS DOUBLE) FROM matrix
              WHERE avg_delivery_days < 0 HAVING count(*) > 0
    UNION ALL SELECT 'churn rate', 'churn_label', round(avg(churn_label), 6) FROM matrix
              HAVING avg(churn_label) NOT BETWEEN 0.01 AND 0.5"""


def _described(c: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({c}, {q}), 3) AS {name}" for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    )
    return f"""
        SELECT '{c}' AS feature, count({c}) AS cnt, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
               round(min({c}), 3) AS min, {quartiles}, round(max({c}), 3) AS max FROM matrix"""


def _correlated(a: str, b: str) -> str:
    # A constant column has no correlation; the SQL engine may say NaN.
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE round(corr({a}, {b}), 6) END"


_PAIRS = [
    (a, b)
    for i, a in enumerate([*NUMERIC_FEATURES, "churn_label"])
    for b in [*NUMERIC_FEATURES, "churn_label"][i + 1:]
]


def _histogram(c: str) -> str:
    return f"""
        SELECT churn_label, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS value FROM matrix WHERE {c} IS NOT NULL"""


_HISTOGRAM_MORE = {
    "cells": " UNION ALL ".join(_histogram(c) for c in NUMERIC_FEATURES),
    "ranges": """
        SELECT churn_label, feature, n, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
               CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
        FROM (SELECT churn_label, feature, count(*) AS n, min(value) AS lo, max(value) AS hi FROM cells GROUP BY 1, 2)""",
    "binned": """
        SELECT c.churn_label, c.feature, CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin,
               count(*) AS cnt
        FROM cells c JOIN ranges r ON c.churn_label = r.churn_label AND c.feature = r.feature GROUP BY 1, 2, 3""",
    "grid": "SELECT churn_label, feature, n, lo, hi, CAST(unnest(range(30)) AS INTEGER) AS bin FROM ranges",
}

ORACLE = {
    "parse_dates": """
        SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS order_date
        FROM orders""",
    "fix_delivery": sql("""
        SELECT order_id, order_date, CASE WHEN delivery_date < order_date THEN NULL ELSE delivery_date END AS delivery_date
        FROM fact_orders"""),
    "fix_amounts": sql("""
        SELECT order_id, round(CASE WHEN order_status = 'RETURNED'
               THEN (SELECT median(total_amount) FROM orders_head WHERE order_status <> 'RETURNED')
               ELSE total_amount END, 6) AS total_amount
        FROM orders_head"""),
    "fix_satisfaction": sql("""
        SELECT ticket_id, CASE WHEN satisfaction_score BETWEEN 1 AND 5 THEN satisfaction_score END AS satisfaction_score
        FROM fact_support_tickets"""),
    "drop_sparse_columns": sql("""
        SELECT order_id, customer_id, order_date, order_status, total_amount, payment_method FROM orders_head"""),
    "impute_mode": sql("""
        SELECT order_id, coalesce(CASE WHEN order_status <> 'CANCELLED' THEN payment_method END,
               (SELECT payment_method FROM orders_head WHERE order_status <> 'CANCELLED'
                GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS payment_method, order_status, channel
        FROM orders_head"""),
    "impute_median": sql("""
        SELECT ticket_id, round(CASE WHEN satisfaction_score BETWEEN 1 AND 5 THEN satisfaction_score ELSE
               (SELECT median(satisfaction_score) FROM fact_support_tickets
                WHERE satisfaction_score BETWEEN 1 AND 5) END, 6) AS satisfaction_score
        FROM fact_support_tickets"""),
    "cap_iqr": sql("""
        SELECT ticket_id, round(least(greatest(satisfaction_score, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6)
                   AS satisfaction_score
        FROM fact_support_tickets, (SELECT quantile_cont(satisfaction_score, 0.25) AS q1,
                                           quantile_cont(satisfaction_score, 0.75) AS q3 FROM fact_support_tickets)"""),
    "dedupe_keep_last": sql("""
        SELECT order_id, line_number, product_id, quantity, unit_price
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number
                                           ORDER BY product_id DESC, quantity DESC, unit_price DESC) AS rn
              FROM fact_order_items) WHERE rn = 1"""),
    "clean_orders": sql("""
        SELECT order_id, customer_id, order_date,
               CASE WHEN delivery_date >= order_date THEN delivery_date END AS delivery_date, order_status,
               round(least(greatest(total_amount, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS total_amount,
               payment_method
        FROM fact_orders, (SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3
                           FROM fact_orders)"""),
    "clean_support_tickets": sql("""
        SELECT ticket_id, customer_id, created_date, ticket_type,
               round(CASE WHEN satisfaction_score BETWEEN 1 AND 5 THEN satisfaction_score ELSE
                     (SELECT median(satisfaction_score) FROM fact_support_tickets
                      WHERE satisfaction_score BETWEEN 1 AND 5) END, 6) AS satisfaction_score
        FROM fact_support_tickets"""),
    "clean_customers": sql("""
        SELECT customer_id, registration_date, country, coalesce(customer_segment, 'STANDARD') AS customer_segment,
               coalesce(preferred_category, 'Unknown') AS preferred_category,
               CAST(coalesce(email_opt_in, 1) AS INTEGER) AS email_opt_in
        FROM customers"""),
    "cleaning_report": sql(
        """
        SELECT 'fact_orders' AS table_name, 'rows_before' AS step, '' AS column_name, count(*) AS affected_rows
        FROM known_orders
        UNION ALL SELECT 'fact_orders', 'violations', 'delivery_date', count(*) FROM known_orders
                  WHERE delivery_date < order_date
        UNION ALL SELECT 'fact_orders', 'violations', 'total_amount', count(*) FROM known_orders WHERE total_amount < 0
        UNION ALL SELECT 'fact_orders', 'dropped', 'discount_applied', count(*) FROM known_orders
        UNION ALL SELECT 'fact_orders', 'dropped', 'channel', count(*) FROM known_orders
        UNION ALL SELECT 'fact_orders', 'capped', 'total_amount', count(*) FROM known_orders, fence
                  WHERE total_amount < q1 - 1.5 * (q3 - q1) OR total_amount > q3 + 1.5 * (q3 - q1)
        UNION ALL SELECT 'fact_orders', 'rows_after', '', count(*) FROM known_orders
        UNION ALL SELECT 'fact_support_tickets', 'rows_before', '', count(*) FROM known_tickets
        UNION ALL SELECT 'fact_support_tickets', 'violations', 'satisfaction_score', count(*) FROM known_tickets
                  WHERE satisfaction_score IS NULL
        UNION ALL SELECT 'fact_support_tickets', 'imputed', 'satisfaction_score', count(*) FROM known_tickets
                  WHERE satisfaction_score IS NULL
        UNION ALL SELECT 'fact_support_tickets', 'rows_after', '', count(*) FROM known_tickets
        UNION ALL SELECT 'dim_customers', 'rows_before', '', count(*) FROM dim_customers
        UNION ALL SELECT 'dim_customers', 'rows_after', '', count(DISTINCT customer_id) FROM dim_customers""",
        more=CLEAN,
    ),
    "key_integrity": sql(
        _STAR_KEY_SQL + " UNION ALL "
        + _keys("ml_churn_labels", "churn_labels", "(customer_id, cutoff_date)") + " UNION ALL "
        + _keys("ml_feature_store", f"(SELECT * FROM churn_labels WHERE cutoff_date = DATE '{CUTOFF}')",
                "(customer_id, cutoff_date)"),
        cutoffs=_TWO,
    ),
    "orphans": sql(f"""
        SELECT order_id, line_number, product_id FROM fact_order_items
        WHERE order_id NOT IN (SELECT order_id FROM ({_KNOWN}))"""),
    "orphan_rates": sql(
        " UNION ALL ".join([
            _orphan_rate("fact_orders", "customer_id", "known"),
            _orphan_rate("fact_order_items", "order_id", "known"),
            _orphan_rate("fact_order_items", "product_id", "dim_products"),
            _orphan_rate("fact_support_tickets", "customer_id", "known"),
        ]),
        more={"known": _KNOWN},
    ),
    "duplicate_keys": sql(" UNION ALL ".join([
        _duplicates("dim_customers", "customer_id", "CAST(customer_id AS VARCHAR)"),
        _duplicates("dim_products", "product_id", "CAST(product_id AS VARCHAR)"),
        _duplicates("fact_orders", "order_id", "CAST(order_id AS VARCHAR)"),
        _duplicates("fact_order_items", "order_id, line_number", "concat_ws('|', order_id, line_number)"),
        _duplicates("fact_support_tickets", "ticket_id", "CAST(ticket_id AS VARCHAR)"),
    ])),
    "explosion_factors": sql(" UNION ALL ".join(_explosion(a, b) for a, b, _ in report.FACT_JOINS)),
    "true_join_fanout": sql(" UNION ALL ".join(_fanout(*join) for join in report.FACT_JOINS)),
    "business_invariants": sql(_INVARIANT_SQL),
    "constraint_audit": sql(_CONSTRAINT_SQL, more=_LABELS),
    "constraint_filter": sql("""
        SELECT order_id, order_date, delivery_date, 'delivery_after_order' AS broken_rules
        FROM fact_orders WHERE delivery_date < order_date"""),
    "missingness": sql(_MISSING_SQL),
    "missing_ranking": sql("""
        SELECT column_name, null_pct, missing_type FROM missing_report WHERE null_pct > 0""", more=_MORE),
    "feature_coverage": sql("SELECT * FROM coverage_report", cutoffs=_TWO, more=_MORE),
    "stop_go_summary": sql(f"""
        SELECT 'Key Integrity' AS check_name,
               CASE WHEN sum(duplicate_keys) = 0 AND coalesce(sum(orphan_rows), 0) = 0 THEN 'PASS' ELSE 'FAIL' END
                   AS status, {_quoted(audit.CHECKS['Key Integrity'])} AS description FROM key_report
        UNION ALL SELECT 'Business Invariants', CASE WHEN sum(violations) = 0 THEN 'PASS' ELSE 'FAIL' END,
                  {_quoted(audit.CHECKS['Business Invariants'])} FROM invariant_report
        UNION ALL SELECT 'Feature Coverage',
                  CASE WHEN customers_without_features = 0 AND customers_with_labels > 0 THEN 'PASS' ELSE 'FAIL' END,
                  {_quoted(audit.CHECKS['Feature Coverage'])} FROM coverage_report""", cutoffs=_TWO, more=_MORE),
    "audit_views": sql(f"""
        SELECT 'key' AS kind, table_name AS subject, duplicate_keys + coalesce(orphan_rows, 0) AS amount
        FROM key_report WHERE (dup_rate_pct > 0 OR orphan_rate_pct > 0) AND table_name <> 'dim_products'
        UNION ALL SELECT 'invariant', invariant_name, violations FROM invariant_report WHERE violations > 0
        UNION ALL SELECT 'coverage', stop_go_status, customers_without_features FROM coverage_report
        UNION ALL SELECT 'join', join_name, n_right FROM joins WHERE explosion_factor > 1
        UNION ALL SELECT 'gate', 'Key Integrity', NULL FROM key_report WHERE table_name <> 'dim_products'
                  HAVING sum(duplicate_keys) > 0 OR sum(orphan_rows) > 0
        UNION ALL SELECT 'gate', 'Business Invariants', NULL FROM invariant_report HAVING sum(violations) > 0
        UNION ALL SELECT 'gate', 'Feature Coverage', NULL FROM coverage_report WHERE customers_without_features > 0""",
        cutoffs=_TWO,
        more={**_MORE, "joins": " UNION ALL ".join(_explosion(a, b) for a, b, _ in report.FACT_JOINS)}),
    "stop_go_reasons_month": sql(_REASONS_SQL, more=_MORE),
    "stop_go_reasons_year": sql(_REASONS_SQL, YEAR, more=_MORE),
    "quality_overview": sql("""
        SELECT count(*) AS n_customers, CAST(14 AS INTEGER) AS n_features, round(avg(churn_label), 6) AS churn_rate,
               count(*) FILTER (WHERE churn_label = 1) AS n_churn, count(*) FILTER (WHERE churn_label = 0) AS n_no_churn,
               CAST(5 AS BIGINT) AS n_key_integrity, CAST(3 AS BIGINT) AS n_explosion_factors,
               CAST(3 AS BIGINT) AS n_business_invariants, CAST(16 AS BIGINT) AS n_missingness,
               CAST(3 AS BIGINT) AS n_stop_go_summary, count(DISTINCT churn_label) AS n_class_balance,
               CAST(11 AS BIGINT) AS n_describe
        FROM matrix""", YEAR),
    "quality_report_values": sql(f"""
        SELECT section, subject, figure, round(CAST(amount AS DOUBLE), 4) AS amount FROM (
            SELECT 'key_integrity' AS section, table_name AS subject, 'duplicate_keys' AS figure, CAST(duplicate_keys AS DOUBLE) AS amount
            FROM key_report
            UNION ALL SELECT 'key_integrity', table_name, 'orphan_rows', orphan_rows FROM key_report
            UNION ALL SELECT 'explosion_factors', join_name, 'explosion_factor', explosion_factor FROM joins
            UNION ALL SELECT 'business_invariants', invariant_name, 'violations', violations FROM invariant_report
            UNION ALL SELECT 'missingness', column_name, 'null_pct', null_pct FROM missing_report
            UNION ALL SELECT 'missingness', column_name, 'over_threshold', CAST(over_threshold AS INTEGER) FROM missing_report
            UNION ALL SELECT 'feature_coverage', stop_go_status, 'customers_without_features', customers_without_features FROM coverage_report
            UNION ALL SELECT 'stop_go_summary', 'Key Integrity', 'passed',
                      CAST(sum(duplicate_keys) = 0 AND coalesce(sum(orphan_rows), 0) = 0 AS INTEGER) FROM key_report
            UNION ALL SELECT 'stop_go_summary', 'Business Invariants', 'passed', CAST(sum(violations) = 0 AS INTEGER) FROM invariant_report
            UNION ALL SELECT 'stop_go_summary', 'Feature Coverage', 'passed',
                      CAST(customers_without_features = 0 AND customers_with_labels > 0 AS INTEGER) FROM coverage_report
            UNION ALL SELECT 'class_balance', CAST(churn_label AS VARCHAR), 'cnt', count(*) FROM matrix GROUP BY churn_label
            {' '.join(f"UNION ALL SELECT 'describe', '{c}', 'cnt', count({c}) FROM matrix" for c in NUMERIC_FEATURES)}
        ) WHERE amount IS NOT NULL""",
        more={**_MORE, "joins": " UNION ALL ".join(_explosion(a, b) for a, b, _ in report.FACT_JOINS)}),
    "describe_features": sql(" UNION ALL ".join(_described(c) for c in NUMERIC_FEATURES)),
    "correlation_matrix": sql(" UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_correlated(a, b)} AS correlation FROM matrix"
        for a, b in _PAIRS
    ), YEAR),
    "target_correlation": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_correlated(c, 'churn_label')} AS correlation FROM matrix" for c in NUMERIC_FEATURES
    ), YEAR),
    "class_balance": sql("""
        SELECT churn_label, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM churn_labels), 6) AS class_share
        FROM churn_labels GROUP BY 1""", YEAR),
    "histogram": sql("""
        SELECT g.churn_label, g.feature, g.bin, round(lo + g.bin * ((hi - lo) / 30), 3) AS bin_start,
               CAST(coalesce(cnt, 0) AS BIGINT) AS cnt, round(coalesce(cnt, 0) / (n * ((hi - lo) / 30)), 3) AS density
        FROM grid g LEFT JOIN binned b ON g.churn_label = b.churn_label AND g.feature = b.feature AND g.bin = b.bin""",
        YEAR, more=_HISTOGRAM_MORE),
}

