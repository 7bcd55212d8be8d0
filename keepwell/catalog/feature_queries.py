"""Registered queries: sources, features and labels."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from keepwell.catalog.base import (
    COHORTS, CUTOFF, EARLIER, MONTH, YEAR, matrix, matrix_select, matrix_tables, raw_matrix, rounded, scratch, sql,
)
from keepwell.operators import features as feats
from keepwell.operators.audit import stack
from keepwell.operators.constraints import insert_if_absent, require_columns, require_rows, with_defaults
from keepwell.params import MATRIX_NUMERIC
from keepwell.plans.matrix import feature_matrix
from keepwell.plans.training import clean_feature_matrix, labelled
from keepwell.session import settle
from keepwell.sources import lineage, sketches, store
from keepwell.sources.ledger import Ledger
from keepwell.sources.retail import Retail
from keepwell.sources.schemas import Rule
from keepwell.sources.tables import between_dates, bounded, labels_of, run_sql

START = MONTH.observation_start
END = CUTOFF


# -- sources ------------------------------------------------------------------------------------------


def scan_orders_window(spark, folder):
    return between_dates(Retail(spark, folder).orders_head, "order_date", START, END)


def order_items_join(spark, folder):
    return Retail(spark, folder).items


def labels_at_cutoff(spark, folder):
    orders = Retail(spark, folder).orders_head
    return labels_of(feats.churn_labels(orders, [EARLIER, CUTOFF]), CUTOFF)


def parameterised_sql(spark, folder):
    orders = Retail(spark, folder).orders_head
    text = """
        SELECT customer_id, count(*) AS n_orders, round(sum(total_amount), 6) AS amount
        FROM {orders} WHERE order_date >= :start AND order_date <= :end GROUP BY customer_id"""
    return run_sql(spark, text, {"start": START, "end": END}, orders=orders)


def point_in_time_bundle(spark, folder):
    known = bounded(labelled(Retail(spark, folder).bundle(), MONTH), MONTH)
    frames = {
        "customers": known.customers, "orders": known.orders, "tickets": known.tickets, "labels": known.labels
    }
    return stack([
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in frames.items()
    ])


def feature_preview(spark, folder):
    return rounded(store.preview(matrix(spark, folder), "customer_id"))


def feature_store_roundtrip(spark, folder):
    path = scratch(spark, "store")
    store.write_matrix(matrix(spark, folder, MONTH, COHORTS), path)
    return rounded(store.read_matrix(spark, path, CUTOFF).select(
        "customer_id", "cutoff_date", *MATRIX_NUMERIC, "customer_segment", "preferred_category", "churn_label"
    ))


def lineage_latest(spark, folder):
    whole = settle(matrix(spark, folder))
    path = scratch(spark, "lineage")
    lineage.record(whole.limit(0), "feature_matrix", "first", path, CUTOFF)
    lineage.record(whole, "feature_matrix", "second", path, CUTOFF)
    newest = lineage.latest_records(spark.read.parquet(path))
    return newest.select(
        "artifact", "path", "rows", F.size("columns").alias("n_columns"),
        F.round("churn_rate", 6).alias("churn_rate"), "cutoff_date",
    )


def dataset_fingerprint(spark, folder):
    """Rows and fingerprint of the orders; amounts as decimals, which all engines write alike."""
    orders = Retail(spark, folder).orders
    return lineage.fingerprint(orders.select(
        "order_id", "customer_id", "order_date", "delivery_date", "order_status", F.col("total_amount").cast("decimal(18,2)")
    ))


def manifest(spark, folder):
    """The record of the matrix as JSON text, written, read and parsed again."""
    whole = settle(matrix(spark, folder))
    path = scratch(spark, "manifest")
    lineage.as_manifest(lineage.lineage_record(whole, "feature_matrix", "matrix", CUTOFF)).write.parquet(path)
    return lineage.from_manifest(spark.read.parquet(path)).select(
        "artifact", "path", "rows", F.size("columns").alias("n_columns"),
        F.round("churn_rate", 6).alias("churn_rate"), "cutoff_date",
    )


def required_columns(spark, folder):
    """What the checks before a run say: of an empty table, and of one without a column."""
    whole = Retail(spark, folder).orders_head
    said = []
    for name, check in (
        ("whole", lambda: (require_rows(whole), require_columns(whole, ["order_id", "order_date"]))),
        ("empty", lambda: require_rows(whole.filter("order_id < 0"))),
        ("without a column", lambda: require_columns(whole.drop("order_date"), ["order_id", "order_date"])),
    ):
        try:
            check()
            said.append((name, True))
        except ValueError:
            said.append((name, False))
    return spark.createDataFrame(said, "input string, passed boolean")


LINE_ORDER = ["product_id", "quantity", "unit_price"]


def insert_new_lines(spark, folder):
    """Lines offered to a table that holds the lines of the orders up to the cutoff."""
    tables = Retail(spark, folder)
    lines = tables.lines
    known = lines.join(tables.orders_head.filter(F.col("order_date") <= F.lit(CUTOFF)).select("order_id"), "order_id", "left_semi")
    rules = (Rule("qty_positive", "quantity > 0"), Rule("item_price", "unit_price >= 5000"))
    return insert_if_absent(known, lines, ["order_id", "line_number"], LINE_ORDER, rules, ["product_id"])


def column_defaults(spark, folder):
    return with_defaults(Retail(spark, folder).orders_head, "fact_orders")


# -- features -----------------------------------------------------------------------------------------


def observed_orders(spark, folder):
    return feats.observed_orders(Retail(spark, folder).orders_head, CUTOFF, 90)


RFM = ("recency_days", "frequency_orders", "monetary_total", "monetary_avg_order", "spending_intensity")


def rfm_features(spark, folder):
    """Recency, frequency, money and churn label per customer at the cutoff."""
    orders = Retail(spark, folder).orders_head
    rolled = feats.order_rollup(orders, [CUTOFF], 90, 30, parts=RFM)
    return rounded(rolled.select("customer_id", "cutoff_date", *RFM, "churn_label"))


def trend_slope(spark, folder):
    rolled = feats.order_rollup(Retail(spark, folder).orders_head, [CUTOFF], 90, parts=("trend_slope_30d",))
    return rounded(rolled.filter(F.col("trend_slope_30d").isNotNull()), 4)


def trend_slope_new_year(spark, folder):
    """Windows across New Year, with the week key of calendar order."""
    rolled = feats.order_rollup(
        Retail(spark, folder).orders_head, [COHORTS[0], EARLIER], 90, iso_year=True, parts=("trend_slope_30d",)
    )
    return rounded(rolled.filter(F.col("trend_slope_30d").isNotNull()), 4)


def category_diversity(spark, folder):
    tables = Retail(spark, folder)
    return feats.category_diversity(tables.orders_head, tables.items, [CUTOFF])


def support_features(spark, folder):
    return rounded(feats.support_features(Retail(spark, folder).tickets, [CUTOFF]))


def logistics_features(spark, folder):
    parts = ("avg_delivery_days", "return_rate")
    return rounded(feats.order_rollup(Retail(spark, folder).orders, [CUTOFF], 90, parts=parts))


def logistics_censored(spark, folder):
    rolled = feats.order_rollup(
        Retail(spark, folder).orders, [CUTOFF], 90, censor_future_delivery=True, parts=("avg_delivery_days",)
    )
    return rounded(rolled)


def tenure(spark, folder):
    return feats.tenure(Retail(spark, folder).customers(), CUTOFF)


def churn_labels(spark, folder):
    return feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF])


def churn_labels_multi_cohort(spark, folder):
    return feats.churn_labels(Retail(spark, folder).orders_head, COHORTS, 90, 365)


def preferred_category(spark, folder):
    tables = Retail(spark, folder)
    return feats.preferred_category(tables.orders_head, tables.items, CUTOFF)


def raw_features(spark, folder):
    return rounded(raw_matrix(spark, folder))


def feature_matrix_query(spark, folder):
    return rounded(matrix(spark, folder))


def feature_matrix_zero_tickets(spark, folder):
    return rounded(feature_matrix(Retail(spark, folder).bundle(), YEAR, zero_tickets=True))


def feature_matrix_multi_cohort(spark, folder):
    return rounded(matrix(spark, folder, MONTH, COHORTS))


def feature_matrix_daily(spark, folder):
    """Seventy daily cutoffs: windows over one table of days.

    Mean scores of 32 or 64 tickets have an exact 5 behind the sixth digit, which any order of summation may round either way.
    """
    whole = matrix(spark, folder, MONTH, DAILY)
    digits = {"avg_satisfaction_score": 9}
    return whole.select(*[F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in whole.dtypes])


def feature_matrix_clean(spark, folder):
    return rounded(clean_feature_matrix(Retail(spark, folder).bundle(), MONTH))


def append_once(spark, folder):
    """Orders that reach a ledger twice: those before the cutoff first, then all, the second batch repeated."""
    orders = settle(Retail(spark, folder).orders_head.select("order_id", "customer_id", "order_date"))
    ledger = Ledger(spark, scratch(spark, "ledger"), orders.schema, ["order_id"])
    ledger.commit("early", orders.filter(F.col("order_date") < F.lit(CUTOFF)))
    ledger.commit("all", orders)
    ledger.commit("all", orders)
    return ledger.rows()


def sketch_store(spark, folder):
    """Amounts and customers of all orders from sketches by month: rows, and whether the median and the count keep their bounds."""
    orders = settle(Retail(spark, folder).orders_head.select("order_date", "customer_id", "total_amount"))
    path = scratch(spark, "sketches")
    sketches.write_sketches(sketches.daily_sketches(orders, "order_date", ["total_amount"], ["customer_id"], grain="month"), path)
    first, last = orders.agg(F.trunc(F.min("order_date"), "month"), F.max("order_date")).first()
    whole = sketches.merged(spark, path, first, last)
    median = sketches.quantiles_of(whole, {"total_amount": [0.5]}).first()
    amount = F.col("total_amount").cast("double")
    true = orders.agg(
        F.count_distinct("customer_id").alias("customers"), F.avg((amount < median["value"]).cast("int")).alias("below"),
        F.avg((amount <= median["value"]).cast("int")).alias("up_to"),
    ).first()
    count = sketches.distinct_of(whole).first()
    kept = (
        true["below"] - median["rank_error"] <= 0.5 <= true["up_to"] + median["rank_error"]
        and abs(count["distinct_values"] - true["customers"]) <= count["relative_error"] * true["customers"]
    )
    return whole.select(F.col("column").alias("column_name"), "kind", F.col("rows").alias("n_rows"), F.lit(kept).alias("within_bounds"))


DAILY = tuple(CUTOFF - timedelta(days=i) for i in range(70))

QUERIES = {
    "scan_orders_window": scan_orders_window,
    "order_items_join": order_items_join,
    "labels_at_cutoff": labels_at_cutoff,
    "parameterised_sql": parameterised_sql,
    "point_in_time_bundle": point_in_time_bundle,
    "feature_preview": feature_preview,
    "feature_store_roundtrip": feature_store_roundtrip,
    "lineage_latest": lineage_latest,
    "dataset_fingerprint": dataset_fingerprint,
    "manifest": manifest,
    "required_columns": required_columns,
    "insert_if_absent": insert_new_lines,
    "append_once": append_once,
    "sketch_store": sketch_store,
    "column_defaults": column_defaults,
    "observed_orders": observed_orders,
    "rfm_features": rfm_features,
    "trend_slope": trend_slope,
    "trend_slope_new_year": trend_slope_new_year,
    "category_diversity": category_diversity,
    "support_features": support_features,
    "logistics_features": logistics_features,
    "logistics_censored": logistics_censored,
    "tenure": tenure,
    "churn_labels": churn_labels,
    "churn_labels_multi_cohort": churn_labels_multi_cohort,
    "preferred_category": preferred_category,
    "raw_features": raw_features,
    "feature_matrix": feature_matrix_query,
    "feature_matrix_zero_tickets": feature_matrix_zero_tickets,
    "feature_matrix_multi_cohort": feature_matrix_multi_cohort,
    "feature_matrix_daily": feature_matrix_daily,
    "feature_matrix_clean": feature_matrix_clean,
}

WINDOW = f"order_date BETWEEN DATE '{START}' AND DATE '{END}'"
LABEL_COLUMNS = (
    "customer_id, cutoff_date, observation_start, prediction_end, churn_label, orders_in_obs_window, "
    "orders_in_pred_window, last_order_date"
)

# The cleaned inputs as SQL: bounded at the cutoff, dates voided, amounts capped, scores voided and filled.
CLEAN = {
    "known_orders": f"SELECT * FROM fact_orders WHERE {WINDOW}",
    "fence": """
        SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3 FROM known_orders""",
    "clean_orders": """
        SELECT order_id, customer_id, order_date,
               CASE WHEN delivery_date >= order_date THEN delivery_date END AS delivery_date, order_status,
               least(greatest(total_amount, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS total_amount,
               payment_method
        FROM known_orders, fence""",
    "known_tickets": f"""
        SELECT ticket_id, customer_id, created_date, ticket_type,
               CASE WHEN satisfaction_score BETWEEN 1 AND 5 THEN satisfaction_score END AS satisfaction_score
        FROM fact_support_tickets WHERE created_date BETWEEN DATE '{START}' AND DATE '{END}'""",
    "clean_tickets": """
        SELECT ticket_id, customer_id, created_date, ticket_type,
               coalesce(satisfaction_score, (SELECT median(satisfaction_score) FROM known_tickets))
                   AS satisfaction_score
        FROM known_tickets""",
}


def _clean_matrix() -> str:
    parts = matrix_tables()
    for name in ("window_orders", "support"):
        parts[name] = parts[name].replace("fact_orders", "clean_orders").replace("fact_support_tickets", "clean_tickets")
    return sql(matrix_select(), more={**CLEAN, **parts})


ORACLE = {
    "scan_orders_window": sql(f"SELECT * FROM orders_head WHERE {WINDOW}"),
    "order_items_join": sql("SELECT * FROM items"),
    "labels_at_cutoff": sql(f"SELECT {LABEL_COLUMNS} FROM churn_labels WHERE cutoff_date = DATE '{CUTOFF}'",
                            cutoffs=[EARLIER, CUTOFF]),
    "parameterised_sql": sql(f"""
        SELECT customer_id, count(*) AS n_orders, round(sum(total_amount), 6) AS amount
        FROM orders_head WHERE {WINDOW} GROUP BY 1"""),
    "point_in_time_bundle": sql(f"""
        SELECT 'customers' AS table_name, count(*) AS n_rows FROM dim_customers
        UNION ALL SELECT 'orders', count(*) FROM orders_head WHERE {WINDOW}
        UNION ALL SELECT 'labels', count(*) FROM churn_labels
        UNION ALL SELECT 'tickets', count(*) FROM fact_support_tickets
                  WHERE created_date BETWEEN DATE '{START}' AND DATE '{END}'"""),
    "feature_preview": sql(matrix_select() + " ORDER BY customer_id LIMIT 10"),
    "feature_store_roundtrip": sql(matrix_select() + f" WHERE cutoff_date = DATE '{CUTOFF}'", cutoffs=COHORTS),
    "dataset_fingerprint": sql("""
        SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|',
                   coalesce(CAST(customer_id AS VARCHAR), '\\N'), coalesce(CAST(delivery_date AS VARCHAR), '\\N'),
                   coalesce(CAST(order_date AS VARCHAR), '\\N'), coalesce(CAST(order_id AS VARCHAR), '\\N'),
                   coalesce(order_status, '\\N'), coalesce(CAST(CAST(total_amount AS DECIMAL(18, 2)) AS VARCHAR), '\\N')
               )), 1, 15) AS BIGINT)) AS VARCHAR) AS fingerprint
        FROM fact_orders"""),
    "manifest": sql(f"""
        SELECT 'feature_matrix' AS artifact, 'matrix' AS path, count(*) AS rows, CAST(17 AS INTEGER) AS n_columns,
               round(avg(churn_label), 6) AS churn_rate, DATE '{CUTOFF}' AS cutoff_date
        FROM matrix"""),
    "required_columns": sql("""
        SELECT 'whole' AS input, count(*) > 0 AS passed FROM orders_head
        UNION ALL SELECT 'empty', false UNION ALL SELECT 'without a column', false"""),
    "lineage_latest": sql(f"""
        SELECT 'feature_matrix' AS artifact, 'second' AS path, count(*) AS rows, CAST(17 AS INTEGER) AS n_columns,
               round(avg(churn_label), 6) AS churn_rate, DATE '{CUTOFF}' AS cutoff_date
        FROM matrix"""),
    "insert_if_absent": sql(f"""
        SELECT order_id, line_number, product_id, quantity, unit_price
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number
                                           ORDER BY product_id, quantity, unit_price) AS rn
              FROM fact_order_items WHERE quantity > 0 AND unit_price >= 5000 AND product_id IS NOT NULL)
        WHERE rn = 1 AND (order_id, line_number) NOT IN (
            SELECT (order_id, line_number) FROM fact_order_items JOIN orders_head USING (order_id)
            WHERE order_date <= DATE '{CUTOFF}')"""),
    "column_defaults": sql("""
        SELECT order_id, customer_id, order_date, coalesce(order_status, 'COMPLETED') AS order_status, total_amount,
               coalesce(discount_applied, 0.0) AS discount_applied, payment_method,
               coalesce(channel, 'WEB') AS channel
        FROM orders_head"""),
    "observed_orders": sql(f"SELECT * FROM orders_head WHERE {WINDOW} AND order_status = 'COMPLETED'"),
    "rfm_features": sql(f"""
        SELECT customer_id, cutoff_date, CAST(recency_days AS INTEGER) AS recency_days, frequency_orders,
               {', '.join(f'round({c}, 6) AS {c}' for c in RFM[2:])}, churn_label
        FROM churn_labels LEFT JOIN order_features USING (customer_id, cutoff_date)"""),
    "trend_slope": sql("SELECT customer_id, cutoff_date, round(trend_slope_30d, 4) AS trend_slope_30d FROM trend"),
    "trend_slope_new_year": sql("""
        SELECT customer_id, cutoff_date, round(CASE WHEN count(*) < 2 THEN 0.0 ELSE regr_slope(amount, x) END, 4) AS trend_slope_30d
        FROM (SELECT customer_id, cutoff_date, sum(total_amount) AS amount,
                     row_number() OVER (PARTITION BY customer_id, cutoff_date
                                        ORDER BY date_trunc('week', order_date)) - 1 AS x
              FROM window_orders WHERE order_status = 'COMPLETED'
              GROUP BY customer_id, cutoff_date, date_trunc('week', order_date))
        GROUP BY 1, 2""", cutoffs=[COHORTS[0], EARLIER]),
    "category_diversity": sql("SELECT customer_id, cutoff_date, category_diversity FROM diversity"),
    "support_features": sql("""
        SELECT customer_id, cutoff_date, support_tickets_90d,
               round(avg_satisfaction_score, 6) AS avg_satisfaction_score
        FROM support"""),
    "logistics_features": sql("""
        SELECT customer_id, cutoff_date, round(avg_delivery_days, 6) AS avg_delivery_days,
               round(return_rate, 6) AS return_rate
        FROM order_features"""),
    "logistics_censored": sql("""
        SELECT customer_id, cutoff_date,
               round(avg(date_diff('day', order_date, delivery_date))
                     FILTER (WHERE order_status = 'COMPLETED' AND delivery_date <= cutoff_date), 6) AS avg_delivery_days
        FROM window_orders GROUP BY 1, 2"""),
    "tenure": sql(f"""
        SELECT customer_id, CAST(date_diff('day', registration_date, DATE '{CUTOFF}') AS INTEGER)
                   AS days_since_registration
        FROM customers"""),
    "churn_labels": sql(f"SELECT {LABEL_COLUMNS} FROM churn_labels"),
    "churn_labels_multi_cohort": sql(f"SELECT {LABEL_COLUMNS} FROM churn_labels", YEAR, COHORTS),
    "preferred_category": sql("SELECT customer_id, preferred_category, preferred_lines FROM preferred"),
    "raw_features": sql(matrix_select("raw_matrix")),
    "feature_matrix": sql(matrix_select()),
    "feature_matrix_zero_tickets": sql(
        matrix_select().replace(
            "round(support_tickets_90d, 6)", "round(coalesce((SELECT support_tickets_90d FROM raw_matrix r "
            "WHERE r.customer_id = matrix.customer_id), 0), 6)"
        ), YEAR),
    "feature_matrix_multi_cohort": sql(matrix_select(), cutoffs=COHORTS),
    "sketch_store": sql("""
        SELECT 'total_amount' AS column_name, 'quantiles' AS kind, count(total_amount) AS n_rows, true AS within_bounds FROM fact_orders
        UNION ALL SELECT 'customer_id', 'distinct', count(customer_id), true FROM fact_orders"""),
    "append_once": sql("SELECT order_id, customer_id, order_date FROM fact_orders"),
    "feature_matrix_daily": sql(
        matrix_select().replace("round(avg_satisfaction_score, 6)", "round(avg_satisfaction_score, 9)"), cutoffs=DAILY),
    "feature_matrix_clean": _clean_matrix(),
}
