"""What the registered queries share: the tables of a folder, and the same tables as SQL text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.operators import baselines
from keepwell.params import MATRIX_NUMERIC, Params
from keepwell.plans.matrix import assemble, fit_medians, impute
from keepwell.session import settle, shared_folder
from keepwell.sources.retail import CUTOFF, EVENT_SHIFT_DAYS, Retail
from keepwell.sources.tables import Bundle

EARLIER = date(1997, 3, 31)
COHORTS = (date(1996, 12, 31), EARLIER, CUTOFF)

MONTH = Params(cutoff=CUTOFF)
# With a year of prediction about a fifth of the customers churn.
YEAR = MONTH.at(prediction_days=365)

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def window_of(params: Params, cutoffs: Sequence[date] | None = None) -> tuple[date, date]:
    """The days that features and labels of the cutoffs see."""
    days = list(cutoffs or [params.cutoff])
    return min(days) - timedelta(days=params.observation_days), max(days) + timedelta(days=params.prediction_days)


def bundle_of(spark: SparkSession, folder: str, params: Params = MONTH, cutoffs: Sequence[date] | None = None) -> Bundle:
    # Customers of the matrix have an order of an observation window, which ends with the last cutoff.
    return Retail(spark, folder).bundle(params.cutoff, window_of(params, cutoffs), max(cutoffs or [params.cutoff]))


def raw_matrix(spark: SparkSession, folder: str, params: Params = MONTH, cutoffs: Sequence[date] | None = None) -> DataFrame:
    return assemble(bundle_of(spark, folder, params, cutoffs), params, cutoffs)


def matrices(
    spark: SparkSession, folder: str, params: Params = MONTH, cutoffs: Sequence[date] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored raw matrix and the imputed one that reads it."""
    raw = settle(raw_matrix(spark, folder, params, cutoffs))
    return raw, impute(raw, fit_medians(raw))


def matrix(spark: SparkSession, folder: str, params: Params = MONTH, cutoffs: Sequence[date] | None = None) -> DataFrame:
    return matrices(spark, folder, params, cutoffs)[1]


def scored(spark: SparkSession, folder: str, params: Params = YEAR) -> DataFrame:
    """The matrix with the composite rule score, a number in 0..1, as ``score``."""
    whole = matrix(spark, folder, params)
    return whole.withColumn("score", F.round(baselines.rfm_score(whole), 9))


def star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = Retail(spark, folder)
    return {
        "dim_customers": tables.customers_head,
        "dim_products": tables.products,
        "fact_orders": tables.orders,
        "fact_order_items": tables.lines,
        "fact_support_tickets": tables.tickets,
    }


STAR_KEYS = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "fact_orders": ("order_id",),
    "fact_order_items": ("order_id", "line_number"),
    "fact_support_tickets": ("ticket_id",),
}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# -- SQL ----------------------------------------------------------------------------------------------


def day(value: date) -> str:
    return f"DATE '{value.isoformat()}'"


TABLES = {
    "orders_head": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RETURNED' WHEN 'P' THEN 'CANCELLED' END
                   AS order_status,
               o_totalprice AS total_amount, CAST(NULL AS DOUBLE) AS discount_applied,
               o_orderpriority AS payment_method, CAST(NULL AS VARCHAR) AS channel
        FROM orders""",
    "delivered": """
        SELECT l_orderkey AS order_id, CAST(max(l_shipdate) AS DATE) AS delivery_date FROM lineitem GROUP BY 1""",
    "fact_orders": """
        SELECT order_id, customer_id, order_date, delivery_date, order_status, total_amount, discount_applied,
               payment_method, channel
        FROM orders_head LEFT JOIN delivered USING (order_id)""",
    "fact_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
               l_quantity AS quantity, l_extendedprice AS unit_price
        FROM lineitem""",
    "dim_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
               p_retailprice AS unit_price, CAST(NULL AS DOUBLE) AS unit_cost, CAST(NULL AS INTEGER) AS is_active
        FROM part""",
    "items": """
        SELECT order_id, product_id, quantity, i.unit_price, category, subcategory
        FROM fact_order_items i JOIN dim_products p USING (product_id)""",
    "fact_support_tickets": f"""
        SELECT event_id AS ticket_id, user_id AS customer_id, CAST(ts AS DATE) - {EVENT_SHIFT_DAYS} AS created_date,
               CAST(NULL AS DATE) AS resolved_date, event_type AS ticket_type, CAST(NULL AS VARCHAR) AS priority,
               CAST(NULL AS VARCHAR) AS resolution_status, value AS satisfaction_score
        FROM events""",
    "dim_customers": """
        SELECT c_custkey AS customer_id, n_name AS country, c_mktsegment AS customer_segment,
               CAST(NULL AS INTEGER) AS email_opt_in
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "registrations": """
        SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) AS registration_date FROM orders GROUP BY 1""",
    "preferred": f"""
        SELECT customer_id, category AS preferred_category, lines AS preferred_lines
        FROM (SELECT customer_id, category, count(*) AS lines,
                     row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS rn
              FROM items JOIN orders_head USING (order_id) WHERE order_date <= {day(CUTOFF)} GROUP BY 1, 2)
        WHERE rn = 1""",
    "customers": """
        SELECT customer_id, registration_date, country, customer_segment, preferred_category, email_opt_in
        FROM dim_customers LEFT JOIN registrations USING (customer_id) LEFT JOIN preferred USING (customer_id)""",
}


def matrix_tables(params: Params = MONTH, cutoffs: Sequence[date] | None = None) -> dict[str, str]:
    """The matrix and its parts for the given cutoffs as SQL."""
    listed = ", ".join(f"({day(c)})" for c in (cutoffs or [params.cutoff]))
    days, ahead = params.observation_days, params.prediction_days
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MATRIX_NUMERIC)
    middles = ", ".join(f"median({c}) AS {c}" for c in MATRIX_NUMERIC)
    last = {"support_tickets_90d": ", 0"}
    filled = ", ".join(f"coalesce(r.{c}, m.{c}{last.get(c, '')}) AS {c}" for c in MATRIX_NUMERIC)
    return {
        "cutoffs": f"SELECT * FROM (VALUES {listed}) AS v(cutoff_date)",
        "window_orders": f"""
            SELECT cutoff_date, o.* FROM fact_orders o JOIN cutoffs
            ON order_date BETWEEN cutoff_date - {days} AND cutoff_date""",
        "churn_labels": f"""
            SELECT customer_id, cutoff_date, CAST(cutoff_date - {days} AS DATE) AS observation_start,
                   CAST(cutoff_date + {ahead} AS DATE) AS prediction_end,
                   CAST(count(*) FILTER (WHERE order_date > cutoff_date) = 0 AS INTEGER) AS churn_label,
                   count(*) FILTER (WHERE order_date <= cutoff_date) AS orders_in_obs_window,
                   count(*) FILTER (WHERE order_date > cutoff_date) AS orders_in_pred_window,
                   max(order_date) FILTER (WHERE order_date <= cutoff_date) AS last_order_date
            FROM orders_head JOIN cutoffs ON order_date BETWEEN cutoff_date - {days} AND cutoff_date + {ahead}
            GROUP BY customer_id, cutoff_date HAVING count(*) FILTER (WHERE order_date <= cutoff_date) > 0""",
        "order_features": f"""
            SELECT customer_id, cutoff_date,
                   date_diff('day', max(order_date) FILTER (WHERE order_status = 'COMPLETED'), cutoff_date)
                       AS recency_days,
                   nullif(count(*) FILTER (WHERE order_status = 'COMPLETED'), 0) AS frequency_orders,
                   sum(total_amount) FILTER (WHERE order_status = 'COMPLETED') AS monetary_total,
                   avg(total_amount) FILTER (WHERE order_status = 'COMPLETED') AS monetary_avg_order,
                   sum(total_amount) FILTER (WHERE order_status = 'COMPLETED') / {days}.0 AS spending_intensity,
                   avg(date_diff('day', order_date, delivery_date)) FILTER (WHERE order_status = 'COMPLETED')
                       AS avg_delivery_days,
                   count(*) FILTER (WHERE order_status = 'RETURNED') / CAST(count(*) AS DOUBLE) AS return_rate
            FROM window_orders GROUP BY 1, 2""",
        "trend": """
            SELECT customer_id, cutoff_date, CASE WHEN count(*) < 2 THEN 0.0 ELSE regr_slope(amount, x) END AS trend_slope_30d
            FROM (SELECT customer_id, cutoff_date, sum(total_amount) AS amount,
                         row_number() OVER (PARTITION BY customer_id, cutoff_date
                                            ORDER BY year(order_date) * 100 + weekofyear(order_date)) - 1 AS x
                  FROM window_orders WHERE order_status = 'COMPLETED'
                  GROUP BY customer_id, cutoff_date, year(order_date) * 100 + weekofyear(order_date))
            GROUP BY 1, 2""",
        "diversity": """
            SELECT customer_id, cutoff_date, count(DISTINCT category) AS category_diversity
            FROM window_orders LEFT JOIN items USING (order_id) WHERE order_status = 'COMPLETED' GROUP BY 1, 2""",
        "support": f"""
            SELECT customer_id, cutoff_date, count(*) AS support_tickets_90d,
                   avg(satisfaction_score) AS avg_satisfaction_score
            FROM fact_support_tickets JOIN cutoffs ON created_date BETWEEN cutoff_date - {days} AND cutoff_date
            GROUP BY 1, 2""",
        "raw_matrix": f"""
            SELECT customer_id, cutoff_date, {numbers}, customer_segment, preferred_category, churn_label
            FROM (SELECT *, date_diff('day', registration_date, cutoff_date) AS days_since_registration
                  FROM churn_labels
                  LEFT JOIN order_features USING (customer_id, cutoff_date)
                  LEFT JOIN trend USING (customer_id, cutoff_date)
                  LEFT JOIN diversity USING (customer_id, cutoff_date)
                  LEFT JOIN support USING (customer_id, cutoff_date)
                  LEFT JOIN customers USING (customer_id))""",
        "medians": f"SELECT cutoff_date, {middles} FROM raw_matrix GROUP BY 1",
        "matrix": f"""
            SELECT r.customer_id, r.cutoff_date, {filled},
                   coalesce(customer_segment, 'STANDARD') AS customer_segment,
                   coalesce(preferred_category, 'Unknown') AS preferred_category, churn_label
            FROM raw_matrix r JOIN medians m USING (cutoff_date)""",
        "scored": """
            SELECT *, round(0.0 + (CASE WHEN rh > rl THEN (recency_days - rl) / (rh - rl) ELSE 0.0 END) * (0.5 / 1.0)
                     + (1.0 - CASE WHEN fh > fl THEN (frequency_orders - fl) / (fh - fl) ELSE 0.0 END) * (0.3 / 1.0)
                     + (1.0 - CASE WHEN mh > ml THEN (monetary_total - ml) / (mh - ml) ELSE 0.0 END) * (0.2 / 1.0), 9)
                     AS score
            FROM matrix, (SELECT min(recency_days) AS rl, max(recency_days) AS rh,
                                 min(frequency_orders) AS fl, max(frequency_orders) AS fh,
                                 min(monetary_total) AS ml, max(monetary_total) AS mh FROM matrix)""",
    }


def sql(
    body: str, params: Params = MONTH, cutoffs: Sequence[date] | None = None, more: dict[str, str] | None = None
) -> str:
    """``body`` preceded by the common tables it names, directly or through one another."""
    known = {**TABLES, **matrix_tables(params, cutoffs), **(more or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    listed = ",\n".join(f"{name} AS MATERIALIZED ({known[name]})" for name in needed)
    return f"WITH {listed}\n{body}" if needed else body


def matrix_select(source: str = "matrix", digits: int = 6) -> str:
    numbers = ", ".join(f"round({c}, {digits}) AS {c}" for c in MATRIX_NUMERIC)
    return f"SELECT customer_id, cutoff_date, {numbers}, customer_segment, preferred_category, churn_label FROM {source}"


def number(column: Column, digits: int = 6) -> Column:
    return F.round(column, digits)
