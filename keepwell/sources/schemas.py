"""Star schema: column types, keys, parents, defaults and row rules of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Accepted codes.
SEGMENTS = ("VIP", "STANDARD", "NEW", "AT_RISK")
ORDER_STATUSES = ("COMPLETED", "CANCELLED", "RETURNED", "PENDING", "FAILED")
TICKET_TYPES = ("DELIVERY_ISSUE", "PRODUCT_DEFECT", "REFUND", "BILLING", "OTHER")

COLUMNS = {
    "dim_customers": """
        customer_id string not null, registration_date date not null, country string not null,
        customer_segment string, preferred_category string, email_opt_in int,
        created_at timestamp, updated_at timestamp""",
    "dim_products": """
        product_id string not null, product_name string not null, category string not null,
        subcategory string, unit_price double not null, unit_cost double, is_active int""",
    "fact_orders": """
        order_id string not null, customer_id string not null, order_date date not null,
        delivery_date date, order_status string not null, total_amount double not null,
        discount_applied double, payment_method string, channel string""",
    "fact_order_items": """
        item_id bigint not null, order_id string not null, product_id string not null,
        quantity int not null, unit_price double not null""",
    "fact_support_tickets": """
        ticket_id string not null, customer_id string not null, created_date date not null,
        resolved_date date, ticket_type string not null, priority string,
        resolution_status string, satisfaction_score int""",
    "ml_churn_labels": """
        customer_id string not null, cutoff_date date not null, observation_start date not null,
        prediction_end date not null, churn_label int not null, orders_in_obs_window bigint,
        orders_in_pred_window bigint, last_order_date date""",
    "ml_feature_store": """
        customer_id string not null, cutoff_date date not null, recency_days double,
        frequency_orders double, monetary_total double, monetary_avg_order double,
        spending_intensity double, trend_slope_30d double, category_diversity double,
        support_tickets_90d double, avg_satisfaction_score double, avg_delivery_days double,
        return_rate double, days_since_registration double, customer_segment string,
        preferred_category string, pipeline_version string""",
    "ml_predictions_log": """
        customer_id string not null, prediction_date timestamp, model_version string not null,
        churn_probability double not null, churn_flag int not null,
        decision_threshold double not null, action_triggered string""",
}

KEYS = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "fact_orders": ("order_id",),
    "fact_order_items": ("item_id",),
    "fact_support_tickets": ("ticket_id",),
    "ml_churn_labels": ("customer_id", "cutoff_date"),
    "ml_feature_store": ("customer_id", "cutoff_date"),
}

# (child, column, parent)
PARENTS = (
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_order_items", "order_id", "fact_orders"),
    ("fact_order_items", "product_id", "dim_products"),
    ("fact_support_tickets", "customer_id", "dim_customers"),
)

# Column defaults.
DEFAULTS = {
    "dim_customers": {"country": "CO", "customer_segment": "STANDARD", "email_opt_in": 1},
    "dim_products": {"is_active": 1},
    "fact_orders": {"order_status": "COMPLETED", "discount_applied": 0.0, "channel": "WEB"},
    "fact_order_items": {"quantity": 1},
    "fact_support_tickets": {"priority": "MEDIUM", "resolution_status": "OPEN"},
}


@dataclass(frozen=True)
class Rule:
    """A row rule. A row breaks it when ``holds`` is false; NULL is accepted, as SQL CHECK does."""

    name: str
    holds: str


def _one_of(column: str, codes: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(code) for code in codes)})"


RULES = {
    "dim_customers": (
        Rule("segment", _one_of("customer_segment", SEGMENTS)),
        Rule("email_opt", "email_opt_in IN (0, 1)"),
    ),
    "dim_products": (Rule("price", "unit_price > 0"),),
    "fact_orders": (
        Rule("delivery_after_order", "delivery_date >= order_date"),
        Rule("total_positive", "total_amount >= 0"),
        Rule("discount_non_negative", "discount_applied >= 0"),
        Rule("status", _one_of("order_status", ORDER_STATUSES)),
    ),
    "fact_order_items": (
        Rule("qty_positive", "quantity > 0"),
        Rule("item_price", "unit_price >= 0"),
    ),
    "fact_support_tickets": (
        Rule("ticket_type", _one_of("ticket_type", TICKET_TYPES)),
        Rule("satisfaction", "satisfaction_score BETWEEN 1 AND 5"),
        Rule("resolved_after_created", "resolved_date >= created_date"),
    ),
    "ml_churn_labels": (Rule("churn_binary", "churn_label IN (0, 1)"),),
    "ml_predictions_log": (
        Rule("prob_range", "churn_probability BETWEEN 0.0 AND 1.0"),
        Rule("flag", "churn_flag IN (0, 1)"),
    ),
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(COLUMNS[table])
