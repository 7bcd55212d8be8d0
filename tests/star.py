"""Small star-schema tables."""

from datetime import date, datetime

from keepwell.sources.tables import Bundle

ORDERS = (
    "order_id string, customer_id string, order_date date, delivery_date date, order_status string, "
    "total_amount double, discount_applied double, payment_method string, channel string"
)
ITEMS = "order_id string, product_id string, category string"
TICKETS = "ticket_id string, customer_id string, created_date date, satisfaction_score int"
CUSTOMERS = (
    "customer_id string, registration_date date, customer_segment string, preferred_category string, email_opt_in int"
)
LABELS = "customer_id string, cutoff_date date, churn_label int"


def day(text):
    return date.fromisoformat(text) if text else None


def orders(spark, *rows):
    """(order, customer, order date, delivery date, status, amount)"""
    return spark.createDataFrame(
        [(o, c, day(d), day(v), s, float(a), 0.0, "CARD", "WEB") for o, c, d, v, s, a in rows], ORDERS
    )


def items(spark, *rows):
    return spark.createDataFrame([(o, "P1", c) for o, c in rows], ITEMS)


def tickets(spark, *rows):
    return spark.createDataFrame([(t, c, day(d), s) for t, c, d, s in rows], TICKETS)


def customers(spark, *rows):
    return spark.createDataFrame([(c, day(d), s, p, 1) for c, d, s, p in rows], CUSTOMERS)


def labels(spark, *rows):
    return spark.createDataFrame([(c, day(d), y) for c, d, y in rows], LABELS)


def leakage_bundle(spark):
    return Bundle(
        customers=customers(spark, ("C1", "2022-01-01", "STANDARD", "Home")),
        orders=orders(
            spark,
            ("O1", "C1", "2022-12-30", "2023-01-01", "COMPLETED", 100),
            ("O2", "C1", "2023-01-02", "2023-01-05", "COMPLETED", 500),
        ),
        items=items(spark, ("O1", "Home"), ("O2", "Home")),
        tickets=tickets(spark, ("T1", "C1", "2022-12-31", 5), ("T2", "C1", "2023-01-05", 1)),
        labels=labels(spark, ("C1", "2023-01-01", 0)),
    )


NOW = datetime(2023, 1, 1)
