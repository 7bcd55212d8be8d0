from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import star
from keepwell.functions.dates import parse_date
from keepwell.operators import cleaning
from keepwell.operators.constraints import insert_if_absent, keep_one_per_key, split_by_rules, validate_requests, with_defaults
from keepwell.params import Cleaning
from keepwell.sources.schemas import RULES, Rule


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("xx",), (None,), ("2023-01-01",)], "d string")
    assert [r[0] for r in df.select(parse_date("d")).collect()] == [None, None, date(2023, 1, 1)]


def test_iqr_fence_and_cap(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "x double")
    assert cleaning.iqr_fence(df, "x") == pytest.approx((1.75 - 4.5, 4.75 + 4.5))
    assert sorted(r[0] for r in cleaning.cap_iqr(df, "x").collect()) == [1, 2, 3, 9.25]
    empty = df.filter("x > 100")
    assert cleaning.cap_iqr(empty, "x").count() == 0


def test_mode_prefers_the_smallest(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", "a", "b", "c", None)], "x string")
    assert cleaning.modes(df, ["x"]) == {"x": "a"}
    assert cleaning.impute_mode(df, ["x", "absent"]).filter("x = 'a'").count() == 3


def test_sparse_share_is_strict(spark):
    df = spark.createDataFrame([(i, None if i < 4 else 1, None if i < 5 else 1) for i in range(10)], "k int, a int, b int")
    assert cleaning.sparse_columns(df, 0.4) == ["b"]
    assert cleaning.drop_sparse_columns(df, 0.4, protected=["b"]).columns == ["k", "a", "b"]


def test_negative_amounts_take_the_median_of_the_rest(spark):
    df = spark.createDataFrame([(float(v),) for v in (-5, 1, 2, 9)], "total_amount double")
    assert sorted(r[0] for r in cleaning.fix_positive_amounts(df).collect()) == [1, 2, 2, 9]


def test_clean_orders(spark):
    raw = star.orders(
        spark,
        ("A", "C", "2023-01-05", "2023-01-01", "COMPLETED", 10),
        ("B", "C", "2023-01-05", "2023-01-09", "COMPLETED", -1),
        ("C", "C", "2023-01-05", None, "COMPLETED", 12),
        ("D", "C", "2023-01-05", "2023-01-09", "RETURNED", 1000),
        ("E", "C", "2023-01-05", "2023-01-09", "RETURNED", 11),
    ).withColumn("channel", F.lit(None).cast("string")).withColumn(
        "payment_method", F.when(F.col("order_id") != "A", F.lit("PSE"))
    )
    cleaned = cleaning.clean_orders(raw, Cleaning())
    got = {r["order_id"]: r for r in cleaned.data.collect()}
    assert "channel" not in cleaned.data.columns and "delivery_date" in cleaned.data.columns
    assert got["A"]["delivery_date"] is None and got["A"]["payment_method"] == "PSE"
    assert got["B"]["total_amount"] == 11.5  # median of 10, 12, 1000, 11
    assert got["D"]["total_amount"] == 12 + 1.5  # quartiles 11 and 12
    report = {(r["step"], r["column_name"]): (r["affected_rows"], r["value"]) for r in cleaned.report.collect()}
    assert report == {
        ("rows_before", ""): (5, None), ("rows_after", ""): (5, None),
        ("violations", "delivery_date"): (1, None), ("violations", "total_amount"): (1, None),
        ("dropped", "channel"): (5, None), ("imputed", "payment_method"): (1, "mode=PSE"),
        ("capped", "total_amount"): (1, None),
    }


def test_clean_tickets(spark):
    raw = star.tickets(spark, ("A", "C", "2023-01-01", 9), ("B", "C", "2023-01-01", 2), ("D", "C", "2023-01-01", 5), ("E", "C", "2023-01-01", None))
    cleaned = cleaning.clean_support_tickets(raw)
    assert sorted(r["satisfaction_score"] for r in cleaned.data.collect()) == [2, 3.5, 3.5, 5]
    report = {r["step"]: (r["affected_rows"], r["value"]) for r in cleaned.report.collect()}
    assert report["violations"] == (1, None) and report["imputed"] == (2, "median=3.5")
    nothing = cleaning.clean_support_tickets(raw.filter("ticket_id = 'A'")).data.collect()
    assert nothing[0]["satisfaction_score"] is None


def test_clean_customers_keeps_the_last_row(spark):
    rows = [("C", "2022-01-01", "VIP", datetime(2023, 1, 1)), ("C", "2022-01-02", None, datetime(2023, 2, 1)), ("D", "xx", "NEW", None)]
    df = spark.createDataFrame(rows, "customer_id string, registration_date string, customer_segment string, updated_at timestamp")
    cleaned = cleaning.clean_customers(df.withColumn("email_opt_in", F.lit(None).cast("int")))
    got = {r["customer_id"]: (r["registration_date"], r["customer_segment"], r["email_opt_in"]) for r in cleaned.data.collect()}
    assert got == {"C": (date(2022, 1, 2), "STANDARD", 1), "D": (None, "NEW", 1)}
    assert [r["affected_rows"] for r in cleaned.report.orderBy("step").collect()] == [2, 3]


def test_keep_one_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 0, "c")], "k int, v int, t string")
    assert sorted(map(tuple, keep_one_per_key(df, ["k"], ["v"]).collect())) == [(1, 2, "b"), (2, 0, "c")]
    assert sorted(map(tuple, keep_one_per_key(df, ["k"], ["v"], "first").collect())) == [(1, 1, "a"), (2, 0, "c")]


def test_insert_if_absent(spark):
    schema = "k int, v int, q int"
    target = spark.createDataFrame([(1, 0, 1)], schema)
    rows = spark.createDataFrame([(1, 5, 1), (2, 6, 1), (3, 8, 1), (3, 7, 1), (4, 9, -1), (5, 1, None)], schema)
    added = insert_if_absent(target, rows, ["k"], ["v"], [Rule("q", "q > 0")])
    assert sorted(map(tuple, added.collect())) == [(2, 6, 1), (3, 7, 1), (5, 1, None)]
    strict = insert_if_absent(target, rows, ["k"], ["v"], [Rule("q", "q > 0")], not_null=["q"])
    assert strict.count() == 2


def test_split_by_rules_accepts_null(spark):
    df = star.orders(spark, ("A", "C", "2023-01-05", None, "COMPLETED", 1), ("B", "C", "2023-01-05", "2023-01-01", "LOST", -1))
    good, bad = split_by_rules(df, RULES["fact_orders"])
    assert [r["order_id"] for r in good.collect()] == ["A"]
    assert bad.first()["broken_rules"] == ["delivery_after_order", "total_positive", "status"]


def test_defaults(spark):
    df = spark.createDataFrame([(None, None)], "channel string, discount_applied double")
    assert tuple(with_defaults(df, "fact_orders").first()) == ("WEB", 0.0)


def test_request_validation(spark):
    schema = (
        "customer_id string, recency_days double, frequency_orders int, monetary_total double, monetary_avg_order double, "
        "category_diversity int, days_since_registration double, avg_satisfaction_score double, customer_segment string"
    )
    rows = [
        ("ok", 45.0, 8, 1250.5, 156.31, 3, 420.0, None, None),
        ("edge", 3650.0, 10000, 0.0, 0.0, 50, 0.0, 1.0, "VIP"),
        ("bad", 3651.0, -1, -0.1, None, 51, None, 5.5, "OTHER"),
    ]
    got = {r["customer_id"]: r for r in validate_requests(spark.createDataFrame(rows, schema)).collect()}
    assert got["ok"]["errors"] == [] and got["ok"]["customer_segment"] == "STANDARD" and got["ok"]["return_rate"] == 0
    assert got["edge"]["errors"] == []
    assert got["bad"]["errors"] == [
        "avg_satisfaction_score", "category_diversity", "customer_segment", "days_since_registration",
        "frequency_orders", "monetary_avg_order", "monetary_total", "recency_days",
    ]
    with pytest.raises(ValueError, match="recency_days"):
        validate_requests(spark.createDataFrame([("x",)], "customer_id string"))
