import hashlib

import pytest
from pyspark.sql import functions as F

from keepwell.operators import decisions


def test_tiers_and_risk(spark):
    rows = [(0.75, 0), (0.7499, 1), (0.50, 0), (0.4999, 1), (0.4999, 0), (0.25, 0), (0.2499, 0)]
    df = spark.createDataFrame(rows, "p double, f int")
    got = df.select(decisions.recommended_action(F.col("p"), F.col("f")), decisions.risk_level(F.col("p"))).collect()
    assert [r[0] for r in got] == [
        decisions.CALL, decisions.PRIORITY, decisions.PRIORITY, decisions.STANDARD, decisions.NO_ACTION,
        decisions.NO_ACTION, decisions.NO_ACTION,
    ]
    assert [r[1] for r in got] == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "LOW"]


def test_predictions_round_half_even_but_flag_unrounded(spark):
    df = spark.createDataFrame([("a", 0.12345), ("b", 0.49996), ("c", 0.30000001)], "customer_id string, probability double")
    got = {r["customer_id"]: r for r in decisions.predictions(df, 0.49998, "v").collect()}
    assert got["a"]["churn_probability"] == 0.1234
    assert (got["b"]["churn_probability"], got["b"]["churn_flag"]) == (0.5, 0)
    assert got["b"]["recommended_action"] == decisions.PRIORITY
    assert got["c"]["decision_threshold"] == 0.49998
    summary = decisions.batch_summary(decisions.predictions(df, 0.3, "v")).first()
    assert tuple(summary) == (3, 2, "v")


def test_serving_defaults_replace_explicit_nulls(spark):
    df = spark.createDataFrame([("a", None, None, 90.0)], "customer_id string, avg_satisfaction_score double, avg_delivery_days double, monetary_total double")
    row = decisions.with_serving_defaults(df).first()
    assert (row["avg_satisfaction_score"], row["avg_delivery_days"], row["spending_intensity"]) == (3.5, 5.0, 1.0)


def test_roi_and_best_action(spark):
    df = spark.createDataFrame([(10, 30)], "tp bigint, fp bigint")
    assert decisions.campaign_roi(df).first()["roi"] == pytest.approx((1200 - 200) / 200)
    none = decisions.campaign_roi(spark.createDataFrame([(0, 0)], "tp bigint, fp bigint")).first()
    assert none["roi"] is None
    people = spark.createDataFrame([("low", 0.01), ("high", 0.9)], "customer_id string, churn_probability double")
    kept = {"coupon": 0.1, "advisor": 0.4}
    got = {r["customer_id"]: r["best_action"] for r in decisions.best_action(people, kept).collect()}
    assert got == {"low": "none", "high": "advisor"}


def test_guardrails(spark):
    df = spark.createDataFrame([(0.3, 0.64, None, 2.0)], "precision double, auc_roc double, auc_pr double, lift_at_20 double")
    assert {r["metric"]: r["passed"] for r in decisions.guardrails(df).collect()} == {
        "precision": True, "auc_roc": False, "auc_pr": False, "lift_at_20": True
    }


def test_stability_index(spark):
    base = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    same = decisions.stability_index(base, base, ["x"]).first()
    assert (same["psi"], same["retrain"]) == (pytest.approx(0.0), False)
    moved = decisions.stability_index(base, base.select((F.col("x") + 200).alias("x")), ["x"]).first()
    assert moved["retrain"]


def test_pseudonyms(spark):
    df = spark.createDataFrame([("C1",)], "customer_id string")
    assert decisions.pseudonymised(df).first()[0] == hashlib.sha256(b"C1").hexdigest()
