import pytest
from pyspark.sql import functions as F

import star
from keepwell.operators import audit, profile
from keepwell.operators.constraints import constraint_audit
from keepwell.plans import report

KEYS = {"dim_customers": ("customer_id",), "fact_orders": ("order_id",)}
PARENTS = (("fact_orders", "customer_id", "dim_customers"),)


def tables(spark):
    return {
        "dim_customers": star.customers(spark, ("C1", "2022-01-01", "VIP", "x"), ("C2", "2022-01-01", "NEW", "x")),
        "fact_orders": star.orders(
            spark,
            ("O1", "C1", "2023-01-01", "2022-12-01", "COMPLETED", 1),
            ("O1", "C1", "2023-01-01", None, "COMPLETED", -1),
            ("O2", "C9", "2023-01-01", "2023-01-01", "COMPLETED", 1),
            ("O3", None, "2023-01-01", None, "COMPLETED", 1),
        ),
        "fact_support_tickets": spark.createDataFrame(
            [], "ticket_id string, customer_id string, created_date date, resolved_date date"
        ),
        "fact_order_items": star.items(spark, ("O1", "x"), ("O7", "x")),
    }


def test_key_integrity(spark):
    t = tables(spark)
    got = {r["table_name"]: r for r in audit.key_integrity({k: t[k] for k in KEYS}, KEYS, PARENTS).collect()}
    orders = got["fact_orders"]
    assert (orders["total_rows"], orders["distinct_keys"], orders["duplicate_keys"], orders["dup_rate_pct"]) == (4, 3, 1, 25.0)
    assert (orders["orphan_rows"], orders["orphan_rate_pct"]) == (2, 50.0)
    assert got["dim_customers"]["dup_rate_pct"] == 0 and got["dim_customers"]["orphan_rows"] is None


def test_empty_tables(spark):
    t = tables(spark)
    empty = t["fact_orders"].limit(0)
    row = audit.key_counts(empty, "t", ["order_id"]).first()
    assert (row["total_rows"], row["dup_rate_pct"]) == (0, 0.0)
    assert audit.orphan_counts(empty, t["dim_customers"], "t", "customer_id").first()["orphan_rate_pct"] == 0.0
    assert audit.explosion_factor(empty, t["fact_orders"], "j").first()["explosion_factor"] == 4.0
    assert audit.explosion_factor(empty, t["fact_orders"], "j", empty=0.0).first()["explosion_factor"] == 0.0
    assert audit.join_fanout(empty, t["fact_orders"], "customer_id", "j").first()["fanout"] == 0.0


def test_orphans_and_duplicates(spark):
    t = tables(spark)
    lost = audit.orphan_rows(t["fact_orders"], t["dim_customers"], "customer_id")
    assert sorted(r["order_id"] for r in lost.collect()) == ["O2", "O3"]
    assert [tuple(r) for r in audit.duplicate_keys(t["fact_orders"], "fact_orders", ["order_id"]).collect()] == [
        ("fact_orders", "O1", 2)
    ]


def test_fanout_counts_pairs(spark):
    t = tables(spark)
    row = audit.join_fanout(t["dim_customers"], t["fact_orders"], "customer_id", "j").first()
    assert (row["n_left"], row["n_joined"], row["fanout"]) == (2, 2, 1.0)


def test_invariants_skip_absent_dates(spark):
    got = {r["invariant_name"]: tuple(r)[1:] for r in audit.business_invariants(tables(spark)).collect()}
    assert got == {
        "delivery_date >= order_date": (2, 1, 50.0),
        "resolved_date >= created_date (support)": (0, 0, 0.0),
        "total_amount >= 0 (orders)": (4, 1, 25.0),
    }
    rules = {r["rule_name"]: r["violations"] for r in constraint_audit(tables(spark)["fact_orders"], "fact_orders").collect()}
    assert rules == {"delivery_after_order": 1, "total_positive": 1, "discount_non_negative": 0, "status": 0}


def matrix(spark, labels=(0, 1, 0, 1)):
    rows = [
        (f"C{i}", None if i < 2 else 1.0, float(i), None if i == 0 else 2.0, y) for i, y in enumerate(labels)
    ]
    return spark.createDataFrame(
        rows, "customer_id string, avg_delivery_days double, recency_days double, monetary_total double, churn_label int"
    )


def test_missingness(spark):
    got = {r["column_name"]: tuple(r)[1:] for r in audit.missingness(matrix(spark)).collect()}
    assert got["avg_delivery_days"] == (2, 50.0, "MAR", "Imputación por mediana estratificada por order_status", True)
    assert got["monetary_total"] == (1, 25.0, "MCAR (default)", "Imputación por mediana/moda", False)
    assert got["recency_days"][2] == "—" and "churn_label" not in got
    ranked = audit.missing_ranking(audit.missingness(matrix(spark))).collect()
    assert [r["column_name"] for r in ranked] == ["monetary_total", "avg_delivery_days"]


def test_gate(spark):
    t = tables(spark)
    keys = audit.key_integrity({k: t[k] for k in KEYS}, KEYS, PARENTS)
    whole = matrix(spark).withColumn("avg_delivery_days", F.lit(-1.0))
    reasons = audit.stop_go_reasons(keys, audit.missingness(matrix(spark)), whole)
    got = {(r["criterion"], r["subject"], r["amount"]) for r in reasons.collect()}
    assert got == {
        ("duplicates", "fact_orders", 25.0), ("orphans", "fact_orders", 50.0), ("nulls", "avg_delivery_days", 50.0),
        ("negative delivery", "avg_delivery_days", 4.0),
    }
    with pytest.raises(audit.StopGoError, match="fact_orders"):
        audit.gate(reasons)
    assert audit.gate(reasons, on_stop="go_on") == "STOP"
    assert audit.gate(reasons.limit(0)) == "GO"
    few = audit.stop_go_reasons(keys.limit(0), audit.missingness(whole), matrix(spark, (0, 0, 0, 0)))
    assert [r["criterion"] for r in few.filter("criterion = 'churn rate'").collect()] == ["churn rate"]


def test_a_few_rows_of_a_large_table_stop(spark):
    """Four repeats in ten million rows: the rate rounds to nothing, the count does not."""
    large = spark.range(10_000_000).select((F.col("id") - F.when(F.col("id") % 2_500_000 == 1, 1).otherwise(0)).alias("customer_id"))
    keys = audit.key_integrity({"dim_customers": large}, {"dim_customers": ["customer_id"]}, [])
    assert (keys.first()["duplicate_keys"], keys.first()["dup_rate_pct"]) == (4, 0.0)
    t = tables(spark)
    labels = star.labels(spark, ("A", "2023-01-01", 1))
    summary = audit.stop_go_summary(keys, audit.business_invariants(t), audit.feature_coverage(labels, labels)).collect()
    assert {r["check_name"]: r["status"] for r in summary}["Key Integrity"] == "FAIL"
    reasons = audit.stop_go_reasons(keys, audit.missingness(matrix(spark)).limit(0), matrix(spark))
    assert "duplicates" in {r["criterion"] for r in reasons.collect()}


def test_coverage_and_summary(spark):
    labels = star.labels(spark, ("A", "2023-01-01", 1), ("B", "2023-01-01", 0), ("B", "2023-02-01", 0))
    part = audit.feature_coverage(labels, labels.filter("customer_id = 'A'"))
    assert tuple(part.first()) == (2, 1, 1, 50.0, audit.COVERAGE_STOP)
    full = audit.feature_coverage(labels, labels)
    assert full.first()["stop_go_status"] == audit.COVERAGE_GO
    t = tables(spark)
    keys = audit.key_integrity({"dim_customers": t["dim_customers"]}, KEYS, PARENTS)
    summary = {r["check_name"]: r["status"] for r in audit.stop_go_summary(keys, audit.business_invariants(t), full).collect()}
    assert summary == {"Key Integrity": "PASS", "Business Invariants": "FAIL", "Feature Coverage": "PASS"}


def test_histogram_of_constant_and_spread(spark):
    df = spark.createDataFrame([(0, 5.0), (0, 5.0), (1, 0.0), (1, 3.0)], "churn_label int, x double")
    rows = profile.histograms(df, ["x"], bins=3).collect()
    assert len(rows) == 6
    got = {(r["churn_label"], r["bin"]): (r["bin_start"], r["cnt"], r["density"]) for r in rows}
    assert got[0, 1] == pytest.approx((4.5 + 1 / 3, 2, 3.0))
    assert got[1, 0] == pytest.approx((0.0, 1, 0.5)) and got[1, 2] == pytest.approx((2.0, 1, 0.5)) and got[1, 1][1] == 0


def test_profiles(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, i % 2) for i in range(1, 5)], "a double, b double, c double, churn_label int")
    described = {r["feature"]: r for r in profile.describe(df, ["a", "c"]).collect()}
    assert (described["a"]["p25"], described["a"]["p50"], described["a"]["std"]) == (1.75, 2.5, 1.291)
    corr = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in profile.correlations(df, ["a", "b", "c"]).collect()}
    assert corr == {("a", "b"): 1.0, ("a", "c"): None, ("b", "c"): None}
    gappy = df.withColumn("b", F.when(F.col("a") != 2, F.col("a") * F.col("a")))
    pair = gappy.filter("b IS NOT NULL").toPandas()
    row = profile.correlations(gappy, ["a", "b"]).first()
    assert row["correlation"] == pytest.approx(pair["a"].corr(pair["b"]), abs=1e-6)
    shares = {r["churn_label"]: r["class_share"] for r in profile.class_balance(df).collect()}
    assert shares == {0: 0.5, 1: 0.5}


def test_report_names_every_part(spark, folder):
    from keepwell.catalog import base
    from keepwell.operators import features as feats
    from keepwell.session import settle
    from keepwell.sources.retail import CUTOFF, Retail

    raw, whole = base.matrices(spark, folder)
    labels = feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF])
    parts = report.quality_report(base.star(spark, folder), base.STAR_KEYS, PARENTS, raw, settle(whole), labels)
    assert parts["overview"].first()["n_customers"] == whole.count()
    assert parts["stop_go_summary"].count() == 3
    assert parts["feature_coverage"].first()["coverage_pct"] == 100.0


def test_keys_of_a_large_table_are_spread_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(audit, "GROUP_ROWS", 50)
    df = spark.range(1000).select(F.concat(F.lit("K"), F.col("id") % 900).alias("order_id")).unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS order_id FROM range(3)")
    )
    found = audit.duplicate_keys(df, "t", ["order_id"])
    # 1003 rows at 50 a task, with 4 shuffle partitions; before, all tables had those 4.
    assert found.rdd.getNumPartitions() == 21
    assert found.count() == 101 and found.filter("key_value = ''").first()["cnt"] == 3
    row = audit.key_counts(df, "t", ["order_id"]).first()
    assert (row["total_rows"], row["distinct_keys"], row["duplicate_keys"]) == (1003, 900, 103)


def test_keys_and_references_are_counted_in_one_pass(spark, monkeypatch):
    orders = spark.createDataFrame([("O1",), ("O1",), ("O2",)], "order_id string")
    lines = spark.createDataFrame(
        [("O1", 1), ("O1", 1), ("O1", 2), ("O2", None), ("O9", 1), (None, 1), (None, 1)], "order_id string, line_number int"
    )
    found = audit.key_integrity(
        {"fact_orders": orders, "fact_order_items": lines},
        {"fact_orders": ("order_id",), "fact_order_items": ("order_id", "line_number")},
        [("fact_order_items", "order_id", "fact_orders")],
    )
    got = {r["table_name"]: tuple(r)[1:] for r in found.collect()}
    assert got["fact_order_items"] == (7, 3, 4, 57.1429, 3, 42.8571)
    assert got["fact_orders"] == (3, 2, 1, 33.3333, None, None)
    # Before, lines were read for their keys and once more for their orders.
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("line_number") > 0 and text.count("LogicalRDD [order_id") == 3


def test_report_works_its_audits_out_once(spark, folder):
    from keepwell.catalog import base

    raw, whole = base.matrices(spark, folder)
    parts = report.quality_report(base.star(spark, folder), base.STAR_KEYS, PARENTS, raw, whole, whole)
    for name in ("key_integrity", "business_invariants", "missingness", "feature_coverage", "stop_go_summary"):
        assert "parquet" not in parts[name]._jdf.queryExecution().executedPlan().toString(), name
