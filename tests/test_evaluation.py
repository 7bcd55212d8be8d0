import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import baselines, evaluation, splits
from keepwell.operators.ranking import with_position, with_running_totals
from keepwell.params import Evaluation, ThresholdSearch


def scored(spark, truth, scores):
    rows = [(i, int(y), float(s)) for i, (y, s) in enumerate(zip(truth, scores))]
    return spark.createDataFrame(rows, "customer_id bigint, churn_label int, score double")


def brute(truth, scores):
    """AUC over all pairs, and average precision by walking down the distinct scores."""
    truth, scores = np.array(truth), np.array(scores)
    pos, neg = scores[truth == 1], scores[truth == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) if len(pos) and len(neg) else None
    ap, before = 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        hit = truth[scores >= t].sum()
        if truth.sum():
            recall = hit / truth.sum()
            ap += (recall - before) * hit / (scores >= t).sum()
            before = recall
    return auc, ap


@pytest.mark.parametrize("case", ["ties", "all positive", "all negative", "spread"])
def test_ranking_metrics(spark, case):
    rng = np.random.default_rng(5)
    truth, scores = {
        "ties": ([1, 0, 1, 0, 0, 1], [0.5, 0.5, 0.9, 0.9, 0.1, 0.1]),
        "all positive": ([1, 1], [0.2, 0.3]),
        "all negative": ([0, 0], [0.2, 0.3]),
        "spread": ((rng.random(80) < 0.3).astype(int), rng.random(80).round(1)),
    }[case]
    row = evaluation.ranking_metrics(scored(spark, truth, scores)).first()
    auc, ap = brute(truth, scores)
    assert row["auc_roc"] == (None if auc is None else pytest.approx(auc))
    assert row["average_precision"] == pytest.approx(ap)


def test_empty_sets(spark):
    empty = scored(spark, [1], [0.5]).limit(0)
    row = evaluation.ranking_metrics(empty).first()
    assert (row["auc_roc"], row["average_precision"]) == (None, 0.0)
    lift = evaluation.lift_at_k(empty).first()
    assert (lift["recall_at_k"], lift["lift_at_k"], lift["captured"], lift["total"]) == (0.0, 1.0, 0, 0)
    confusion = evaluation.confusion(empty.withColumn("churn_flag", F.lit(1)))
    assert tuple(confusion.first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0)
    assert evaluation.bootstrap_recall(confusion).first()["recall_point"] == 0.0


def test_lift_breaks_ties_by_id(spark):
    df = scored(spark, [0, 1, 1, 0, 1], [0.5, 0.5, 0.5, 0.1, 0.1])
    row = evaluation.lift_at_k(df, 0.4).first()
    assert (row["captured"], row["total"]) == (1, 3)
    assert row["lift_at_k"] == pytest.approx(0.5 / 0.6)
    curve = {r["customer_id"]: r for r in evaluation.lift_curve(df).collect()}
    assert [curve[i]["rank"] for i in range(5)] == [1, 2, 3, 4, 5]
    assert curve[2]["cumulative_recall"] == pytest.approx(2 / 3)
    assert curve[4]["cumulative_lift"] == pytest.approx(1.0)


def naive_grid(truth, scores, search):
    grid = np.arange(search.start, search.end, search.step)
    out = []
    for t in grid:
        said = np.array(scores) >= t
        hit = (said & (np.array(truth) == 1)).sum()
        out.append((round(t, 3), hit / max(sum(truth), 1), hit / said.sum() if said.sum() else 0.0))
    good = [r for r in out if r[1] >= search.min_recall and r[2] >= search.min_precision]
    best = max(good or out, key=lambda r: r[1])
    return out, best[0]


@pytest.mark.parametrize("search", [ThresholdSearch(), ThresholdSearch(min_precision=0.99)])
def test_threshold_grid(spark, search):
    rng = np.random.default_rng(2)
    truth = (rng.random(300) < 0.4).astype(int)
    scores = np.clip(truth * 0.2 + rng.random(300) * 0.8, 0, 1)
    scores[:40] = np.arange(0.2, 0.6, 0.01)  # right on the thresholds
    want, best = naive_grid(truth, scores, search)
    rows = evaluation.threshold_grid(scored(spark, truth, scores), search).orderBy("threshold").collect()
    assert [tuple(r)[:3] for r in rows] == [pytest.approx(w) for w in want]
    assert [r["threshold"] for r in rows if r["chosen"]] == [best]


def test_bootstrap_interval(spark):
    truth = [1] * 50 + [0] * 50
    df = scored(spark, truth, [0] * 100).withColumn("churn_flag", (F.col("customer_id") < 30).cast("int"))
    row = evaluation.bootstrap_recall(evaluation.confusion(df), Evaluation(bootstrap_iterations=500)).first()
    assert row["recall_observed"] == pytest.approx(0.6)
    assert row["recall_point"] == pytest.approx(0.6, abs=0.02)
    rng = np.random.default_rng(0)
    flags = np.array([1] * 30 + [0] * 70)
    draws = []
    for _ in range(2000):
        at = rng.integers(0, 100, 100)
        draws.append(flags[at][np.array(truth)[at] == 1].mean())
    assert [row["recall_ci_low"], row["recall_ci_high"]] == pytest.approx(list(np.percentile(draws, [2.5, 97.5])), abs=0.04)
    assert row["ci_level"] == "95%"


def test_class_report(spark):
    df = scored(spark, [1, 1, 0, 0, 0], [0] * 5).withColumn("churn_flag", F.col("customer_id").isin(0, 2).cast("int"))
    got = {r["class"]: tuple(r)[1:] for r in evaluation.class_report(df).collect()}
    assert got["1"] == pytest.approx((0.5, 0.5, 0.5, 2))
    assert got["0"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert got["accuracy"][0] == pytest.approx(0.6)
    assert got["macro avg"][0] == pytest.approx((0.5 + 2 / 3) / 2)


def test_positions_and_running_totals(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 5, 200)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(values)], "id bigint, v int").repartition(6)
    order = sorted(range(200), key=lambda i: (-values[i], i))
    placed = with_position(df, F.desc("v"), F.asc("id")).collect()
    assert {r["position"]: r["id"] for r in placed} == dict(enumerate(order))
    assert {r["total_rows"] for r in placed} == {200}
    run = {r["id"]: r for r in with_running_totals(df, F.desc("v"), F.asc("id"), sums={"v": "s"}).collect()}
    assert [run[i]["s"] for i in order] == list(np.cumsum(values[order]))
    assert {r["total_s"] for r in run.values()} == {int(values.sum())}


def test_holdout_and_folds(spark):
    df = spark.createDataFrame([(f"C{i:02d}", i % 2) for i in range(11)], "customer_id string, churn_label int")
    got = {r["customer_id"]: r["split"] for r in splits.with_holdout(df).collect()}
    assert sorted(c for c, s in got.items() if s == "test") == ["C08", "C09", "C10"]
    assert {r["split"] for r in splits.with_holdout(df.limit(1)).collect()} == {"test"}
    pairs = spark.createDataFrame([(a, b) for a in (2, 1) for b in (3, 1, 2)], "a int, b int")
    first = splits.with_holdout(pairs, 0.7, ("a", "b")).filter("split = 'train'").drop("split")
    assert sorted(map(tuple, first.collect())) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    from datetime import date

    days = [date(2023, m, 1) for m in (1, 2, 3)]
    cohorts = spark.createDataFrame([(d, y) for d in days for y in (0, 1)], "cutoff_date date, churn_label int")
    assert [(a.count(), b.count()) for a, b in splits.expanding_folds(cohorts, days, 2)] == [(2, 2), (4, 2)]
    assert [tuple(r)[2:] for r in splits.fold_sizes(cohorts, days, 2).collect()] == [(2, 2, 1, 1), (4, 2, 2, 1)]


def matrix(spark):
    rows = [(0, 10.0, 1.0, 100.0, 0), (1, 61.0, 2.0, 50.0, 1), (2, 60.0, 5.0, 0.0, 0), (3, 90.0, 1.0, 100.0, 1)]
    return spark.createDataFrame(
        rows, "customer_id bigint, recency_days double, frequency_orders double, monetary_total double, churn_label int"
    )


def test_baseline_rules(spark):
    df = matrix(spark)
    flags = {r["customer_id"]: r for r in baselines.with_baselines(df).collect()}
    assert [flags[i]["recency_p75"] for i in range(4)] == [0, 0, 0, 1]  # 75 % point 68.25
    assert [flags[i]["recency_60d"] for i in range(4)] == [0, 1, 0, 1]
    assert [flags[i]["frequency_lt_2"] for i in range(4)] == [1, 0, 0, 1]
    scores = {r[0]: r[1] for r in df.select("customer_id", baselines.rfm_score(df)).collect()}
    assert scores[3] == pytest.approx(0.5 + 0.3 + 0.0)
    assert scores[1] == pytest.approx(0.5 * 51 / 80 + 0.3 * 0.75 + 0.2 * 0.5)
    assert [flags[i]["rfm_composite"] for i in range(4)] == [0, 1, 0, 1]


def test_baselines_without_columns(spark):
    df = matrix(spark).drop("recency_days", "monetary_total")
    assert {r[0] for r in df.select(baselines.recency_percentile(df)).collect()} == {0}
    constant = df.withColumn("frequency_orders", F.lit(3.0))
    # A constant column scales to 0, inverted 1, with the whole weight.
    assert {r[0] for r in constant.select(baselines.rfm_score(constant)).collect()} == {1.0}
    nothing = df.drop("frequency_orders")
    assert {r[0] for r in nothing.select(baselines.rfm_composite(nothing)).collect()} == {0}


def test_baseline_metrics(spark):
    got = {r["baseline"]: r for r in baselines.evaluate_baselines(matrix(spark)).collect()}
    fixed = got["recency_60d"]
    assert (fixed["recall"], fixed["precision"], fixed["f1"], fixed["auc_roc"], fixed["positives"]) == (1, 1, 1, 1, 2)
    one_class = baselines.evaluate_baselines(matrix(spark).withColumn("churn_label", F.lit(0)))
    assert {r["auc_roc"] for r in one_class.collect()} == {0.5}
