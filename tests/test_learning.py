import shutil

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepwell.operators import learning
from keepwell.operators.neighbours import nearest_neighbours
from keepwell.operators.smote import smote, synthetic_count
from keepwell.params import NUMERIC_FEATURES, Boosting, Evaluation, Oversampling, Params
from keepwell.plans.training import cross_validate, full_evaluation, headline, split_matrix, train_and_evaluate
from keepwell.session import settle
from keepwell.sources import lineage
from keepwell.sources.retail import CUTOFF, Retail

FAST = Params(cutoff=CUTOFF, prediction_days=365, boosting=Boosting(trees=5, depth=3))


def points(spark, x):
    return spark.createDataFrame(
        [(int(i), [float(v) for v in row]) for i, row in enumerate(x)], "point bigint, vector array<double>"
    )


def brute(x, k):
    out = {}
    for i in range(len(x)):
        square = np.zeros(len(x))
        for axis in range(x.shape[1]):
            square += np.square(x[i, axis] - x[:, axis])
        out[i] = [j for _, j in sorted((square[j], j) for j in range(len(x)) if j != i)[:k]]
    return out


@pytest.mark.parametrize("cell", [5_000, 40])
def test_neighbours_are_exact(spark, cell):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 3)).round(1)
    x[:80] = x[0]  # a third are copies of one point
    got = {}
    for r in nearest_neighbours(points(spark, x), 4, cell).collect():
        got.setdefault(r["point"], {})[r["place"]] = r["neighbour"]
    assert {p: [hits[i] for i in sorted(hits)] for p, hits in got.items()} == brute(x, 4)


def test_fewer_points_than_neighbours(spark):
    got = nearest_neighbours(points(spark, np.array([[0.0], [1.0], [5.0]])), 5).collect()
    assert sorted((r["point"], r["neighbour"]) for r in got) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


def test_smote_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 2))
    made = smote(settle(points(spark, x)), 200, Oversampling(ratio=0.5, neighbours=3)).collect()
    assert len(made) == synthetic_count(30, 200, 0.5) == 70
    near = brute(x, 3)
    for r in made:
        a, b, v = x[r["point"]], x[r["neighbour"]], np.array(r["vector"])
        assert r["neighbour"] in near[r["point"]]
        gap = (v - a) @ (b - a) / ((b - a) @ (b - a))
        assert 0 <= gap < 1 and np.allclose(v, a + gap * (b - a))
    uses = np.bincount([r["point"] for r in made], minlength=30)
    assert set(uses) == {2, 3}
    again = smote(settle(points(spark, x).repartition(3)), 200, Oversampling(ratio=0.5, neighbours=3)).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))


def test_smote_unfolds_many_copies(spark):
    made = smote(settle(points(spark, np.array([[0.0], [1.0]]))), 50_010, Oversampling(ratio=0.5))
    row = made.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("point", "copy").alias("d")).first()
    assert tuple(row) == (25_003, 25_003)


def test_smote_with_enough_minority_adds_nothing(spark):
    assert smote(settle(points(spark, np.zeros((3, 1)))), 4).count() == 0


def matrix(spark, n=40):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        churned = int(i % 4 == 0)
        numbers = rng.normal(size=len(NUMERIC_FEATURES)) + churned * 2
        rows.append((i, *map(float, numbers), "ab"[i % 2], "VIP", churned))
    fields = ", ".join(f"{c} double" for c in NUMERIC_FEATURES)
    return spark.createDataFrame(
        rows, f"customer_id bigint, {fields}, preferred_category string, customer_segment string, churn_label int"
    )


def test_encoding(spark):
    df = matrix(spark)
    encoder = learning.preprocessor().fit(df)
    known = encoder.transform(df).select(vector_to_array("features").alias("v")).collect()
    x = np.array([r["v"] for r in known])
    size = len(NUMERIC_FEATURES)
    assert x.shape[1] == size + 2 + 1
    assert np.allclose(x[:, :size].mean(axis=0), 0) and np.allclose(x[:, :size].std(axis=0, ddof=1), 1)
    assert set(map(tuple, x[:, size:])) == {(1, 0, 1), (0, 1, 1)}
    new = encoder.transform(df.withColumn("preferred_category", F.lit("new")))
    assert set(map(tuple, [r["v"][size:] for r in new.select(vector_to_array("features").alias("v")).collect()])) == {(0, 0, 1)}


def test_class_weight(spark):
    assert learning.class_weight(matrix(spark)) == (30, 10, 3.0)
    assert learning.class_weight(matrix(spark).filter("churn_label = 0"))[2] == 1.0


def test_fit_score_register_and_load(spark, tmp_path):
    df = settle(matrix(spark))
    model = learning.fit(df, FAST)
    assert 0.2 <= model.threshold < 0.6 and model.facts["n_pos"] == 10
    out = learning.score(df, model)
    assert out.count() == 40
    assert out.filter("churn_probability NOT BETWEEN 0 AND 1 OR churn_flag NOT IN (0, 1)").count() == 0
    importance = learning.feature_importance(model.pipeline, df).collect()
    names = {r["feature"] for r in importance}
    assert names <= {*NUMERIC_FEATURES, "preferred_category_a", "preferred_category_b", "customer_segment_VIP"}
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
    lineage.save_model(spark, model, str(tmp_path), {"recall": 0.5})
    again = lineage.load_latest_model(spark, str(tmp_path))
    assert (again.version, again.threshold) == (model.version, model.threshold)
    assert sorted(map(tuple, learning.score(df, again).collect())) == sorted(map(tuple, out.collect()))
    shutil.copytree(tmp_path / "models", tmp_path / "unregistered" / "models")
    assert lineage.load_latest_model(spark, str(tmp_path / "unregistered")).version == model.version
    with pytest.raises(FileNotFoundError):
        lineage.load_latest_model(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="recency_days"):
        learning.score(df.drop("recency_days"), model)


def test_whole_run(spark, folder):
    run = train_and_evaluate(Retail(spark, folder).bundle(), FAST, on_stop="go_on")
    assert set(run.metrics) == {"recall", "precision", "f1", "auc_roc", "auc_pr", "lift_at_20"}
    assert run.gate in ("GO", "STOP")
    assert run.reports["baselines"].count() == 4
    assert run.reports["importance"].count() <= 15


def test_run_without_tickets(spark, folder):
    bundle = Retail(spark, folder).bundle()
    run = train_and_evaluate(bundle.having(tickets=bundle.tickets.limit(0)), FAST, on_stop="go_on")
    assert set(run.metrics) == {"recall", "precision", "f1", "auc_roc", "auc_pr", "lift_at_20"}


def test_repeated_raw_customers_stop_the_run(spark, folder):
    from keepwell.operators.audit import StopGoError

    bundle = Retail(spark, folder).bundle()
    twice = bundle.having(customers=bundle.customers.unionByName(bundle.customers.limit(3)))
    with pytest.raises(StopGoError, match="duplicates: dim_customers"):
        train_and_evaluate(twice, FAST)


def test_fit_reads_a_bounded_number_of_rows(spark):
    df = matrix(spark)
    few = learning.rows_to_fit(df, ("customer_id",), 7, 1)
    again = learning.rows_to_fit(df.repartition(5), ("customer_id",), 7, 1)
    assert few.count() == 7 and sorted(few.collect()) == sorted(again.collect())


def test_cross_validation(spark):
    from datetime import date

    days = [date(2023, m, 1) for m in (1, 2, 3)]
    cohorts = settle(matrix(spark).crossJoin(spark.createDataFrame([(d,) for d in days], "cutoff_date date")))
    got = cross_validate(cohorts, days, FAST.at(evaluation=Evaluation(folds=2))).collect()
    assert [r["fold"] for r in got] == [1, 2]
    assert all(r["auc_roc"] > 0.8 for r in got)


def test_medians_fitted_on_train_only(spark, folder):
    bundle = Retail(spark, folder).bundle()
    both = [split_matrix(bundle, FAST, fit_on=mode) for mode in ("all", "train")]
    assert [t.count() for t, _ in both] == [33, 33]
    gaps = both[1][1].filter("recency_days IS NULL").count()
    assert gaps == 0


def test_evaluation_of_given_scores(spark):
    df = matrix(spark).withColumn("score", F.col("recency_days") / 10 + 0.5)
    numbers = headline(full_evaluation(df, 0.5))
    assert 0 <= numbers["recall"] <= 1 and numbers["lift_at_20"] > 0


def test_folds_by_class(spark):
    from keepwell.operators.splits import fold_parts, stratified_folds

    df = matrix(spark, 43).withColumn("churn_label", F.when(F.col("customer_id") == 7, None).otherwise(F.col("churn_label")))
    folded = settle(stratified_folds(df, 5, seed=3))
    assert folded.count() == 43
    sizes = {}
    for r in folded.groupBy("churn_label", "fold").count().collect():
        sizes.setdefault(r["churn_label"], []).append(r["count"])
    assert set(sizes) == {0, 1, None} and all(max(s) - min(s) <= 1 and (len(s) == 5 or k is None) for k, s in sizes.items())
    again = stratified_folds(df.repartition(6), 5, seed=3)
    assert sorted(map(str, again.select("customer_id", "fold").collect())) == sorted(map(str, folded.select("customer_id", "fold").collect()))
    tests = [t.select("customer_id").collect() for _, t in fold_parts(folded, 5)]
    assert sorted(r[0] for t in tests for r in t) == list(range(43))
    assert all(a.count() + b.count() == 43 for a, b in fold_parts(folded, 5))


def test_cross_validation_by_class(spark):
    got = cross_validate(settle(matrix(spark, 60)), None, FAST.at(evaluation=Evaluation(folds=3))).collect()
    assert [r["fold"] for r in got] == [1, 2, 3] and all(r["n_train"] + r["n_test"] == 60 for r in got)
    assert all(r["n_test_churned"] == 5 for r in got)


def many(spark, rows):
    """As many rows, half of them churned, so that nothing is oversampled."""
    each = [(F.pmod(F.xxhash64("customer_id", F.lit(i)), F.lit(1000)) + F.col("churn_label") * 300).cast("double").alias(c) for i, c in enumerate(NUMERIC_FEATURES)]
    base = spark.range(rows, numPartitions=8).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("churn_label"))
    return settle(base.select("customer_id", *each, F.lit("a").alias("preferred_category"), F.lit("VIP").alias("customer_segment"), "churn_label"))


def test_cross_validation_fits_on_all_rows(spark):
    few = FAST.at(boosting=Boosting(trees=1, depth=2), evaluation=Evaluation(folds=2))
    got = cross_validate(many(spark, 210_000), None, few).collect()
    assert [(r["n_train"], r["n_test"], r["n_test_churned"]) for r in got] == [(105_000, 105_000, 52_500)] * 2


@pytest.fixture
def cut_to_five(monkeypatch):
    """A fit that goes by ``rows_to_fit`` would see five rows."""
    monkeypatch.setattr(learning, "rows_to_fit", lambda train, *_: train.limit(5))


def test_registered_model_is_fitted_on_all_training_rows(spark, folder, cut_to_five, monkeypatch, tmp_path):
    from keepwell.catalog import learning_queries

    monkeypatch.setattr(learning_queries, "_FITTED", {})
    monkeypatch.setattr(learning_queries, "YEAR", FAST)
    monkeypatch.setattr(learning_queries, "scratch", lambda spark, name: str(tmp_path / name))
    learning_queries.model_registry(spark, folder).collect()
    [model] = learning_queries._FITTED.values()
    assert model.facts["n_train"] == learning_queries._parts(spark, folder)[0].count() == 33
    assert lineage.load_latest_model(spark, str(tmp_path / "registry")).version == model.version


def test_streaming_model_is_fitted_on_all_training_rows(spark, folder, cut_to_five, monkeypatch):
    from keepwell.catalog import learning_queries

    monkeypatch.setattr(learning_queries, "_FITTED", {})
    monkeypatch.setattr(learning_queries, "YEAR", FAST)
    logged = learning_queries.model_stream(spark, folder)
    assert logged.filter("agrees AND dated AND acted").count() == logged.count() > 0
    assert [m.facts["n_train"] for m in learning_queries._FITTED.values()] == [33]


def test_run_fits_on_all_training_rows(spark, folder, cut_to_five):
    run = train_and_evaluate(Retail(spark, folder).bundle(), FAST, on_stop="go_on")
    assert run.model.facts["n_train"] == 33
