"""Registered queries: neighbours, oversampling, training and the model registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from keepwell.catalog.base import YEAR, matrix, scratch, sql
from keepwell.operators import decisions, learning, splits
from keepwell.operators.decisions import predictions
from keepwell.operators.neighbours import nearest_neighbours
from keepwell.operators.smote import smote, synthetic_count
from keepwell.params import NUMERIC_FEATURES, Boosting
from keepwell.plans.training import HEADLINE, cross_validate, full_evaluation, headline, train_and_evaluate
from keepwell.session import settle
from keepwell.sources import lineage, store
from keepwell.sources.retail import Retail
from keepwell.streaming import scoring

_FITTED: dict[tuple[str, str], learning.TrainedModel] = {}


def _model(spark, folder):
    """Train and test rows and the model fitted with all defaults; queries of one session share the fit."""
    train, test = _parts(spark, folder)
    name = (spark.sparkContext.applicationId, folder)
    if name not in _FITTED:
        _FITTED[name] = learning.fit(train, YEAR)
    return train, test, _FITTED[name]


def _parts(spark, folder):
    whole = settle(splits.with_holdout(matrix(spark, folder, YEAR)))
    return whole.filter("split = 'train'").drop("split"), whole.filter("split = 'test'").drop("split")


def _encoded(train):
    encoder = learning.preprocessor().fit(train)
    return settle(encoder.transform(train).select("customer_id", "features", "churn_label"))


def class_weight(spark, folder):
    train, _ = _parts(spark, folder)
    negatives, positives, weight = learning.class_weight(train)
    return train.agg(
        F.lit(negatives).cast("bigint").alias("n_neg"),
        F.lit(positives).cast("bigint").alias("n_pos"),
        F.round(F.lit(weight), 6).alias("weight"),
    )


def encoded_features(spark, folder):
    """Squared length and category slots of the encoded training rows."""
    train, _ = _parts(spark, folder)
    points = learning.with_points(_encoded(train), ("customer_id",))
    size = len(NUMERIC_FEATURES)
    squares = F.aggregate(F.slice("vector", 1, size), F.lit(0.0), lambda acc, x: acc + x * x)
    slots = F.aggregate(
        F.slice("vector", size + 1, F.size("vector") - size), F.lit(0.0), lambda acc, x: acc + x
    )
    return points.select(
        F.col("point").alias("customer_id"), F.round(squares, 4).alias("square"), slots.cast("int").alias("slots")
    )


def minority_neighbours(spark, folder):
    train, _ = _parts(spark, folder)
    rare = _encoded(train).filter("churn_label = 1")
    near = nearest_neighbours(learning.with_points(rare, ("customer_id",)), YEAR.oversampling.neighbours)
    return near.select(
        F.col("point").alias("customer_id"), F.col("neighbour").alias("neighbour_id"), "place",
        F.round("distance", 5).alias("distance"),
    )


def smote_balance(spark, folder):
    train, _ = _parts(spark, folder)
    rows = learning.oversampled(_encoded(train), ("customer_id",), YEAR.oversampling)
    return rows.groupBy(F.col("churn_label").cast("int").alias("churn_label")).agg(F.count(F.lit(1)).alias("n_rows"))


def smote_sample(spark, folder):
    """Per minority row: whether its synthetic rows are as many as the ratio asks for and lie towards near neighbours."""
    train, _ = _parts(spark, folder)
    encoded = _encoded(train)
    negatives, positives, _w = learning.class_weight(encoded)
    rare = settle(learning.with_points(encoded.filter("churn_label = 1"), ("customer_id",)).drop("churn_label"))
    made = settle(smote(rare, negatives, YEAR.oversampling))
    near = nearest_neighbours(rare, YEAR.oversampling.neighbours).select("point", "neighbour", F.lit(True).alias("is_near"))
    ends = rare.select(F.col("point").alias("neighbour"), F.col("vector").alias("end"))
    # On the segment: the way to the row and the way to the neighbour add up to the way between them.
    def way(a, b):
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))

    placed = (
        made.join(near, ["point", "neighbour"], "left").join(ends, "neighbour")
        .join(rare.select("point", F.col("vector").alias("start")), "point")
    )
    apart = F.abs(way("vector", "start") + way("vector", "end") - way("start", "end"))
    each = placed.groupBy("point").agg(
        F.count(F.lit(1)).alias("copies"), F.coalesce(F.every("is_near"), F.lit(False)).alias("near"), F.max(apart).alias("apart")
    )
    share = synthetic_count(positives, negatives, YEAR.oversampling.ratio) / positives
    copies = F.coalesce("copies", F.lit(0))
    return rare.select("point").join(each, "point", "left").select(
        F.col("point").alias("customer_id"),
        (F.abs(copies - share) < 1).alias("share_of_copies"),
        F.coalesce("near", F.lit(True)).alias("near"),
        (F.coalesce("apart", F.lit(0.0)) < 1e-6).alias("on_segment"),
    )


def gbt_scores(spark, folder):
    """Test rows scored by the fitted model: whether flag, action and risk follow from the probability."""
    _, test, model = _model(spark, folder)
    p, flag = F.col("churn_probability"), F.col("churn_flag")
    raw = learning.scores(model.pipeline, test).select("customer_id", (F.col("score") >= model.threshold).cast("int").alias("own"))
    action = (
        F.when(p >= 0.75, decisions.CALL).when(p >= 0.5, decisions.PRIORITY).when(flag == 1, decisions.STANDARD)
        .otherwise(decisions.NO_ACTION)
    )
    risk = F.when(p >= 0.75, "CRITICAL").when(p >= 0.5, "HIGH").when(p >= 0.25, "MEDIUM").otherwise("LOW")
    return learning.score(test, model).join(raw, "customer_id").select(
        "customer_id", p.between(0, 1).alias("in_range"), (flag == F.col("own")).alias("flag_agrees"),
        (F.col("recommended_action") == action).alias("action_agrees"), (F.col("risk_level") == risk).alias("risk_agrees"),
    )


def gbt_importance(spark, folder):
    """How many inputs are ranked, whether they are in order, known, and no more than all of the weight."""
    train, _, model = _model(spark, folder)
    ranked = learning.feature_importance(model.pipeline, train).collect()
    weights = [r["importance"] for r in ranked]
    known = [r["feature"].startswith((*NUMERIC_FEATURES, "customer_segment_", "preferred_category_")) for r in ranked]
    row = (len(ranked), weights == sorted(weights, reverse=True), all(known), 0 < sum(weights) <= 1 + 1e-9)
    return spark.createDataFrame([row], "n_features bigint, in_order boolean, known boolean, within_one boolean")


def model_registry(spark, folder):
    """Fit, register, load the latest again and score the test rows with it."""
    _, test, model = _model(spark, folder)
    scored = settle(learning.scores(model.pipeline, test))
    metrics = headline(full_evaluation(scored, model.threshold, YEAR))
    home = scratch(spark, "registry")
    lineage.save_model(spark, model, home, metrics)
    again = lineage.load_latest_model(spark, home)
    both = scored.select("customer_id", F.col("score").alias("saved")).join(
        learning.scores(again.pipeline, test).select("customer_id", F.col("score").alias("loaded")), "customer_id"
    )
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("saved") - F.col("loaded"))).alias("largest_difference")
    )


def evaluation_report(spark, folder):
    """The evaluation of the fitted model in long form: what the test rows alone decide."""
    _, test, model = _model(spark, folder)
    reports = full_evaluation(learning.scores(model.pipeline, test), model.threshold, YEAR, model.pipeline)
    confusion, lift = reports["confusion"], reports["lift"]
    rows = [
        confusion.select(F.lit("rows").alias("figure"), (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("amount")),
        confusion.select(F.lit("churned"), F.col("tp") + F.col("fn")),
        lift.select(F.lit("churned, by the lift"), F.col("total").cast("bigint")),
        reports["baselines"].agg(F.count(F.lit(1))).select(F.lit("baselines"), F.col("count(1)")),
        reports["lift_curve"].agg(F.count(F.lit(1))).select(F.lit("points of the lift curve"), F.col("count(1)")),
    ]
    return reduce(DataFrame.union, rows)


def train_run(spark, folder):
    """The whole run on the raw tables: gate, rows and classes of both parts, and whether all metrics are shares."""
    run = train_and_evaluate(Retail(spark, folder).bundle(), YEAR, on_stop="go_on")
    facts, tested = run.model.facts, run.reports["confusion"].first()
    shares = all(0 <= run.metrics[m] <= 1 for m in HEADLINE if m != "lift_at_20" and run.metrics[m] is not None)
    row = (
        run.gate, int(facts["n_train"]), int(facts["n_pos"]), int(facts["n_neg"]),
        tested["tp"] + tested["fp"] + tested["fn"] + tested["tn"], tested["tp"] + tested["fn"], shares,
    )
    return spark.createDataFrame(
        [row], "gate string, n_train bigint, n_pos bigint, n_neg bigint, n_test bigint, n_churned bigint, shares boolean"
    )


def stratified_folds(spark, folder):
    """Rows of each fold by class."""
    folded = splits.stratified_folds(settle(matrix(spark, folder, YEAR)), YEAR.evaluation.folds, seed=YEAR.seed)
    return folded.groupBy("fold", "churn_label").agg(F.count(F.lit(1)).alias("n_rows"))


def cross_validation(spark, folder):
    """Five folds by class with small models: sizes of the parts, and whether the metrics are shares."""
    small = YEAR.at(boosting=Boosting(trees=10, depth=3))
    found = cross_validate(settle(matrix(spark, folder, YEAR)), None, small)
    shares = [F.coalesce(F.col(m).between(0, 1), F.lit(True)) for m in HEADLINE if m != "lift_at_20"]
    return found.select("fold", "n_train", "n_test", "n_test_churned", reduce(lambda a, b: a & b, shares).alias("shares"))


def model_stream(spark, folder):
    """Test rows as a stream through the fitted pipeline, each sent twice: the log agrees with scoring the table."""
    _, test, model = _model(spark, folder)
    sent = settle(test.withColumn("requested_at", F.col("cutoff_date").cast("timestamp")))
    inbox, outbox = scratch(spark, "inbox"), scratch(spark, "outbox")
    sent.write.parquet(inbox)
    sent.write.mode("append").parquet(inbox)
    arriving = scoring.read_requests(spark, inbox, sent.schema, files_per_batch=8)
    scored = predictions(scoring.model_scorer(model)(arriving), model.threshold, model.version, "score", ("customer_id", "requested_at"))
    logged = store.prediction_log(scoring.once_per_key(scored, ("customer_id",), "requested_at"))
    scoring.log_predictions(logged, outbox, scratch(spark, "progress"), available_now=True).awaitTermination()
    table = learning.score(test, model).select("customer_id", F.col("churn_probability").alias("alone"))
    return spark.read.parquet(outbox).join(table, "customer_id").select(
        "customer_id", (F.col("churn_probability") == F.col("alone")).alias("agrees"),
        F.col("prediction_date").isNotNull().alias("dated"), F.col("action_triggered").isNotNull().alias("acted"),
    )


QUERIES = {
    "class_weight": class_weight,
    "encoded_features": encoded_features,
    "minority_neighbours": minority_neighbours,
    "smote_balance": smote_balance,
    "smote_sample": smote_sample,
    "gbt_scores": gbt_scores,
    "gbt_importance": gbt_importance,
    "model_registry": model_registry,
    "evaluation_report": evaluation_report,
    "train_and_evaluate": train_run,
    "model_stream": model_stream,
    "stratified_folds": stratified_folds,
    "cross_validation": cross_validation,
}

_SCALED = ", ".join(
    f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0.0) AS {c}" for c in NUMERIC_FEATURES
)
_SQUARES = " + ".join(f"power(a.{c} - b.{c}, 2)" for c in NUMERIC_FEATURES)
_MORE = {
    "train": """
        SELECT * FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS rn, count(*) OVER () AS n FROM matrix)
        WHERE rn <= floor(n * 0.8)""",
    "test": """
        SELECT * FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS rn, count(*) OVER () AS n FROM matrix)
        WHERE rn > floor(n * 0.8)""",
    "scaled": f"SELECT customer_id, preferred_category, customer_segment, churn_label, {_SCALED} FROM train",
    "rare": "SELECT * FROM scaled WHERE churn_label = 1",
}

ORACLE = {
    "class_weight": sql("""
        SELECT count(*) FILTER (WHERE churn_label = 0) AS n_neg, count(*) FILTER (WHERE churn_label = 1) AS n_pos,
               round(count(*) FILTER (WHERE churn_label = 0) / CAST(count(*) FILTER (WHERE churn_label = 1) AS DOUBLE), 6)
                   AS weight FROM train""", YEAR, more=_MORE),
    "encoded_features": sql(f"""
        SELECT customer_id, round({' + '.join(f'{c} * {c}' for c in NUMERIC_FEATURES)}, 4) AS square,
               CAST(2 AS INTEGER) AS slots FROM scaled""", YEAR, more=_MORE),
    "minority_neighbours": sql(f"""
        SELECT customer_id, neighbour_id, CAST(place AS INTEGER) AS place, round(sqrt(square), 5) AS distance
        FROM (SELECT a.customer_id, b.customer_id AS neighbour_id, square,
                     row_number() OVER (PARTITION BY a.customer_id ORDER BY square, b.customer_id) AS place
              FROM rare a JOIN rare b ON a.customer_id <> b.customer_id,
                   LATERAL (SELECT {_SQUARES}
                            + 2 * CAST(a.preferred_category <> b.preferred_category AS INTEGER)
                            + 2 * CAST(a.customer_segment <> b.customer_segment AS INTEGER) AS square))
        WHERE place <= 5""", YEAR, more=_MORE),
    "smote_balance": sql("""
        SELECT churn_label, CASE WHEN churn_label = 0 THEN count(*)
               ELSE greatest(count(*), CAST(floor((SELECT count(*) FROM train WHERE churn_label = 0) * 0.5) AS BIGINT))
               END AS n_rows
        FROM train GROUP BY 1""", YEAR, more=_MORE),
    "smote_sample": sql("SELECT customer_id, true AS share_of_copies, true AS near, true AS on_segment FROM rare", YEAR, more=_MORE),
    "gbt_scores": sql("""
        SELECT customer_id, true AS in_range, true AS flag_agrees, true AS action_agrees, true AS risk_agrees FROM test""",
        YEAR, more=_MORE),
    "gbt_importance": sql(f"""
        SELECT least(15, {len(NUMERIC_FEATURES)} + count(DISTINCT preferred_category) + count(DISTINCT customer_segment))
                   AS n_features, true AS in_order, true AS known, true AS within_one FROM train""", YEAR, more=_MORE),
    "model_registry": sql("SELECT count(*) AS n_rows, 0.0::DOUBLE AS largest_difference FROM test", YEAR, more=_MORE),
    "train_and_evaluate": sql("""
        SELECT CASE WHEN (SELECT count(*) FROM reasons) > 0 THEN 'STOP' ELSE 'GO' END AS gate,
               (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM train WHERE churn_label = 1) AS n_pos,
               (SELECT count(*) FROM train WHERE churn_label = 0) AS n_neg, (SELECT count(*) FROM test) AS n_test,
               (SELECT count(*) FROM test WHERE churn_label = 1) AS n_churned, true AS shares""", YEAR, more={
        **_MORE,
        # One reason is enough: deliveries before the order, a sparse column, or customers of events without a record.
        "reasons": """
            SELECT customer_id FROM raw_matrix WHERE avg_delivery_days < 0
            UNION ALL SELECT count(*) FROM raw_matrix
                      HAVING count(*) FILTER (WHERE avg_satisfaction_score IS NULL) > 0.4 * count(*)
            UNION ALL SELECT t.customer_id FROM fact_support_tickets t
                      WHERE t.customer_id NOT IN (SELECT customer_id FROM dim_customers)"""}),
    "evaluation_report": sql("""
        SELECT 'rows' AS figure, count(*) AS amount FROM test
        UNION ALL SELECT 'churned', count(*) FILTER (WHERE churn_label = 1) FROM test
        UNION ALL SELECT 'churned, by the lift', count(*) FILTER (WHERE churn_label = 1) FROM test
        UNION ALL SELECT 'baselines', 4
        UNION ALL SELECT 'points of the lift curve', count(*) FROM test""", YEAR, more=_MORE),
    "stratified_folds": sql("""
        SELECT CAST(fold AS INTEGER) AS fold, churn_label, (n + 5 - fold) // 5 AS n_rows
        FROM (SELECT churn_label, count(*) AS n FROM matrix GROUP BY 1), range(1, 6) AS folds(fold)""", YEAR),
    "cross_validation": sql("""
        SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n) - sum((n + 5 - fold) // 5) AS BIGINT) AS n_train,
               CAST(sum((n + 5 - fold) // 5) AS BIGINT) AS n_test,
               CAST(sum((n + 5 - fold) // 5) FILTER (WHERE churn_label = 1) AS BIGINT) AS n_test_churned, true AS shares
        FROM (SELECT churn_label, count(*) AS n FROM matrix GROUP BY 1), range(1, 6) AS folds(fold) GROUP BY fold""", YEAR),
    "model_stream": sql("SELECT customer_id, true AS agrees, true AS dated, true AS acted FROM test", YEAR, more=_MORE),
}
