"""Registered queries: splits, baselines, metrics and decisions, over the composite rule score."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepwell.catalog.base import (
    COHORTS, CUTOFF, EARLIER, SEGMENTS, YEAR, matrix, raw_matrix, rounded, scored, scratch, sql,
)
from keepwell.operators import baselines, decisions, evaluation, features as feats, splits
from keepwell.operators.constraints import validate_requests
from keepwell.params import MATRIX_NUMERIC
from keepwell.session import settle
from keepwell.sources import store
from keepwell.sources.retail import Retail
from keepwell.streaming import scoring

FOLD_CUTOFFS = tuple(
    CUTOFF.replace(year=y, month=m, day=d)
    for y, m, d in ((1996, 3, 31), (1996, 6, 30), (1996, 9, 30), (1996, 12, 31), (1997, 3, 31), (1997, 6, 30))
)
FLAG_AT = 0.5


def flagged(spark, folder):
    return scored(spark, folder).withColumn("churn_flag", (F.col("score") >= FLAG_AT).cast("int"))


# -- splits -------------------------------------------------------------------------------------------


def holdout_split(spark, folder):
    return splits.with_holdout(matrix(spark, folder, YEAR)).select("customer_id", "churn_label", "split")


def cutoff_split(spark, folder):
    labels = feats.churn_labels(Retail(spark, folder).orders_head, COHORTS)
    return splits.with_cutoff_split(labels, CUTOFF).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("churn_label"), 6).alias("churn_rate")
    )


def time_folds(spark, folder):
    labels = feats.churn_labels(Retail(spark, folder).orders_head, FOLD_CUTOFFS, 90, 90)
    return splits.fold_sizes(labels, FOLD_CUTOFFS, YEAR.evaluation.folds)


# -- baselines ----------------------------------------------------------------------------------------


def _baseline(name):
    def query(spark, folder):
        whole = matrix(spark, folder, YEAR)
        return whole.select("customer_id", baselines.BASELINES[name](whole).alias("prediction"))

    return query


def rfm_scores(spark, folder):
    return scored(spark, folder).select("customer_id", F.round("score", 6).alias("score"))


def baseline_metrics(spark, folder):
    return rounded(baselines.evaluate_baselines(matrix(spark, folder, YEAR)))


# -- metrics ------------------------------------------------------------------------------------------


def confusion_metrics(spark, folder):
    return rounded(evaluation.confusion(flagged(spark, folder)))


def roc_points(spark, folder):
    return rounded(evaluation.roc_points(scored(spark, folder)), 9)


def pr_points(spark, folder):
    return rounded(evaluation.pr_points(scored(spark, folder)), 9)


def roc_auc(spark, folder):
    return rounded(evaluation.ranking_metrics(scored(spark, folder)).select("auc_roc"))


def average_precision(spark, folder):
    return rounded(evaluation.ranking_metrics(scored(spark, folder)).select("average_precision"))


def lift_at_k(spark, folder):
    return rounded(evaluation.lift_at_k(scored(spark, folder), 0.20))


def lift_curve(spark, folder):
    return rounded(evaluation.lift_curve(scored(spark, folder)))


def threshold_grid(spark, folder):
    return rounded(evaluation.threshold_grid(scored(spark, folder)))


def class_report(spark, folder):
    return rounded(evaluation.class_report(flagged(spark, folder)))


def bootstrap_recall_ci(spark, folder):
    """The observed recall, and whether the interval lies around it; the drawn numbers are the generator's own."""
    drawn = evaluation.bootstrap_recall(evaluation.confusion(flagged(spark, folder)), YEAR.evaluation, YEAR.seed)
    point, low, high, seen = (F.round(c, 9) for c in ("recall_point", "recall_ci_low", "recall_ci_high", "recall_observed"))
    return drawn.select(
        F.round("recall_observed", 6).alias("recall_observed"), "ci_level",
        ((low <= seen) & (seen <= high)).alias("ordered"),
        (F.abs(point - seen) < 0.1).alias("near"),
    )


# -- decisions ----------------------------------------------------------------------------------------


def _predicted(spark, folder):
    return decisions.predictions(scored(spark, folder), FLAG_AT, "rule", "score")


def action_tiers(spark, folder):
    return _predicted(spark, folder).select(
        "customer_id", "churn_probability", "churn_flag", "recommended_action"
    )


def risk_levels(spark, folder):
    return _predicted(spark, folder).groupBy("risk_level").agg(F.count(F.lit(1)).alias("cnt"))


def request_validation(spark, folder):
    """Raw feature rows as requests, some with gaps or negative delivery times."""
    checked = validate_requests(raw_matrix(spark, folder), SEGMENTS)
    return checked.select("customer_id", F.concat_ws(",", "errors").alias("errors"))


def serving_defaults(spark, folder):
    requests = raw_matrix(spark, folder).drop("spending_intensity")
    return rounded(decisions.with_serving_defaults(requests).select(
        "customer_id", "avg_satisfaction_score", "avg_delivery_days", "spending_intensity"
    ))


def _rule_scorer(df):
    """A fixed rule in place of a model: recency weighs up, frequency down; 0..1."""
    return df.withColumn(
        "score", F.round(F.least(F.col("recency_days") / 90.0, F.lit(1.0)) / F.greatest("frequency_orders", F.lit(1.0)), 9)
    )


def _requests(spark, folder):
    """Raw feature rows with scores within range and deliveries never before the order."""
    raw = raw_matrix(spark, folder)
    return raw.withColumns({
        "avg_satisfaction_score": F.when(F.col("avg_satisfaction_score").between(1, 5), F.col("avg_satisfaction_score")),
        "avg_delivery_days": F.when(F.col("avg_delivery_days") >= 0, F.col("avg_delivery_days")),
    }).drop("spending_intensity", "churn_label")


def batch_scoring(spark, folder):
    return scoring.score_requests(_requests(spark, folder), _rule_scorer, FLAG_AT, "rule", segments=SEGMENTS)


def batch_summary(spark, folder):
    """The summary of the scored requests, with how many came and how many were refused."""
    requests = settle(_requests(spark, folder))
    counts = settle(scoring.counted(requests, SEGMENTS))
    answers = scoring.score_requests(requests, _rule_scorer, FLAG_AT, "rule", segments=SEGMENTS)
    numbers = {c: counts.select(c).scalar() for c in ("total", "scored", "rejected")}
    return decisions.batch_summary(answers).withColumns(numbers)


def rejected_requests(spark, folder):
    bad = scoring.rejected(_requests(spark, folder), SEGMENTS)
    return bad.select("customer_id", F.concat_ws(",", "errors").alias("errors"))


def prediction_log(spark, folder):
    path = scratch(spark, "log")
    store.append_predictions(store.prediction_log(_predicted(spark, folder)), path)
    return spark.read.parquet(path).drop("prediction_date", "prediction_day")


def stream_scores(spark, folder):
    """Requests sent twice through the stream; each customer is logged once."""
    requests = _requests(spark, folder).withColumn("requested_at", F.col("cutoff_date").cast("timestamp"))
    inbox, outbox = scratch(spark, "inbox"), scratch(spark, "outbox")
    sent = settle(requests)
    sent.write.parquet(inbox)
    sent.write.mode("append").parquet(inbox)
    arriving = scoring.read_requests(spark, inbox, sent.schema, files_per_batch=8)
    key = ("customer_id", "requested_at")
    results = scoring.score_requests(arriving, _rule_scorer, FLAG_AT, "rule", key, SEGMENTS)
    logged = store.prediction_log(scoring.once_per_key(results, ("customer_id",), "requested_at"))
    query = scoring.log_predictions(logged, outbox, scratch(spark, "progress"), available_now=True)
    query.awaitTermination()
    return spark.read.parquet(outbox).drop("stream", "batch", "prediction_date")


def campaign_roi(spark, folder):
    return rounded(decisions.campaign_roi(evaluation.confusion(flagged(spark, folder))))


RETAINED = {"none": 0.0, "coupon": 0.10, "advisor": 0.25, "free_shipping": 0.06}


def best_action(spark, folder):
    return rounded(
        decisions.best_action(_predicted(spark, folder), RETAINED).select(
            "customer_id", "best_action", "expected_utility"
        )
    )


def guardrails(spark, folder):
    rows = settle(flagged(spark, folder))
    confusions = evaluation.confusion(rows).select("precision")
    ranking = evaluation.ranking_metrics(rows)
    lift = evaluation.lift_at_k(rows, 0.20)
    metrics = confusions.select(
        "precision",
        ranking.select("auc_roc").scalar().alias("auc_roc"),
        ranking.select("average_precision").scalar().alias("auc_pr"),
        lift.select("lift_at_k").scalar().alias("lift_at_20"),
    )
    return rounded(decisions.guardrails(metrics))


def imputed_guardrail(spark, folder):
    return rounded(decisions.imputed_shares(raw_matrix(spark, folder), MATRIX_NUMERIC))


def drift_psi(spark, folder):
    tables = Retail(spark, folder)
    columns = ("recency_days", "frequency_orders")
    both = settle(feats.order_rollup(tables.orders_head, [EARLIER, CUTOFF], 90, parts=columns))
    before = both.filter(F.col("cutoff_date") == F.lit(EARLIER))
    after = both.filter(F.col("cutoff_date") == F.lit(CUTOFF))
    return rounded(decisions.stability_index(before, after, columns))


def pseudonymised_ids(spark, folder):
    return decisions.pseudonymised(Retail(spark, folder).orders_head.select("customer_id", "order_date"))


QUERIES = {
    "holdout_split": holdout_split,
    "cutoff_split": cutoff_split,
    "time_folds": time_folds,
    "baseline_recency_p75": _baseline("recency_p75"),
    "baseline_recency_fixed": _baseline("recency_60d"),
    "baseline_low_frequency": _baseline("frequency_lt_2"),
    "baseline_rfm_composite": _baseline("rfm_composite"),
    "rfm_scores": rfm_scores,
    "baseline_metrics": baseline_metrics,
    "confusion_metrics": confusion_metrics,
    "roc_points": roc_points,
    "pr_points": pr_points,
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "lift_at_k": lift_at_k,
    "lift_curve": lift_curve,
    "threshold_grid": threshold_grid,
    "class_report": class_report,
    "bootstrap_recall_ci": bootstrap_recall_ci,
    "action_tiers": action_tiers,
    "risk_levels": risk_levels,
    "request_validation": request_validation,
    "serving_defaults": serving_defaults,
    "batch_scoring": batch_scoring,
    "batch_summary": batch_summary,
    "rejected_requests": rejected_requests,
    "prediction_log": prediction_log,
    "stream_scores": stream_scores,
    "campaign_roi": campaign_roi,
    "best_action": best_action,
    "guardrails": guardrails,
    "imputed_guardrail": imputed_guardrail,
    "drift_psi": drift_psi,
    "pseudonymised_ids": pseudonymised_ids,
}


# -- SQL ----------------------------------------------------------------------------------------------

_FLAGS = {
    "recency_p75": "CAST(recency_days >= (SELECT quantile_cont(recency_days, 0.75) FROM matrix) AS INTEGER)",
    "recency_60d": "CAST(recency_days > 60 AS INTEGER)",
    "frequency_lt_2": "CAST(frequency_orders < 2 AS INTEGER)",
    "rfm_composite": "CAST(score >= 0.60 AS INTEGER)",
}


def _metric(name: str) -> str:
    return f"""
        SELECT '{name}' AS baseline, round(hit / p, 6) AS recall, round(coalesce(hit / nullif(f, 0), 0.0), 6) AS precision,
               round(coalesce(2 * hit / nullif(f + p, 0), 0.0), 6) AS f1,
               round((hit / p + 1.0 - (f - hit) / (n - p)) / 2.0, 6) AS auc_roc,
               CAST(f AS BIGINT) AS positives, round(f / n, 6) AS positive_rate
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(churn_label) AS DOUBLE) AS p,
                     CAST(sum(flag) AS DOUBLE) AS f, CAST(sum(flag * churn_label) AS DOUBLE) AS hit
              FROM (SELECT churn_label, {_FLAGS[name]} AS flag FROM scored))"""


_MORE = {
    "steps": """
        SELECT score, sum(count(*)) OVER w AS flagged, sum(sum(churn_label)) OVER w AS hits,
               count(*) AS n_rows, sum(churn_label) AS pos,
               (SELECT count(*) FROM scored) AS n, (SELECT sum(churn_label) FROM scored) AS p
        FROM scored GROUP BY score WINDOW w AS (ORDER BY score DESC)""",
    "flagged": f"SELECT *, CAST(score >= {FLAG_AT} AS INTEGER) AS churn_flag FROM scored",
    "confusion": """
        SELECT count(*) FILTER (WHERE churn_label = 1 AND churn_flag = 1) AS tp,
               count(*) FILTER (WHERE churn_label = 0 AND churn_flag = 1) AS fp,
               count(*) FILTER (WHERE churn_label = 1 AND churn_flag = 0) AS fn,
               count(*) FILTER (WHERE churn_label = 0 AND churn_flag = 0) AS tn FROM flagged""",
    "placed": """
        SELECT *, row_number() OVER (ORDER BY score DESC, customer_id) AS rn, count(*) OVER () AS n,
               sum(churn_label) OVER () AS p,
               sum(churn_label) OVER (ORDER BY score DESC, customer_id ROWS UNBOUNDED PRECEDING) AS found
        FROM scored""",
    "thresholds": "SELECT i, 0.2::DOUBLE + i::DOUBLE * ((0.2::DOUBLE + 0.01::DOUBLE) - 0.2::DOUBLE) AS t FROM range(40) AS r(i)",
    "rated": """
        SELECT round(t, 3) AS threshold,
               count(*) FILTER (WHERE score >= t AND churn_label = 1)
                   / nullif(CAST(sum(churn_label) AS DOUBLE), 0) AS recall,
               coalesce(count(*) FILTER (WHERE score >= t AND churn_label = 1)
                        / nullif(CAST(count(*) FILTER (WHERE score >= t) AS DOUBLE), 0), 0.0) AS precision
        FROM scored, thresholds GROUP BY t""",
    "predicted": f"""
        SELECT customer_id, round_even(score, 4) AS churn_probability, CAST(score >= {FLAG_AT} AS INTEGER) AS churn_flag
        FROM scored""",
    "lift": """
        SELECT 0.2 AS k_percent, count(*) FILTER (WHERE rn <= floor(n * 0.2) AND churn_label = 1) AS captured,
               sum(churn_label) AS total, max(n) AS n, CAST(floor(max(n) * 0.2) AS BIGINT) AS n_k FROM placed""",
    "requests": """
        SELECT customer_id, cutoff_date, recency_days, frequency_orders, monetary_total, monetary_avg_order,
               category_diversity, coalesce(support_tickets_90d, 0) AS support_tickets_90d,
               coalesce(return_rate, 0) AS return_rate, days_since_registration,
               CASE WHEN avg_satisfaction_score BETWEEN 1 AND 5 THEN avg_satisfaction_score END AS avg_satisfaction_score,
               CASE WHEN avg_delivery_days >= 0 THEN avg_delivery_days END AS avg_delivery_days
        FROM raw_matrix""",
    "answers": f"""
        SELECT customer_id, score, round_even(score, 4) AS churn_probability,
               CAST(score >= {FLAG_AT} AS INTEGER) AS churn_flag
        FROM (SELECT customer_id, round(least(recency_days / 90.0, 1.0) / greatest(frequency_orders, 1.0), 9) AS score
              FROM requests
              WHERE recency_days IS NOT NULL AND frequency_orders IS NOT NULL AND monetary_total IS NOT NULL
                    AND category_diversity IS NOT NULL AND days_since_registration >= 0
                    AND coalesce(avg_delivery_days, 0) <= 365)""",
    "sides": f"""
        SELECT customer_id, cutoff_date, CAST(recency_days AS DOUBLE) AS recency_days,
               CAST(frequency_orders AS DOUBLE) AS frequency_orders
        FROM churn_labels LEFT JOIN order_features USING (customer_id, cutoff_date)""",
}

_ACTION = f"""CASE WHEN churn_probability >= 0.75 THEN '{decisions.CALL}'
                   WHEN churn_probability >= 0.5 THEN '{decisions.PRIORITY}'
                   WHEN churn_flag = 1 THEN '{decisions.STANDARD}' ELSE '{decisions.NO_ACTION}' END"""
_RISK = """CASE WHEN churn_probability >= 0.75 THEN 'CRITICAL' WHEN churn_probability >= 0.5 THEN 'HIGH'
                WHEN churn_probability >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END"""
_ANSWER = f"""
    SELECT customer_id, churn_probability, churn_flag, 'rule' AS model_version, 0.5::DOUBLE AS decision_threshold,
           {_ACTION} AS recommended_action, {_RISK} AS risk_level FROM answers"""


def _errors(source: str = "raw_matrix", *absent: str) -> str:
    ranges = {
        "avg_delivery_days": "avg_delivery_days < 0 OR avg_delivery_days > 365",
        "avg_satisfaction_score": "avg_satisfaction_score < 1 OR avg_satisfaction_score > 5",
        "category_diversity": "category_diversity IS NULL OR category_diversity < 0 OR category_diversity > 50",
        "customer_id": "customer_id IS NULL",
        "customer_segment": "customer_segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
        "days_since_registration": "days_since_registration IS NULL OR days_since_registration < 0",
        "frequency_orders": "frequency_orders IS NULL OR frequency_orders < 0 OR frequency_orders > 10000",
        "monetary_avg_order": "monetary_avg_order IS NULL OR monetary_avg_order < 0",
        "monetary_total": "monetary_total IS NULL OR monetary_total < 0",
        "recency_days": "recency_days IS NULL OR recency_days < 0 OR recency_days > 3650",
        "return_rate": "return_rate < 0 OR return_rate > 1",
        "support_tickets_90d": "support_tickets_90d < 0",
    }
    marks = ", ".join(f"CASE WHEN {wrong} THEN '{name}' END" for name, wrong in ranges.items() if name not in absent)
    return f"SELECT customer_id, concat_ws(',', {marks}) AS errors FROM {source}"


def _drift(column: str) -> str:
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""
        SELECT '{column}' AS feature, round(sum((c - b) * ln(c / b)), 6) AS psi, sum((c - b) * ln(c / b)) > 0.25 AS retrain
        FROM (SELECT bucket, greatest(sum(is_b) / sum(sum(is_b)) OVER (), 0.0001) AS b,
                     greatest(sum(is_c) / sum(sum(is_c)) OVER (), 0.0001) AS c
              FROM (SELECT len(list_filter(list_distinct((SELECT quantile_cont({column}, [{edges}]) FROM sides
                                                          WHERE cutoff_date = DATE '{EARLIER}')),
                                           lambda e: {column} > e)) AS bucket,
                           CAST(cutoff_date = DATE '{EARLIER}' AS DOUBLE) AS is_b,
                           CAST(cutoff_date = DATE '{CUTOFF}' AS DOUBLE) AS is_c
                    FROM sides WHERE {column} IS NOT NULL)
              GROUP BY bucket)"""


def _class(value: str, truth: int) -> str:
    tp, fp, fn = ("tp", "fp", "fn") if truth else ("tn", "fn", "fp")
    return f"""
        SELECT '{value}' AS class, coalesce({tp} / nullif(CAST({tp} + {fp} AS DOUBLE), 0), 0) AS precision,
               coalesce({tp} / nullif(CAST({tp} + {fn} AS DOUBLE), 0), 0) AS recall,
               coalesce(2 * {tp} / nullif(CAST(2 * {tp} + {fp} + {fn} AS DOUBLE), 0), 0) AS f1,
               {tp} + {fn} AS support FROM confusion"""


_MORE["classes"] = _class("0", 0) + " UNION ALL " + _class("1", 1)


def _utility(action: str) -> str:
    kept, cost = RETAINED[action], decisions.ACTION_COSTS[action]
    return f"120.0 * ((1 - churn_probability) + churn_probability * {kept}) - {cost}"


_OPTIONS = " UNION ALL ".join(
    f"SELECT customer_id, '{a}' AS action, {_utility(a)} AS utility, {decisions.ACTION_COSTS[a]} AS cost FROM predicted"
    for a in decisions.ACTION_COSTS
)

ORACLE = {
    "holdout_split": sql("""
        SELECT customer_id, churn_label, CASE WHEN row_number() OVER (ORDER BY customer_id) <= floor(n * 0.8)
               THEN 'train' ELSE 'test' END AS split
        FROM churn_labels, (SELECT count(*) AS n FROM churn_labels)""", YEAR),
    "cutoff_split": sql(f"""
        SELECT CASE WHEN cutoff_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
               round(avg(churn_label), 6) AS churn_rate FROM churn_labels GROUP BY 1""", cutoffs=COHORTS),
    "time_folds": sql("""
        SELECT CAST(row_number() OVER (ORDER BY t.cutoff_date) AS INTEGER) AS fold, t.cutoff_date AS test_cutoff,
               count(*) FILTER (WHERE l.cutoff_date < t.cutoff_date) AS train_rows,
               count(*) FILTER (WHERE l.cutoff_date = t.cutoff_date) AS test_rows,
               count(*) FILTER (WHERE l.cutoff_date < t.cutoff_date AND churn_label = 1) AS train_positives,
               count(*) FILTER (WHERE l.cutoff_date = t.cutoff_date AND churn_label = 1) AS test_positives
        FROM cutoffs t, churn_labels l WHERE t.cutoff_date > DATE '1996-03-31' GROUP BY t.cutoff_date""",
        YEAR.at(prediction_days=90), FOLD_CUTOFFS),
    **{
        query: sql(f"SELECT customer_id, {_FLAGS[name]} AS prediction FROM scored", YEAR)
        for query, name in (
            ("baseline_recency_p75", "recency_p75"), ("baseline_recency_fixed", "recency_60d"),
            ("baseline_low_frequency", "frequency_lt_2"), ("baseline_rfm_composite", "rfm_composite"),
        )
    },
    "rfm_scores": sql("SELECT customer_id, round(score, 6) AS score FROM scored", YEAR),
    "baseline_metrics": sql(" UNION ALL ".join(_metric(name) for name in _FLAGS), YEAR),
    "confusion_metrics": sql("""
        SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
               round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision,
               round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1
        FROM confusion""", YEAR, more=_MORE),
    "roc_points": sql("""
        SELECT score AS threshold, round(CAST(flagged - hits AS DOUBLE) / (n - p), 9) AS fpr,
               round(CAST(hits AS DOUBLE) / p, 9) AS tpr FROM steps""", YEAR, more=_MORE),
    "pr_points": sql("""
        SELECT score AS threshold, round(CAST(hits AS DOUBLE) / flagged, 9) AS precision,
               round(CAST(hits AS DOUBLE) / p, 9) AS recall FROM steps""", YEAR, more=_MORE),
    "roc_auc": sql("""
        SELECT round(sum((n_rows - pos) * (hits - pos + pos / 2.0)) / (max(p) * (max(n) - max(p)))::DOUBLE, 6) AS auc_roc
        FROM steps""", YEAR, more=_MORE),
    "average_precision": sql("""
        SELECT round(sum(pos * (hits / flagged::DOUBLE)) / max(p), 6) AS average_precision FROM steps""", YEAR, more=_MORE),
    "lift_at_k": sql("""
        SELECT 0.2::DOUBLE AS k_percent, round(captured / total::DOUBLE, 6) AS recall_at_k,
               round((captured / n_k::DOUBLE) / (total / n::DOUBLE), 6) AS lift_at_k, captured,
               CAST(total AS BIGINT) AS total FROM lift""", YEAR, more=_MORE),
    "lift_curve": sql("""
        SELECT customer_id, rn AS rank, round(rn / n::DOUBLE, 6) AS cumulative_pop,
               round(found / p::DOUBLE, 6) AS cumulative_recall,
               round((found / rn::DOUBLE) / (p / n::DOUBLE), 6) AS cumulative_lift FROM placed""", YEAR, more=_MORE),
    "threshold_grid": sql("""
        SELECT threshold, round(recall, 6) AS recall, round(precision, 6) AS precision,
               row_number() OVER (ORDER BY (recall >= 0.8 AND precision >= 0.3) DESC, recall DESC, threshold) = 1 AS chosen
        FROM rated""", YEAR, more=_MORE),
    "class_report": sql("""
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM classes
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                         CAST(sum(support) AS BIGINT) FROM classes
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                         round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                         CAST(sum(support) AS BIGINT) FROM classes
        UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS a,
                         tp + fp + fn + tn AS n FROM confusion)""", YEAR, more=_MORE),
    "action_tiers": sql(f"""
        SELECT customer_id, churn_probability, churn_flag, {_ACTION} AS recommended_action FROM predicted""",
        YEAR, more=_MORE),
    "risk_levels": sql(f"SELECT {_RISK} AS risk_level, count(*) AS cnt FROM predicted GROUP BY 1", YEAR, more=_MORE),
    "request_validation": sql(_errors()),
    "serving_defaults": sql("""
        SELECT customer_id, round(coalesce(avg_satisfaction_score, 3.5), 6) AS avg_satisfaction_score,
               round(coalesce(avg_delivery_days, 5.0), 6) AS avg_delivery_days,
               round(monetary_total / 90.0, 6) AS spending_intensity FROM raw_matrix"""),
    "batch_scoring": sql(_ANSWER, more=_MORE),
    "batch_summary": sql("""
        SELECT (SELECT count(*) FROM requests) AS total, count(*) AS scored,
               (SELECT count(*) FROM requests) - count(*) AS rejected,
               CAST(sum(churn_flag) AS BIGINT) AS churn_count, 'rule' AS model_version
        FROM answers""", more=_MORE),
    "rejected_requests": sql(
        f"SELECT * FROM ({_errors('requests', 'customer_segment')}) WHERE errors <> ''", more=_MORE
    ),
    "bootstrap_recall_ci": sql("""
        SELECT round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0), 6) AS recall_observed, '95%' AS ci_level,
               true AS ordered, true AS near FROM confusion""", YEAR, more=_MORE),
    "prediction_log": sql(f"""
        SELECT customer_id, 'rule' AS model_version, churn_probability, churn_flag, 0.5::DOUBLE AS decision_threshold,
               {_ACTION} AS action_triggered FROM predicted""", YEAR, more=_MORE),
    "stream_scores": sql(f"""
        SELECT customer_id, 'rule' AS model_version, churn_probability, churn_flag, 0.5::DOUBLE AS decision_threshold,
               {_ACTION} AS action_triggered FROM answers""", more=_MORE),
    "campaign_roi": sql("""
        SELECT tp, fp, CAST(5 * (tp + fp) AS DOUBLE) AS spend,
               round(CAST(120 * tp - 5 * (tp + fp) AS DOUBLE) / (5 * (tp + fp)), 6) AS roi
        FROM confusion""", YEAR, more=_MORE),
    "best_action": sql("""
        SELECT customer_id, action AS best_action, round(utility, 6) AS expected_utility
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY utility DESC, cost, action DESC) AS rn
              FROM options) WHERE rn = 1""", YEAR, more={**_MORE, "options": _OPTIONS}),
    "imputed_guardrail": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS metric, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS value, "
        f"40.0::DOUBLE AS maximum, 100 * count(*) FILTER (WHERE {c} IS NULL) <= 40 * count(*) AS passed FROM raw_matrix"
        for c in MATRIX_NUMERIC
    )),
    "guardrails": sql("""
        SELECT metric, round(value, 6) AS value, minimum, value >= minimum AS passed
        FROM (SELECT 'precision' AS metric, tp / CAST(tp + fp AS DOUBLE) AS value, 0.3::DOUBLE AS minimum FROM confusion
              UNION ALL SELECT 'auc_roc', sum((n_rows - pos) * (hits - pos + pos / 2.0))
                        / (max(p) * (max(n) - max(p)))::DOUBLE, 0.65 FROM steps
              UNION ALL SELECT 'auc_pr', sum(pos * (hits / flagged::DOUBLE)) / max(p), 0.4 FROM steps
              UNION ALL SELECT 'lift_at_20', (captured / n_k::DOUBLE) / (total / n::DOUBLE), 1.5 FROM lift)""",
        YEAR, more=_MORE),
    "drift_psi": sql(_drift("recency_days") + " UNION ALL " + _drift("frequency_orders"),
                     cutoffs=[EARLIER, CUTOFF], more=_MORE),
    "pseudonymised_ids": sql("SELECT sha256(CAST(customer_id AS VARCHAR)) AS customer_id, order_date FROM orders_head"),
}
