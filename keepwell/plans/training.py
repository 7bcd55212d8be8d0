"""The whole run: features, gate, split, training and evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from keepwell.operators import audit, baselines, cleaning, evaluation, features, learning
from keepwell.operators.splits import expanding_folds, fold_parts, stratified_folds, with_holdout
from keepwell.params import Params
from keepwell.plans.matrix import assemble, feature_matrix, fit_medians, impute
from keepwell.session import settle
from keepwell.sources.schemas import KEYS
from keepwell.sources.tables import Bundle, bounded


def labelled(bundle: Bundle, params: Params) -> Bundle:
    """The bundle with labels drawn from its orders, before the orders are bounded by the cutoff."""
    if bundle.labels is not None:
        return bundle
    return bundle.having(
        labels=features.churn_labels(bundle.orders, [params.cutoff], params.observation_days, params.prediction_days)
    )


@dataclass(frozen=True)
class CleanBundle:
    bundle: Bundle
    report: DataFrame


def clean_bundle(bundle: Bundle, params: Params, accuracy: int | None = None) -> CleanBundle:
    """What is known at the cutoff, cleaned."""
    known = bounded(labelled(bundle, params), params)
    orders = cleaning.clean_orders(known.orders, params.cleaning, accuracy)
    tickets = cleaning.clean_support_tickets(known.tickets, accuracy)
    customers = cleaning.clean_customers(known.customers)
    report = audit.stack([orders.report, tickets.report, customers.report])
    return CleanBundle(
        known.having(orders=orders.data, tickets=tickets.data, customers=customers.data), report
    )


def clean_feature_matrix(bundle: Bundle, params: Params, accuracy: int | None = None, **options) -> DataFrame:
    return feature_matrix(clean_bundle(bundle, params, accuracy).bundle, params, accuracy=accuracy, **options)


def split_matrix(
    bundle: Bundle, params: Params, fit_on: str = "all", accuracy: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. ``fit_on="train"`` takes the imputation medians from the training rows only."""
    raw = settle(with_holdout(assemble(bundle, params), params.holdout_train_share))
    basis = raw.filter("split = 'train'") if fit_on == "train" else raw
    whole = impute(raw, fit_medians(basis, accuracy=accuracy))
    return whole.filter("split = 'train'").drop("split"), whole.filter("split = 'test'").drop("split")


def full_evaluation(
    scored: DataFrame, threshold: float, params: Params = Params(), pipeline: PipelineModel | None = None,
    tie: str = "customer_id",
) -> dict[str, DataFrame]:
    """All metrics of a scored test set; ``scored`` holds the features, ``churn_label`` and ``score``."""
    flagged = settle(scored.withColumn("churn_flag", (F.col("score") >= threshold).cast("int")))
    confusions = evaluation.confusion(flagged)
    reports = {
        "confusion": confusions,
        "ranking": evaluation.ranking_metrics(flagged),
        "classes": evaluation.class_report(flagged),
        "lift": evaluation.lift_at_k(flagged, params.evaluation.top_share, tie=tie),
        "bootstrap": evaluation.bootstrap_recall(confusions, params.evaluation, params.seed),
        "roc": evaluation.roc_points(flagged),
        "pr": evaluation.pr_points(flagged),
        "lift_curve": evaluation.lift_curve(flagged, tie=tie),
    }
    if "recency_days" in flagged.columns:
        rule = flagged.withColumn("churn_flag", baselines.recency_fixed(flagged, 60))
        reports["recency_baseline"] = evaluation.confusion(rule).select("recall", "precision")
        reports["baselines"] = baselines.evaluate_baselines(flagged)
    if pipeline is not None:
        reports["importance"] = learning.feature_importance(pipeline, scored)
    return reports


HEADLINE = ("recall", "precision", "f1", "auc_roc", "auc_pr", "lift_at_20")


def headline(reports: dict[str, DataFrame]) -> dict[str, float]:
    """The single numbers of an evaluation, from its one-row reports."""
    confusions, ranking, lift = (reports[k].first() for k in ("confusion", "ranking", "lift"))
    return {
        "recall": confusions["recall"],
        "precision": confusions["precision"],
        "f1": confusions["f1"],
        "auc_roc": ranking["auc_roc"],
        "auc_pr": ranking["average_precision"],
        "lift_at_20": lift["lift_at_k"],
    }


def _fold_metrics(parts, params: Params, key: Sequence[str], spark) -> DataFrame:
    """One row per fold: sizes, and headline metrics of a model fitted on its training part."""
    rows = []
    for fold, (train, test) in enumerate(parts, start=1):
        model = learning.fit(train, params, key)
        scored = settle(learning.scores(model.pipeline, test))
        flagged = scored.withColumn("churn_flag", (F.col("score") >= model.threshold).cast("int"))
        confusion = evaluation.confusion(flagged)
        numbers = headline({
            "confusion": confusion,
            "ranking": evaluation.ranking_metrics(scored),
            "lift": evaluation.lift_at_k(scored, params.evaluation.top_share),
        })
        cells = confusion.first()
        sizes = (int(model.facts["n_train"]), cells["tp"] + cells["fp"] + cells["fn"] + cells["tn"], cells["tp"] + cells["fn"])
        rows.append((fold, *sizes, *[numbers[name] for name in HEADLINE]))
    schema = ", ".join(["fold int", "n_train bigint", "n_test bigint", "n_test_churned bigint", *[f"{n} double" for n in HEADLINE]])
    return spark.createDataFrame(rows, schema)


def cross_validate(
    matrix: DataFrame, cutoffs: Sequence[date] | None = None, params: Params = Params(), key: Sequence[str] | None = None
) -> DataFrame:
    """Sizes and headline metrics per fold, one row each.

    With ``cutoffs`` the folds are cohorts: train on the cutoffs before, test on the next. Without, rows are dealt out by class.
    ``matrix`` should be stored.
    """
    if cutoffs:
        parts = expanding_folds(matrix, cutoffs, params.evaluation.folds)
        return _fold_metrics(parts, params, key or ("customer_id", "cutoff_date"), matrix.sparkSession)
    key = key or ("customer_id",)
    folded = settle(stratified_folds(matrix, params.evaluation.folds, key, seed=params.seed))
    return _fold_metrics(fold_parts(folded, params.evaluation.folds), params, key, matrix.sparkSession)


@dataclass(frozen=True)
class Run:
    model: learning.TrainedModel
    reports: dict[str, DataFrame]
    metrics: dict[str, float]
    gate: str


def gate_reasons(bundle: Bundle, matrix: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """Reasons to stop over all tables of the bundle and the matrix, both as they came."""
    tables = {
        "dim_customers": bundle.customers, "fact_orders": bundle.orders, "fact_support_tickets": bundle.tickets,
        "fact_order_items": bundle.items, "ml_feature_store": matrix,
    }
    if bundle.labels is not None:
        tables["ml_churn_labels"] = bundle.labels
    parents = [
        (child, column, parent) for child, column, parent in (
            ("fact_orders", "customer_id", "dim_customers"),
            ("fact_support_tickets", "customer_id", "dim_customers"),
            ("fact_order_items", "order_id", "fact_orders"),
            ("ml_churn_labels", "customer_id", "dim_customers"),
        ) if child in tables
    ]
    # Lines of a bundle carry no key of their own; they are checked for orphans.
    keyed = {t: keys[t] for t in tables if t != "fact_order_items"} | {"fact_order_items": tuple(bundle.items.columns)}
    integrity = audit.key_integrity(tables, keyed, parents)
    known = integrity.withColumn(
        "duplicate_keys", F.when(F.col("table_name") == "fact_order_items", 0).otherwise(F.col("duplicate_keys"))
    )
    return audit.stop_go_reasons(known, audit.missingness(matrix), matrix)


def train_and_evaluate(
    bundle: Bundle, params: Params, on_stop: str = "raise", fit_on: str = "all", accuracy: int | None = None
) -> Run:
    """Check, clean, build, split, fit, evaluate.

    The gate comes before any cleaning, over the raw tables and the raw matrix: what cleaning would merge, bound or fill is still
    there. A failed gate ends the run unless ``on_stop="go_on"``.
    """
    reasons = gate_reasons(bundle, settle(assemble(bundle, params)), KEYS)
    status = audit.gate(reasons, on_stop)
    clean = clean_bundle(bundle, params, accuracy).bundle
    train, test = split_matrix(clean, params, fit_on, accuracy)
    model = learning.fit(train, params)
    reports = full_evaluation(learning.scores(model.pipeline, test), model.threshold, params, model.pipeline)
    return Run(model, reports, headline(reports), status)
