"""Classifier metrics over a scored DataFrame (label, score, and an id to break ties)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.functions.numeric import share
from keepwell.operators.ranking import with_position, with_running_totals
from keepwell.params import Evaluation, ThresholdSearch
from keepwell.session import settle


def confusion(scored: DataFrame, label: str = "churn_label", flag: str = "churn_flag") -> DataFrame:
    """One row: tp, fp, fn, tn, recall, precision, f1; 0/0 gives 0."""
    truth, said = F.col(label) == 1, F.col(flag) == 1
    counts = scored.agg(
        F.count(F.when(truth & said, True)).alias("tp"),
        F.count(F.when(~truth & said, True)).alias("fp"),
        F.count(F.when(truth & ~said, True)).alias("fn"),
        F.count(F.when(~truth & ~said, True)).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp", "fp", "fn", "tn",
        share(tp, tp + fn).alias("recall"),
        share(tp, tp + fp).alias("precision"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _score_steps(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, from the highest: rows and positives at it and down to it, with grand totals.

    Equal scores meet before the sort, so a score shared by many rows is one row here.
    """
    per_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(F.when(F.col(label) == 1, True)).alias("_pos")
    )
    return with_running_totals(per_score, F.desc("score"), sums={"_rows": "flagged", "_pos": "hits"})


def roc_points(scored: DataFrame, score: str = "score", label: str = "churn_label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    steps = _score_steps(scored, score, label)
    return steps.select(
        F.col("score").alias("threshold"),
        share(F.col("flagged") - F.col("hits"), F.col("total_flagged") - F.col("total_hits"), None).alias("fpr"),
        share(F.col("hits"), F.col("total_hits"), None).alias("tpr"),
    )


def pr_points(scored: DataFrame, score: str = "score", label: str = "churn_label") -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    steps = _score_steps(scored, score, label)
    return steps.select(
        F.col("score").alias("threshold"),
        share(F.col("hits"), F.col("flagged")).alias("precision"),
        share(F.col("hits"), F.col("total_hits"), None).alias("recall"),
    )


def ranking_metrics(scored: DataFrame, score: str = "score", label: str = "churn_label") -> DataFrame:
    """One row: auc_roc (NULL if a class is missing) and average_precision as a step sum (0 without positives)."""
    steps = _score_steps(scored, score, label)
    negatives = F.col("_rows") - F.col("_pos")
    above = F.col("hits") - F.col("_pos")
    summed = steps.agg(
        F.sum(negatives.cast("double") * (above + F.col("_pos") / 2.0)).alias("_area"),
        F.sum(F.col("_pos").cast("double") * share(F.col("hits"), F.col("flagged"))).alias("_steps"),
        F.max("total_hits").alias("_p"),
        F.max("total_flagged").alias("_n"),
    )
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    return summed.select(
        F.try_divide(F.col("_area"), p * (n - p)).alias("auc_roc"),
        share(F.col("_steps"), p).alias("average_precision"),
    )


def lift_at_k(
    scored: DataFrame, k: float = 0.20, score: str = "score", label: str = "churn_label", tie: str = "customer_id"
) -> DataFrame:
    """Recall and lift among the ``int(n * k)`` rows of highest score; ties go to the smaller id.

    Rows are counted per score; only those at the score where the last place falls are put in order.
    """
    steps = settle(_score_steps(scored, score, label))
    whole = steps.agg(F.max("total_flagged").alias("n"), F.max("total_hits").alias("p")).first()
    n, p = whole["n"] or 0, whole["p"] or 0
    n_k = math.floor(n * float(k))
    edge = steps.filter((F.col("flagged") >= n_k) & (F.col("flagged") - F.col("_rows") < n_k)).first()
    above, found, at = (edge["flagged"] - edge["_rows"], edge["hits"] - edge["_pos"], edge["score"]) if edge else (0, 0, None)
    tied = scored.filter(F.col(score).eqNullSafe(F.lit(at)) if edge else F.lit(False)).select(tie, label)
    placed = with_position(tied, F.asc(tie))
    last = F.count(F.when((F.col(label) == 1) & (F.col("position") < n_k - above), True))
    counts = placed.agg((last + found).alias("captured")).select(
        F.lit(n).cast("bigint").alias("_n"), F.lit(n_k).cast("bigint").alias("_n_k"),
        F.lit(p).cast("bigint").alias("total"), F.col("captured").cast("bigint").alias("captured"),
    )
    rate = share(F.col("total"), F.col("_n"))
    lift = F.when(rate > 0, share(F.col("captured"), F.col("_n_k")) / rate).otherwise(F.lit(1.0))
    return counts.select(
        F.lit(float(k)).alias("k_percent"),
        share(F.col("captured"), F.col("total")).alias("recall_at_k"),
        lift.alias("lift_at_k"),
        "captured",
        "total",
    )


def lift_curve(
    scored: DataFrame, score: str = "score", label: str = "churn_label", tie: str = "customer_id"
) -> DataFrame:
    """Cumulative population, recall and lift after every row, from the highest score."""
    rows = scored.select(tie, score, label).withColumn("_one", F.lit(1)).withColumn("_pos", (F.col(label) == 1).cast("int"))
    run = with_running_totals(rows, F.desc(score), F.asc(tie), sums={"_one": "seen", "_pos": "found"})
    average = share(F.col("total_found"), F.col("total_seen"), None)
    return run.select(
        tie,
        F.col("seen").alias("rank"),
        share(F.col("seen"), F.col("total_seen")).alias("cumulative_pop"),
        share(F.col("found"), F.col("total_found"), None).alias("cumulative_recall"),
        F.try_divide(share(F.col("found"), F.col("seen")), average).alias("cumulative_lift"),
    )


# -- threshold ----------------------------------------------------------------------------------------


def _grid(search: ThresholdSearch) -> list[float]:
    return [float(t) for t in np.arange(search.start, search.end, search.step)]


def _grid_bucket(score: Column, grid: Sequence[float], step: float) -> Column:
    """How many thresholds are at or below the score: a guess by division, corrected by one comparison each way."""
    edges = F.array(*[F.lit(t) for t in grid])
    size = len(grid)
    guess = F.least(F.greatest(F.floor((score - grid[0]) / step).cast("int") + 1, F.lit(0)), F.lit(size))
    down = (guess > 0) & (score < F.try_element_at(edges, F.greatest(guess, F.lit(1))))
    up = (guess < size) & (score >= F.try_element_at(edges, F.least(guess + 1, F.lit(size))))
    return F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)


def threshold_grid(
    scored: DataFrame,
    search: ThresholdSearch = ThresholdSearch(),
    score: str = "score",
    label: str = "churn_label",
) -> DataFrame:
    """(threshold, recall, precision, chosen) over the grid.

    Each row is put into its bucket of the grid once; the windows below run over the grid, not the rows.
    Chosen is the highest recall among thresholds that meet both minima, the lowest threshold among equals;
    without any such threshold, the highest recall alone.
    """
    grid = _grid(search)
    buckets = (
        scored.groupBy(_grid_bucket(F.col(score).cast("double"), grid, search.step).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.count(F.when(F.col(label) == 1, True)).alias("_pos"))
    )
    spark = scored.sparkSession
    steps = spark.createDataFrame(
        [(0, None)] + [(i + 1, round(t, 3)) for i, t in enumerate(grid)], "bucket int, threshold double"
    )
    # At most one row per bucket on either side; bucket 0 lies below the grid.
    whole = steps.join(F.broadcast(buckets), "bucket", "left")
    from_top = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    sums = whole.select(
        "threshold",
        F.coalesce(F.sum("_rows").over(from_top), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("_pos").over(from_top), F.lit(0)).alias("hits"),
        F.coalesce(F.sum("_pos").over(everything), F.lit(0)).alias("positives"),
    ).filter(F.col("threshold").isNotNull())
    rated = sums.select(
        "threshold",
        share(F.col("hits"), F.col("positives")).alias("recall"),
        share(F.col("hits"), F.col("flagged")).alias("precision"),
    )
    feasible = (
        (F.col("recall") >= search.min_recall) & (F.col("precision") >= search.min_precision) & (F.col("recall") > 0)
    )
    best = Window.orderBy(feasible.cast("int").desc(), F.desc("recall"), F.asc("threshold"))
    return rated.withColumn("chosen", F.row_number().over(best) == 1)


def best_threshold(scored: DataFrame, search: ThresholdSearch = ThresholdSearch(), **columns: str) -> float:
    return threshold_grid(scored, search, **columns).filter("chosen").first()["threshold"]


# -- uncertainty and reports --------------------------------------------------------------------------


# Resamples that one block of the bootstrap draws.
_DRAWS = 128


def bootstrap_recall(confusions: DataFrame, settings: Evaluation = Evaluation(), seed: int = 245573) -> DataFrame:
    """Bootstrap interval of the recall from one row of tp, fp, fn, tn.

    Drawing n rows with replacement draws (true positives, false negatives, the rest) from a multinomial, so
    a resample needs three numbers and not the rows. Iterations are dealt to tasks in blocks, each with a seed of its
    own. ``recall_point`` is the mean over the resamples, ``recall_observed`` the recall of the rows themselves.
    """

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tp, fn, rest, observed, first, draws in batch.itertuples(index=False):
                n = int(tp + fn + rest)
                if n == 0:
                    yield pd.DataFrame({"observed": observed, "recall": np.zeros(int(draws))})
                    continue
                rng = np.random.default_rng([seed, int(first)])
                hit, lost, _ = rng.multinomial(n, [tp / n, fn / n, rest / n], int(draws)).T
                yield pd.DataFrame({"observed": observed, "recall": hit / np.maximum(hit + lost, 1)})

    last = settings.bootstrap_iterations
    iterations = confusions.select(
        "tp", "fn", (F.col("fp") + F.col("tn")).alias("rest"),
        share(F.col("tp"), F.col("tp") + F.col("fn")).alias("observed"),
        F.explode(F.sequence(F.lit(0), F.lit(last - 1), F.lit(_DRAWS))).alias("first"),
    ).withColumn("draws", F.least(F.lit(_DRAWS), F.lit(last) - F.col("first")))
    # The counts are one row; its blocks go to tasks of their own.
    iterations = iterations.repartition(max(1, -(-last // _DRAWS)), "first")
    tail = settings.bootstrap_alpha / 2
    # One value per iteration reaches the percentile.
    return iterations.mapInPandas(draw, "observed double, recall double").agg(
        F.avg("recall").alias("recall_point"),
        F.max("observed").alias("recall_observed"),
        F.percentile("recall", F.lit(tail)).alias("recall_ci_low"),
        F.percentile("recall", F.lit(1 - tail)).alias("recall_ci_high"),
        F.lit(f"{int((1 - settings.bootstrap_alpha) * 100)}%").alias("ci_level"),
    )


def class_report(scored: DataFrame, label: str = "churn_label", flag: str = "churn_flag") -> DataFrame:
    """precision, recall, f1, support per class, with macro and weighted averages and accuracy."""
    cells = scored.groupBy(F.col(label).alias("truth"), F.col(flag).alias("said")).agg(F.count(F.lit(1)).alias("n"))
    classes = cells.select(
        F.explode(F.array("truth", "said")).alias("class"), "truth", "said", "n"
    ).distinct()
    mine_true, mine_said = F.col("truth") == F.col("class"), F.col("said") == F.col("class")
    per_class = classes.groupBy("class").agg(
        F.sum(F.when(mine_true & mine_said, F.col("n")).otherwise(0)).alias("hit"),
        F.sum(F.when(mine_true, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(mine_said, F.col("n")).otherwise(0)).alias("said"),
    )
    rated = per_class.select(
        F.col("class").cast("string").alias("class"),
        share(F.col("hit"), F.col("said")).alias("precision"),
        share(F.col("hit"), F.col("support")).alias("recall"),
        share(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1"),
        F.col("support"),
        F.col("hit"),
    )
    measures = ("precision", "recall", "f1")

    def weighted(c: str) -> Column:
        return share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)

    macro = rated.agg(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in measures], F.sum("support").alias("support"))
    mean = rated.agg(F.lit("weighted avg").alias("class"), *[weighted(c) for c in measures], F.sum("support").alias("support"))
    accuracy = share(F.sum("hit"), F.sum("support"))
    total = rated.agg(
        F.lit("accuracy").alias("class"), *[accuracy.alias(c) for c in measures], F.sum("support").alias("support")
    )
    return rated.drop("hit").unionByName(macro).unionByName(mean).unionByName(total)
