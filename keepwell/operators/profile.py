"""Descriptive statistics of the feature matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from keepwell.operators.quantiles import quantiles
from keepwell.params import NUMERIC_FEATURES

QUARTILES = (0.25, 0.5, 0.75)


def describe(
    matrix: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, digits: int = 3, accuracy: int | None = None
) -> DataFrame:
    """count, mean, std, min, quartiles, max per column. ``matrix`` should be stored."""
    cells = quantiles(matrix, {c: QUARTILES for c in columns}, accuracy=accuracy).get((), {})
    moments = matrix.agg(*[
        expr
        for c in columns
        for expr in (
            F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
        )
    ])

    def number(value):
        return F.round(value.cast("double"), digits)

    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}__n").alias("cnt"),
            number(F.col(f"{c}__mean")).alias("mean"),
            number(F.col(f"{c}__std")).alias("std"),
            number(F.col(f"{c}__min")).alias("min"),
            *[
                number(F.lit(cells.get(c, {}).get(q))).alias(name)
                for q, name in zip(QUARTILES, ("p25", "p50", "p75"))
            ],
            number(F.col(f"{c}__max")).alias("max"),
        )
        for c in columns
    ]
    return moments.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _pearson(matrix: DataFrame, pairs: Sequence[tuple[str, str]], digits: int) -> DataFrame:
    """(feature_a, feature_b, correlation) over the rows where both are present; NULL if one is constant.

    Made of covariances and deviations, as Spark's ``corr`` fails on a constant column in ANSI mode. Without
    gaps the deviation of a column serves all its pairs.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    x = {c: F.col(c).cast("double") for c in names}
    gaps = matrix.agg(*[F.count(F.when(F.col(c).isNull(), True)).alias(c) for c in names]).first()
    whole = [c for c in names if gaps[c] == 0]

    def deviation(c: str, other: str) -> str:
        return f"_s_{c}" if c in whole and other in whole else f"_s_{c}_{other}"

    aggregates = {f"_s_{c}": F.stddev_pop(x[c]) for c in whole}
    for a, b in pairs:
        aggregates[f"_c_{a}_{b}"] = F.covar_pop(x[a], x[b])
        for c, other in ((a, b), (b, a)):
            if deviation(c, other) not in aggregates:
                aggregates[deviation(c, other)] = F.stddev_pop(F.when(x[other].isNotNull(), x[c]))
    summed = matrix.agg(*[expr.alias(name) for name, expr in aggregates.items()])
    rows = [
        F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.round(
                F.try_divide(F.col(f"_c_{a}_{b}"), F.col(deviation(a, b)) * F.col(deviation(b, a))), digits
            ).alias("correlation"),
        )
        for a, b in pairs
    ]
    return summed.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def correlations(matrix: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair, ``feature_a`` listed before ``feature_b``; one pass for all pairs."""
    return _pearson(matrix, [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]], digits)


def target_correlation(
    matrix: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, target: str = "churn_label", digits: int = 6
) -> DataFrame:
    found = _pearson(matrix, [(c, target) for c in columns], digits)
    return found.select(F.col("feature_a").alias("feature"), "correlation").orderBy(F.desc("correlation"), "feature")


def class_balance(matrix: DataFrame, label: str = "churn_label") -> DataFrame:
    total = matrix.agg(F.count(F.lit(1))).scalar()
    counted = matrix.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.withColumn("class_share", F.round(F.col("cnt") / total, 6))


def histograms(
    matrix: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, label: str = "churn_label", bins: int = 30
) -> DataFrame:
    """Equal-width density histogram of every feature and class, over the range of that class.

    A constant column gets a range of one around its value. Every bin is listed.
    """
    long = (
        matrix.select(
            label,
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
            ).alias("cell"),
        )
        .select(label, "cell.*")
        .filter(F.col("value").isNotNull())
    )
    key = [label, "feature"]
    ranges = (
        long.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .select(
            *key,
            "n",
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    width = (F.col("hi") - F.col("lo")) / bins
    # `ranges` has one row per class and feature.
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counted = (
        long.join(F.broadcast(ranges), key)
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(*key, "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, [*key, "bin"], "left").select(
        *key,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("cnt"),
        (F.coalesce("rows", F.lit(0)) / (F.col("n") * width)).alias("density"),
    )
