"""Sketches per day, stored with the facts and merged at read.

Every day of a fact table has one row per column and group: a quantile sketch (KLL) of a numeric column, or a distinct sketch (HLL) of
any column. Fences, medians, distinct counts and drift of any window come from the rows of its days; the facts are not read again. A day that
is written again replaces itself. The exact operators stay the default; results here carry their error bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.operators.decisions import PSI_LIMIT
from keepwell.session import settle

QUANTILE_K = 800
DISTINCT_LG = 14


def rank_error(k: int, of_two: bool = False) -> float:
    """Bound of the error of a rank (or of a difference of two) as a share of all values, at about 99 %.

    Fixed values of the sketch library's published fit.
    """
    return 2.446 / k**0.9433 if of_two else 2.296 / k**0.9723


def distinct_error(lg: int) -> float:
    """Bound of the relative error of a distinct count at three standard errors."""
    return 3 * 1.04 / 2 ** (lg / 2)


def daily_sketches(
    df: DataFrame, day: str, numeric: Sequence[str] = (), distinct: Sequence[str] = (), by: Sequence[str] = (),
    k: int = QUANTILE_K, lg: int = DISTINCT_LG, grain: str = "day",
) -> DataFrame:
    """``(*by, day, column, kind, size, rows, sketch)``: one row per group, day and column. NULLs do not count.

    With the grain ``month`` a row stands for a month and is dated by its first day: fewer folders for a long past, and windows of
    whole months.

    One aggregation, combined before its shuffle; ``size`` is k or lg, from which the error bound follows.
    """
    made = [F.count(c).alias(f"_n_{kind}_{c}") for kind, names in (("quantiles", numeric), ("distinct", distinct)) for c in names]
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"_s_quantiles_{c}") for c in numeric]
    made += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg)).alias(f"_s_distinct_{c}") for c in distinct]
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(size).alias("size"), F.col(f"_n_{kind}_{c}").alias("rows"),
            F.col(f"_s_{kind}_{c}").alias("sketch"),
        )
        for kind, names, size in (("quantiles", numeric, k), ("distinct", distinct, lg)) for c in names
    ]
    if not cells:
        raise ValueError("no column to sketch")
    if grain not in ("day", "month"):
        raise ValueError("the grain is day or month")
    dated = F.to_date(day) if grain == "day" else F.trunc(F.to_date(day), "month")
    daily = df.groupBy(*by, dated.alias("day")).agg(*made)
    return daily.select(*by, "day", F.explode(F.array(*cells)).alias("cell")).select(*by, "day", "cell.*").filter("rows > 0")


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store by day, replacing the days that ``sketches`` holds and no others."""
    (
        sketches.repartitionByRange("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(path)
    )


def merged(spark: SparkSession, path: str, first: date, last: date, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, kind, size, rows, sketch)`` of the days from ``first`` to ``last``; only their folders are read.

    Groups that were stored and are not in ``by`` are merged like days.
    """
    days = spark.read.parquet(path).filter(F.col("day").between(F.lit(first), F.lit(last)))
    group = [*by, "column", "kind"]
    # The parts of a group that merge in one task are sketches of bounded size, one per day and stored group.
    quantiles = days.filter("kind = 'quantiles'").groupBy(*group).agg(
        F.min("size").alias("size"), F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    distinct = days.filter("kind = 'distinct'").groupBy(*group).agg(
        F.min("size").alias("size"), F.sum("rows").alias("rows"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch")
    )
    return settle(quantiles.unionByName(distinct))


def quantiles_of(sketches: DataFrame, wanted: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, p, value, rank_error)``: a value whose rank is p, give or take ``rank_error``."""
    rows = sketches.filter((F.col("kind") == "quantiles") & F.col("column").isin(list(wanted)))
    # The ranks asked of a sketch are constants of the expression, one for each column.
    found = _each(wanted, lambda ps: F.arrays_zip(
        F.array(*map(F.lit, ps)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ps))).alias("value")
    ))
    return rows.select(*by, "column", F.explode(found).alias("hit"), _error("size").alias("rank_error")).select(
        *by, "column", "hit.p", "hit.value", "rank_error"
    )


def _each(values: Mapping[str, Sequence[float]], of) -> Column:
    """``of(values[column])`` for the column that a row is about."""
    cases = [F.when(F.col("column") == c, of([float(v) for v in own])) for c, own in values.items()]
    return F.coalesce(*cases)


def _error(size: str, of_two: bool = False) -> Column:
    scale, power = (2.446, 0.9433) if of_two else (2.296, 0.9723)
    return F.lit(scale) / F.pow(F.col(size), F.lit(power))


def distinct_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, distinct_values, relative_error)``."""
    return sketches.filter("kind = 'distinct'").select(
        *by, "column", F.hll_sketch_estimate("sketch").alias("distinct_values"),
        (F.lit(3 * 1.04) / F.pow(F.lit(2.0), F.col("size") / 2)).alias("relative_error"),
    )


def fences_of(sketches: DataFrame, columns: Sequence[str], factor: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, low, high)``: the quartiles moved out by ``factor`` times their distance."""
    wide = quantiles_of(sketches, {c: (0.25, 0.75) for c in columns}, by).groupBy(*by, "column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("_q1"), F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("_q3")
    )
    reach = factor * (F.col("_q3") - F.col("_q1"))
    return wide.select(*by, "column", (F.col("_q1") - reach).alias("low"), (F.col("_q3") + reach).alias("high"))


def drift(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """``(feature, psi, retrain, share_error)`` from two merged tables: the stability index over the baseline's quantile bins.

    ``share_error`` bounds the error of the share of a bin. A column that either side lacks has no row.
    """
    asked = quantiles_of(baseline, {c: [i / bins for i in range(1, bins)] for c in columns})
    # One row per column, with an edge for each bin.
    edges = {r["column"]: sorted(r["edges"]) for r in asked.groupBy("column").agg(F.collect_set("value").alias("edges")).collect()}
    if not edges:
        return baseline.select(F.col("column").alias("feature"), F.lit(0.0).alias("psi"), F.lit(False).alias("retrain"), F.lit(0.0).alias("share_error")).limit(0)

    def side(sketches: DataFrame, name: str) -> DataFrame:
        own = sketches.filter((F.col("kind") == "quantiles") & F.col("column").isin(list(edges)))
        ranks = own.select("column", F.col("size").alias(f"_size_{name}"), _each(
            edges, lambda es: F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, es)))).alias("_ranks"))
        upper, lower = F.concat("_ranks", F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), "_ranks")
        return ranks.select("column", f"_size_{name}", F.zip_with(upper, lower, lambda a, b: F.greatest(a - b, F.lit(floor))).alias(f"_{name}"))

    both = side(baseline, "b").join(side(current, "c"), "column")
    term = F.zip_with("_b", "_c", lambda b, c: (c - b) * F.ln(c / b))
    psi = F.aggregate(term, F.lit(0.0), lambda total, x: total + x)
    error = F.greatest(_error("_size_b", True), _error("_size_c", True))
    return both.select(F.col("column").alias("feature"), psi.alias("psi"), (psi > PSI_LIMIT).alias("retrain"), error.alias("share_error"))
