"""Attaching cutoff dates to dated rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

# Up to here the cutoffs are compared in the row expression; beyond, rows meet them by an equi-join on the day.
INLINE_COHORTS = 64
# A day table below this row count (two dates a row) may be broadcast.
BROADCAST_DAYS = 1_000_000


def day_table(spark: SparkSession, cutoffs: Sequence[date], back: int, ahead: int) -> DataFrame:
    """(day, cutoff_date) for every day of every window."""
    listed = spark.createDataFrame([(c,) for c in cutoffs], "cutoff_date date")
    days = F.sequence(F.date_sub("cutoff_date", back), F.date_add("cutoff_date", ahead))
    return listed.select(F.explode(days).alias("day"), "cutoff_date")


def attach_cohorts(df: DataFrame, day: str, cutoffs: Sequence[date], back: int, ahead: int = 0) -> DataFrame:
    """One row per input row and cutoff ``c`` with ``c - back <= day <= c + ahead``, as column ``cutoff_date``."""
    cutoffs = sorted(set(cutoffs))
    first = cutoffs[0] - timedelta(days=back)
    last = cutoffs[-1] + timedelta(days=ahead)
    near = df.filter(F.col(day).between(F.lit(first), F.lit(last)))
    if len(cutoffs) == 1:
        return near.withColumn("cutoff_date", F.lit(cutoffs[0]))
    if len(cutoffs) <= INLINE_COHORTS:
        hits = F.filter(
            F.array(*[F.lit(c) for c in cutoffs]),
            lambda c: F.col(day).between(F.date_sub(c, back), F.date_add(c, ahead)),
        )
        return near.withColumn("cutoff_date", F.explode(hits))
    days = day_table(df.sparkSession, cutoffs, back, ahead)
    if len(cutoffs) * (back + ahead + 1) <= BROADCAST_DAYS:
        days = F.broadcast(days)
    return near.join(days, near[day] == days["day"]).drop("day")
