"""Global positions and running totals without a single-partition window.

Rows are range-partitioned and sorted, stored once so that their places cannot change, and then shifted by
the totals of the partitions before them. The table of partition totals has one row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.session import settle

_PLACE = "_place"
_PART = "_part"


def _in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = settle(ordered.withColumn(_PLACE, F.monotonically_increasing_id()))
    # The id is the partition number in the high bits and the row's place in its partition in the low 33.
    return fixed.withColumn(_PART, F.shiftright(_PLACE, 33))


def _shift(parts: DataFrame, total: str, before: str) -> DataFrame:
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return parts.withColumn(before, F.coalesce(F.sum(total).over(earlier), F.lit(0))).withColumn(
        total, F.sum(total).over(everything)
    )


def with_position(df: DataFrame, *order: Column, position: str = "position", total: str = "total_rows") -> DataFrame:
    """Zero-based position of every row in the global order, and the number of rows.

    ``order`` should end in a unique column, so that equal leading values spread over partitions too.
    """
    fixed = _in_order(df, list(order))
    parts = fixed.groupBy(_PART).agg(F.count(F.lit(1)).alias(total))
    shifts = _shift(parts, total, "_before")
    place = F.col(_PLACE).bitwiseAND((1 << 33) - 1)
    return (
        fixed.join(F.broadcast(shifts), _PART)
        .withColumn(position, F.col("_before") + place)
        .drop(_PART, _PLACE, "_before")
    )


def with_running_totals(df: DataFrame, *order: Column, sums: Mapping[str, str]) -> DataFrame:
    """For each ``{column: name}`` the inclusive running sum as ``name`` and the grand total as ``total_name``."""
    fixed = _in_order(df, list(order))
    parts = fixed.groupBy(_PART).agg(*[F.sum(c).alias(f"total_{n}") for c, n in sums.items()])
    for name in sums.values():
        parts = _shift(parts, f"total_{name}", f"_before_{name}")
    so_far = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    out = fixed.join(F.broadcast(parts), _PART)
    for column, name in sums.items():
        out = out.withColumn(name, F.sum(column).over(so_far) + F.col(f"_before_{name}"))
    return out.drop(_PART, _PLACE, *[f"_before_{n}" for n in sums.values()])
