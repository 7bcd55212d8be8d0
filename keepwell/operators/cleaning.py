"""Cleaning of orders, tickets and customers, with a report of what was changed.

Statistics that a step needs (null shares, modes, medians, fences) are fitted first; each fit returns a few
numbers. The cleaned table itself stays lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.dates import parse_date
from keepwell.functions.numeric import clip
from keepwell.operators.constraints import keep_one_per_key, with_defaults
from keepwell.operators.quantiles import medians, quantiles
from keepwell.params import Cleaning

MODE_COLUMNS = ("payment_method", "channel", "order_status")


@dataclass(frozen=True)
class Cleaned:
    data: DataFrame
    report: DataFrame


# -- invariants ---------------------------------------------------------------------------------------


def delivery_violation() -> Column:
    return F.coalesce(F.col("delivery_date") < F.col("order_date"), F.lit(False))


def fix_delivery_after_order(orders: DataFrame) -> DataFrame:
    return orders.withColumn("delivery_date", F.when(~delivery_violation(), F.col("delivery_date")))


def amount_violation() -> Column:
    return F.coalesce(F.col("total_amount") < 0, F.lit(False))


def median_of_valid_amounts(orders: DataFrame, accuracy: int | None = None) -> float | None:
    valid = orders.filter(~amount_violation())
    return medians(valid, ["total_amount"], accuracy=accuracy).get((), {}).get("total_amount")


def fix_positive_amounts(orders: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Negative amounts become the median of the other rows. The median is fitted only if there are any."""
    if orders.filter(amount_violation()).isEmpty():
        return orders
    middle = median_of_valid_amounts(orders, accuracy)
    return orders.withColumn(
        "total_amount", F.when(amount_violation(), F.lit(middle)).otherwise(F.col("total_amount"))
    )


def satisfaction_violation() -> Column:
    return F.coalesce(~F.col("satisfaction_score").between(1, 5), F.lit(False))


def fix_satisfaction_range(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("satisfaction_score", F.when(~satisfaction_violation(), F.col("satisfaction_score")))


# -- gaps and outliers --------------------------------------------------------------------------------


def sparse_columns(df: DataFrame, threshold: float = 0.40, protected: Sequence[str] = ()) -> list[str]:
    """Columns whose share of NULLs is strictly above the threshold; all shares come from one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if c not in protected and shares[c] is not None and shares[c] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.40, protected: Sequence[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, protected))


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest among equals.

    All columns are counted in one pass, as text and value; a column of many values is held by no single task.
    """
    if not columns:
        return {}
    cells = [F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("text")) for i, c in enumerate(columns)]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter(F.col("text").isNotNull())
    counted = long.groupBy("column", "text").agg(F.count(F.lit(1)).alias("_rows"))
    # The smallest among equals in the order of the column's own type.
    typed = [
        F.when(F.col("column") == i, F.col("text")).cast(df.schema[c].dataType).alias(f"v{i}") for i, c in enumerate(columns)
    ]
    best = counted.select("column", (-F.col("_rows")).alias("rank"), *typed).groupBy("column").agg(
        F.min(F.struct("rank", *[f"v{i}" for i in range(len(columns))])).alias("best")
    )
    return {columns[r["column"]]: r["best"][f"v{r['column']}"] for r in best.collect()}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = modes(df, [c for c in columns if c in df.columns])
    return df.fillna(found) if found else df


def impute_median(df: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    middle = medians(df, [column], accuracy=accuracy).get((), {}).get(column)
    if middle is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(middle)))


def iqr_fence(df: DataFrame, column: str, factor: float = 1.5, accuracy: int | None = None) -> tuple[float, float] | None:
    cells = quantiles(df, {column: [0.25, 0.75]}, accuracy=accuracy).get((), {}).get(column, {})
    low, high = cells.get(0.25), cells.get(0.75)
    if low is None or high is None:
        return None
    reach = factor * (high - low)
    return low - reach, high + reach


def cap_iqr(df: DataFrame, column: str, factor: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Values beyond the fence are moved onto it; no row is dropped."""
    fence = iqr_fence(df, column, factor, accuracy)
    return df if fence is None else df.withColumn(column, clip(F.col(column), *fence))


# -- whole tables -------------------------------------------------------------------------------------


REPORT = "table_name string, step string, column_name string, affected_rows bigint, value string"


def _report(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """The cleaning report; at most a few rows per column of a table."""
    return df.sparkSession.createDataFrame(list(rows), REPORT)


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def clean_orders(orders: DataFrame, settings: Cleaning = Cleaning(), accuracy: int | None = None) -> Cleaned:
    """Parse dates, fix invariants, drop sparse columns, impute modes, cap amounts; in this order.

    One pass counts rows, violations and gaps together; it also tells which of the later fits are needed.
    """
    table = "fact_orders"
    parsed = orders.withColumns({c: parse_date(c) for c in ("order_date", "delivery_date")})
    gap = {c: F.col(c).isNull() for c in parsed.columns}
    gap["delivery_date"] = gap["delivery_date"] | delivery_violation()
    found = parsed.agg(
        F.count(F.lit(1)).alias("_rows"),
        _count(delivery_violation()).alias("_late"),
        _count(amount_violation()).alias("_negative"),
        *[_count(empty).alias(c) for c, empty in gap.items()],
    ).first()
    rows = found["_rows"]
    lines = [
        (table, "rows_before", "", rows, None),
        (table, "violations", "delivery_date", found["_late"], None),
        (table, "violations", "total_amount", found["_negative"], None),
    ]
    fixed = fix_delivery_after_order(parsed)
    if found["_negative"]:
        fixed = fix_positive_amounts(fixed, accuracy)
    dropped = [
        c for c in parsed.columns
        if c not in settings.protected and rows and found[c] / rows > settings.null_threshold
    ]
    lines += [(table, "dropped", c, rows, None) for c in dropped]
    data = fixed.drop(*dropped)
    fills = modes(data, [c for c in MODE_COLUMNS if c in data.columns and found[c]])
    if fills:
        lines += [(table, "imputed", c, found[c], f"mode={value}") for c, value in fills.items()]
        data = data.fillna(fills)
    report = _report(orders, [*lines, (table, "rows_after", "", rows, None)])
    fence = iqr_fence(data, "total_amount", settings.iqr_factor, accuracy) if "total_amount" in data.columns else None
    if fence is not None:
        amount = F.col("total_amount")
        capped = data.agg(_count((amount < fence[0]) | (amount > fence[1])).alias("affected_rows")).select(
            F.lit(table).alias("table_name"), F.lit("capped").alias("step"), F.lit("total_amount").alias("column_name"),
            "affected_rows", F.lit(None).cast("string").alias("value"),
        )
        report = report.unionByName(capped)
        data = data.withColumn("total_amount", clip(amount, *fence))
    return Cleaned(data, report)


def clean_support_tickets(tickets: DataFrame, accuracy: int | None = None) -> Cleaned:
    """Parse dates, void scores outside 1..5, impute the median score."""
    table, score = "fact_support_tickets", "satisfaction_score"
    dates = [c for c in ("created_date", "resolved_date") if c in tickets.columns]
    parsed = tickets.withColumns({c: parse_date(c) for c in dates})
    found = parsed.agg(
        F.count(F.lit(1)).alias("rows"),
        _count(satisfaction_violation()).alias("outside"),
        _count(F.col(score).isNull() | satisfaction_violation()).alias("gaps"),
    ).first()
    lines = [(table, "rows_before", "", found["rows"], None), (table, "violations", score, found["outside"], None)]
    data = fix_satisfaction_range(parsed)
    if found["gaps"] and found["gaps"] < found["rows"]:
        middle = medians(data, [score], accuracy=accuracy)[()][score]
        lines.append((table, "imputed", score, found["gaps"], f"median={middle:.1f}"))
        data = data.withColumn(score, F.coalesce(F.col(score).cast("double"), F.lit(middle)))
    lines.append((table, "rows_after", "", found["rows"], None))
    return Cleaned(data, _report(tickets, lines))


def clean_customers(customers: DataFrame, order: Sequence[str] = ("updated_at",)) -> Cleaned:
    """Parse the registration date, keep the last row of each customer by ``order``, fill defaults."""
    parsed = customers.withColumn("registration_date", parse_date("registration_date"))
    usable = [c for c in order if c in parsed.columns]
    rest = [c for c in parsed.columns if c not in ("customer_id", *usable)]
    single = keep_one_per_key(parsed, ["customer_id"], [*usable, *rest])
    data = with_defaults(
        single, "", {"customer_segment": "STANDARD", "preferred_category": "Unknown", "email_opt_in": 1}
    )
    if "email_opt_in" in data.columns:
        data = data.withColumn("email_opt_in", F.col("email_opt_in").cast("int"))
    def rows(df: DataFrame, step: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("affected_rows")).select(
            F.lit("dim_customers").alias("table_name"), F.lit(step).alias("step"), F.lit("").alias("column_name"),
            "affected_rows", F.lit(None).cast("string").alias("value"),
        )

    return Cleaned(data, rows(parsed, "rows_before").unionByName(rows(data.select("customer_id"), "rows_after")))
