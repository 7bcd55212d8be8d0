"""Point-in-time customer features and churn labels.

Everything that comes from the orders is one conditional aggregation, so the order table is scanned and
shuffled once, after partial aggregation on the map side. A customer with very many orders therefore
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.dates import A_MONDAY, monday_number
from keepwell.functions.numeric import share, slope
from keepwell.operators.cohorts import INLINE_COHORTS, attach_cohorts
from keepwell.operators.sliding import sliding_diversity, sliding_orders, sliding_support

KEY = ["customer_id", "cutoff_date"]


def group_key(cutoffs: Sequence[date]) -> list[str]:
    """Grouping columns. A single cutoff is a constant: leaving it out keeps every part of the matrix
    partitioned by customer alone, so that the parts join without another shuffle."""
    return ["customer_id"] if len(set(cutoffs)) == 1 else KEY


def cutoff_of(cutoffs: Sequence[date]) -> Column:
    return F.lit(next(iter(cutoffs))) if len(set(cutoffs)) == 1 else F.col("cutoff_date")


COMPLETED = "COMPLETED"
RETURNED = "RETURNED"

ORDER_FEATURES = (
    "recency_days",
    "frequency_orders",
    "monetary_total",
    "monetary_avg_order",
    "spending_intensity",
    "trend_slope_30d",
    "avg_delivery_days",
    "return_rate",
)
LABEL_COLUMNS = (
    "observation_start",
    "prediction_end",
    "churn_label",
    "orders_in_obs_window",
    "orders_in_pred_window",
    "last_order_date",
)


def observed_orders(orders: DataFrame, cutoff: date, days: int) -> DataFrame:
    """Completed orders of the closed window ``[cutoff - days, cutoff]``."""
    start = cutoff - timedelta(days=days)
    return orders.filter(
        F.col("order_date").between(F.lit(start), F.lit(cutoff)) & (F.col("order_status") == COMPLETED)
    )


def _week_slots(cutoffs: Sequence[date], days: int) -> list[tuple[int, int]]:
    """(week, year) offsets from the window start that some window of the given cutoffs contains."""
    slots = set()
    for cutoff in cutoffs:
        start = cutoff - timedelta(days=days)
        for step in range(days + 1):
            day = start + timedelta(days=step)
            slots.add(((day - A_MONDAY).days // 7 - (start - A_MONDAY).days // 7, day.year - start.year))
    return sorted(slots)


def _slot(day: Column, start: Column) -> Column:
    """Number of the (week, year) offset of ``day`` from the window start."""
    return (monday_number(day) - monday_number(start)) * 10 + (F.year(day) - F.year(start))


def _weekly_sums(slots: list[tuple[int, int]]) -> list[Column]:
    """One conditional sum per slot; NULL where the week holds no completed order."""
    return [F.expr(f"sum(CASE WHEN _slot = {w * 10 + y} THEN _spent END) AS _week_{w}_{y}") for w, y in slots]


def _weeks(start: str, slots: list[tuple[int, int]], iso_year: bool) -> Column:
    """Sums of the weeks with orders, in the order of year * 100 + ISO week.

    ``iso_year`` puts the weeks in calendar order and joins the two parts of a week that spans New Year.
    """
    entries = []
    if iso_year:
        for week in sorted({w for w, _ in slots}):
            parts = [f"_week_{w}_{y}" for w, y in slots if w == week]
            known = " AND ".join(f"{part} IS NULL" for part in parts)
            total = " + ".join(f"coalesce({part}, 0D)" for part in parts)
            entries.append(f"struct({week} AS key, CASE WHEN NOT ({known}) THEN {total} END AS amount)")
    else:
        monday = f"date_sub({start}, weekday({start}))"
        for week, year in slots:
            key = f"(year({start}) + {year}) * 100 + weekofyear(date_add({monday}, {week * 7}))"
            entries.append(f"struct({key} AS key, _week_{week}_{year} AS amount)")
    listed = f"array_sort(filter(array({', '.join(entries)}), e -> e.amount IS NOT NULL))"
    return F.expr(f"transform({listed}, e -> e.amount)")


def order_rollup(
    orders: DataFrame,
    cutoffs: Sequence[date],
    observation_days: int = 90,
    prediction_days: int | None = None,
    censor_future_delivery: bool = False,
    iso_year: bool = False,
    parts: Sequence[str] = ORDER_FEATURES,
) -> DataFrame:
    """Order features per (customer, cutoff), and with ``prediction_days`` the label columns as well.

    Feature expressions are guarded by ``order_date <= cutoff_date``; only the prediction count looks past it.
    Customers without any order in the observation window have no row. More than ``INLINE_COHORTS`` cutoffs are windows over one
    table of days, unless ``censor_future_delivery`` makes the value of a day depend on the cutoff.
    """
    ahead = prediction_days or 0
    cutoffs = sorted(set(cutoffs))
    if len(cutoffs) > INLINE_COHORTS and not censor_future_delivery:
        columns = [c for c in ORDER_FEATURES if c in parts] + (list(LABEL_COLUMNS) if prediction_days is not None else [])
        return sliding_orders(orders, cutoffs, observation_days, prediction_days, iso_year, COMPLETED, RETURNED).select(*KEY, *columns)
    day, cutoff = F.col("order_date"), cutoff_of(cutoffs)
    start = F.date_sub(cutoff, observation_days)
    seen, done = F.col("_seen"), F.col("_done")
    amount = F.col("total_amount").cast("double")
    marks = {"_seen": day <= cutoff, "_done": (day <= cutoff) & (F.col("order_status") == COMPLETED)}

    aggregates = [F.count(F.when(seen, True)).alias("orders_in_obs_window")]
    finals: dict[str, Column] = {}
    if {"recency_days", "last_order_date"} & set(parts) or prediction_days is not None:
        aggregates += [
            F.max(F.when(done, day)).alias("_last_done"),
            F.max(F.when(seen, day)).alias("last_order_date"),
        ]
        finals["recency_days"] = F.datediff(cutoff, F.col("_last_done"))
    if "frequency_orders" in parts:
        aggregates.append(F.count(F.when(done, F.col("order_id"))).alias("_frequency"))
        finals["frequency_orders"] = F.expr("nullif(_frequency, 0)")
    if {"monetary_total", "monetary_avg_order", "spending_intensity"} & set(parts):
        aggregates += [
            F.sum(F.when(done, amount)).alias("monetary_total"),
            F.avg(F.when(done, amount)).alias("monetary_avg_order"),
        ]
        finals["monetary_total"] = F.col("monetary_total")
        finals["monetary_avg_order"] = F.col("monetary_avg_order")
        finals["spending_intensity"] = F.col("monetary_total") / float(observation_days)
    if "trend_slope_30d" in parts:
        slots = _week_slots(cutoffs, observation_days)
        marks["_slot"] = F.when(marks["_done"], _slot(day, start))
        marks["_spent"] = F.coalesce(amount, F.lit(0.0))
        aggregates += [*_weekly_sums(slots), F.max(done).alias("_any_done")]
        finals["trend_slope_30d"] = F.when(F.col("_any_done"), slope(F.col("_weeks")))
    if "avg_delivery_days" in parts:
        delivered = F.datediff(F.col("delivery_date"), day)
        known = done & (F.col("delivery_date") <= cutoff) if censor_future_delivery else done
        aggregates.append(F.avg(F.when(known, delivered)).alias("avg_delivery_days"))
        finals["avg_delivery_days"] = F.col("avg_delivery_days")
    if "return_rate" in parts:
        aggregates.append(F.count(F.when(seen & (F.col("order_status") == RETURNED), True)).alias("_returned"))
        finals["return_rate"] = share(F.col("_returned"), F.col("orders_in_obs_window"))
    columns = [finals[name].alias(name) for name in ORDER_FEATURES if name in parts and name in finals]

    if prediction_days is not None:
        aggregates.append(F.count(F.when(~seen, True)).alias("orders_in_pred_window"))
        columns += [
            start.alias("observation_start"),
            F.date_add(cutoff, prediction_days).alias("prediction_end"),
            (F.col("orders_in_pred_window") == 0).cast("int").alias("churn_label"),
            F.col("orders_in_obs_window"),
            F.col("orders_in_pred_window"),
            F.col("last_order_date"),
        ]

    near = attach_cohorts(orders, "order_date", cutoffs, observation_days, ahead).withColumns(marks)
    rolled = near.groupBy(*group_key(cutoffs)).agg(*aggregates).filter(F.col("orders_in_obs_window") > 0)
    if "trend_slope_30d" in parts:
        # A column of its own: the slope refers to the array several times.
        single = len(set(cutoffs)) == 1
        first = f"DATE '{cutoffs[0] - timedelta(days=observation_days)}'" if single else f"date_sub(cutoff_date, {observation_days})"
        rolled = rolled.withColumn("_weeks", _weeks(first, slots, iso_year))
    return rolled.select("customer_id", cutoff.alias("cutoff_date"), *columns)


def churn_labels(
    orders: DataFrame, cutoffs: Sequence[date], observation_days: int = 90, prediction_days: int = 30
) -> DataFrame:
    """Customers active in the observation window; label 1 when none of their orders follows in the prediction window."""
    return order_rollup(orders, cutoffs, observation_days, prediction_days, parts=()).select(*KEY, *LABEL_COLUMNS)


def order_categories(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The distinct categories of each of the given orders.

    The orders are the selective side: lines of other orders go before anything is grouped or shuffled by order.
    """
    near = items.select("order_id", "category").join(orders.select("order_id"), "order_id", "left_semi")
    return near.groupBy("order_id").agg(F.collect_set("category").alias("categories"))


def category_diversity(
    orders: DataFrame,
    items: DataFrame,
    cutoffs: Sequence[date],
    observation_days: int = 90,
    relative_error: float | None = None,
) -> DataFrame:
    """Distinct categories over the completed orders; an order without lines adds none.

    Orders that carry their ``categories`` need no lines.
    """
    carried = [c for c in ("categories",) if c in orders.columns]
    if len(set(cutoffs)) > INLINE_COHORTS and relative_error is None:
        done = orders.filter(F.col("order_status") == COMPLETED).select("order_id", "customer_id", "order_date", *carried)
        # Orders of no window need no lines.
        first, last = min(cutoffs) - timedelta(days=observation_days), max(cutoffs)
        near = done.filter(F.col("order_date").between(F.lit(first), F.lit(last)))
        return sliding_diversity(near, None if carried else order_categories(items, near), cutoffs, observation_days)
    done = attach_cohorts(
        orders.filter(F.col("order_status") == COMPLETED).select("order_id", "customer_id", "order_date", *carried),
        "order_date", cutoffs, observation_days,
    )
    if not carried:
        done = done.join(order_categories(items, done), "order_id", "left")
    seen = done.select(*KEY, F.explode_outer("categories").alias("category"))
    if relative_error:
        distinct = F.approx_count_distinct("category", relative_error)
    else:
        distinct = F.count_distinct("category")
    return (
        seen.groupBy(*group_key(cutoffs))
        .agg(distinct.alias("category_diversity"))
        .select("customer_id", cutoff_of(cutoffs).alias("cutoff_date"), "category_diversity")
    )


def support_features(tickets: DataFrame, cutoffs: Sequence[date], observation_days: int = 90) -> DataFrame:
    if len(set(cutoffs)) > INLINE_COHORTS:
        return sliding_support(tickets, cutoffs, observation_days)
    near = attach_cohorts(
        tickets.select("ticket_id", "customer_id", "created_date", "satisfaction_score"),
        "created_date", cutoffs, observation_days,
    )
    return (
        near.groupBy(*group_key(cutoffs))
        .agg(
            F.count("ticket_id").alias("support_tickets_90d"),
            F.avg(F.col("satisfaction_score").cast("double")).alias("avg_satisfaction_score"),
        )
        .select(
            "customer_id", cutoff_of(cutoffs).alias("cutoff_date"), "support_tickets_90d", "avg_satisfaction_score"
        )
    )


def tenure(customers: DataFrame, cutoff: date) -> DataFrame:
    return customers.select(
        "customer_id",
        F.datediff(F.lit(cutoff), F.col("registration_date")).alias("days_since_registration"),
    )


def preferred_category(orders: DataFrame, items: DataFrame, cutoff: date) -> DataFrame:
    """The category on most order lines up to the cutoff; the first by name among equals.

    The orders up to the cutoff pick their lines before these meet the catalogue or are grouped. Lines are counted per
    (order, category) before they meet the orders and per (customer, category) after, so no step holds more rows per customer
    than there are categories.
    """
    known = orders.filter(F.col("order_date") <= F.lit(cutoff)).select("order_id", "customer_id")
    near = items.select("order_id", "category").join(known.select("order_id"), "order_id", "left_semi")
    per_order = near.filter(F.col("category").isNotNull()).groupBy("order_id", "category").agg(F.count(F.lit(1)).alias("lines"))
    counted = (
        per_order.join(known, "order_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("lines").alias("lines"))
    )
    best = F.min(F.struct((-F.col("lines")).alias("rank"), F.col("category"), F.col("lines"))).alias("best")
    return counted.groupBy("customer_id").agg(best).select(
        "customer_id",
        F.col("best.category").alias("preferred_category"),
        F.col("best.lines").alias("preferred_lines"),
    )
