"""Windows that end on many cutoffs, from one table of days.

Rows are summed by customer and day first, on the map side too, so a customer reaches the shuffle with one row per day and task. The
days of a customer, which the span of all windows bounds, come together in one row. There the value of a window is the difference of two
prefix sums, and its last day the last one before the window's end. No row is copied for the cutoffs that see it: orders are read and
shuffled once, however many cutoffs there are.

Prefix sums of amounts are in extended precision, so the differences are as good as sums of the window alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.functions.dates import A_MONDAY

_ZERO = date(1970, 1, 1)
# Room for the days of one customer in a search key, before and after 1970.
_SPAN, _SHIFT = 1 << 21, 1 << 20
# Windows that are worked on together.
PAIRS = 1 << 16


def _day(value: date) -> int:
    return (value - _ZERO).days


def week_slots(cutoffs: Sequence[date], days: int, iso_year: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First day, last day and number of each part of a week of each window, in the order in which weeks are listed.

    Weeks are cut at New Year and ordered by year * 100 + ISO week of the part; ``iso_year`` gives both parts of a week one number
    and keeps calendar order. Missing parts have their last day before the first.
    """
    listed = []
    for cutoff in cutoffs:
        start = cutoff - timedelta(days=days)
        own = []
        monday = start - timedelta(days=start.weekday())
        week = 0
        while monday <= cutoff:
            first, last = max(start, monday), min(cutoff, monday + timedelta(days=6))
            parts = [(first, last)] if first.year == last.year else [(first, date(first.year, 12, 31)), (date(last.year, 1, 1), last)]
            for a, b in parts:
                own.append((week if iso_year else a.year * 100 + monday.isocalendar().week, _day(a), _day(b)))
            monday += timedelta(days=7)
            week += 1
        listed.append(sorted(own))
    width = max(map(len, listed))
    padded = np.array([[*own, *[(-1, 0, -1)] * (width - len(own))] for own in listed], np.int64)
    return padded[..., 1], padded[..., 2], padded[..., 0]


class _Days:
    """The days of some customers, and windows over them."""

    def __init__(self, batch: pa.RecordBatch, columns: Mapping[str, bool]):
        """``columns`` tells for each column whether it is of whole numbers."""
        listed = batch.column("days")
        fields = listed.flatten()
        sizes = np.diff(listed.offsets.to_numpy())
        customer = np.repeat(np.arange(batch.num_rows, dtype=np.int64), sizes)
        self.day = fields.field("day").to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = customer * _SPAN + self.day + _SHIFT
        self.prefix = {}
        for name, whole in columns.items():
            values = fields.field(name).fill_null(0).to_numpy(zero_copy_only=False)
            self.prefix[name] = np.concatenate(([0], np.cumsum(values.astype(np.int64 if whole else np.longdouble))))

    def before(self, customer: np.ndarray, day: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(self.keys, customer * _SPAN + day + _SHIFT, side)

    def sums(self, name: str, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        own = self.prefix[name]
        return own[high] - own[low]


def _by_customer(slices: DataFrame) -> DataFrame:
    """One row per customer with its ``days``, sorted."""
    others = [c for c in slices.columns if c not in ("customer_id", "day")]
    return slices.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("day", *others))).alias("days"))


def _windows(slices: DataFrame, cutoffs: Sequence[date], whole: Mapping[str, bool], out: str, measure) -> DataFrame:
    """``measure(days, customer, cutoff number, cutoff day)`` gives for windows the mask of those kept and the columns of ``out``."""
    ends = np.array([_day(c) for c in cutoffs], np.int64)
    kind = slices.schema["customer_id"].dataType.simpleString()
    fields = [f.split() for f in out.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "date": pa.date32()}

    def run(batches):
        step = max(1, PAIRS // len(ends))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(at, step)]) for c in batch.columns], batch.schema.names)
                days = _Days(part, whole)
                customer = np.repeat(np.arange(part.num_rows, dtype=np.int64), len(ends))
                number = np.tile(np.arange(len(ends)), part.num_rows)
                kept, columns = measure(days, customer, number, ends[number])
                told = [
                    part.column("customer_id").take(pa.array(customer[kept])), pa.array(ends[number[kept]].astype(np.int32)).cast(pa.date32())
                ]
                for name, form in fields:
                    values, known = columns[name]
                    told.append(pa.array(values.astype(np.float64), mask=~known).cast(types[form], safe=False) if form == "double"
                                else pa.array(values.astype(np.int64), mask=~known).cast(pa.int32() if form == "date" else types[form]).cast(types[form]))
                yield pa.RecordBatch.from_arrays(told, ["customer_id", "cutoff_date", *[f[0] for f in fields]])

    return _by_customer(slices).mapInArrow(run, f"customer_id {kind}, cutoff_date date, {out}")


def _spanned(df: DataFrame, day: str, cutoffs: Sequence[date], back: int, ahead: int = 0) -> DataFrame:
    first, last = min(cutoffs) - timedelta(days=back), max(cutoffs) + timedelta(days=ahead)
    return df.filter(F.col(day).between(F.lit(first), F.lit(last)))


def _number(day: str) -> Column:
    return F.datediff(F.col(day), F.lit(_ZERO)).alias("day")


def sliding_orders(
    orders: DataFrame, cutoffs: Sequence[date], observation_days: int, prediction_days: int | None, iso_year: bool,
    completed: str, returned: str,
) -> DataFrame:
    """All order features and label columns per customer and cutoff, for customers with an order in the window."""
    cutoffs, back, ahead = sorted(set(cutoffs)), observation_days, prediction_days or 0
    done = F.col("order_status") == completed
    amount = F.col("total_amount").cast("double")
    delivery = F.datediff(F.col("delivery_date"), F.col("order_date"))
    slices = _spanned(orders, "order_date", cutoffs, back, ahead).groupBy("customer_id", _number("order_date")).agg(
        F.count(F.lit(1)).alias("seen"), F.count(F.when(done, True)).alias("done"), F.count(F.when(done, F.col("order_id"))).alias("named"),
        F.count(F.when(done, amount)).alias("paid"), F.sum(F.when(done, amount)).alias("spent"),
        F.count(F.when(done, delivery)).alias("delivered"), F.sum(F.when(done, delivery).cast("long")).alias("waited"),
        F.count(F.when(F.col("order_status") == returned, True)).alias("returned"),
    )
    firsts, lasts, weeks = week_slots(cutoffs, back, iso_year)

    def measure(days, customer, number, end):
        low, high = days.before(customer, end - back, "left"), days.before(customer, end, "right")
        seen = days.sums("seen", low, high)
        kept = seen > 0
        customer, number, end, low, high, seen = (x[kept] for x in (customer, number, end, low, high, seen))
        total = {name: days.sums(name, low, high) for name in days.prefix}
        all_known = np.ones(len(seen), bool)
        # Index of the last day with a completed order, up to each day.
        some = np.diff(days.prefix["done"]) > 0
        running = np.maximum.accumulate(np.where(some, np.arange(len(some)), -1)) if len(some) else np.empty(0, np.int64)
        last = running[high - 1] if len(high) else high
        any_done = total["done"] > 0
        mean = total["spent"] / np.maximum(total["paid"], 1)
        own = number[:, None]
        left = days.before(customer[:, None], firsts[own[:, 0]], "left")
        right = np.maximum(days.before(customer[:, None], lasts[own[:, 0]], "right"), left)
        spent, present = days.sums("spent", left, right), days.sums("done", left, right) > 0
        if iso_year and firsts.shape[1] > 1:
            # Two parts of a week lie side by side and count as one.
            same = weeks[own[:, 0]][:, 1:] == weeks[own[:, 0]][:, :-1]
            spent[:, :-1] += np.where(same, spent[:, 1:], 0)
            present[:, :-1] |= same & present[:, 1:]
            present[:, 1:] &= ~same
        size = present.sum(axis=1)
        place = np.cumsum(present, axis=1) - 1 - (size[:, None] - 1) / 2
        spread = size * (size.astype(np.float64) ** 2 - 1) / 12
        slope = np.where(size >= 2, np.where(present, spent * place, 0).sum(axis=1) / np.where(size >= 2, spread, 1), 0)
        later = days.sums("seen", high, days.before(customer, end + ahead, "right"))
        return kept, {
            "recency_days": (end - days.day[np.maximum(last, 0)] if len(end) else end, any_done),
            "frequency_orders": (total["named"], total["named"] > 0),
            "monetary_total": (total["spent"], total["paid"] > 0),
            "monetary_avg_order": (mean, total["paid"] > 0),
            "spending_intensity": (total["spent"] / float(back), total["paid"] > 0),
            "trend_slope_30d": (slope, any_done),
            "avg_delivery_days": (total["waited"] / np.maximum(total["delivered"], 1), total["delivered"] > 0),
            "return_rate": (total["returned"] / np.maximum(seen, 1), all_known),
            "observation_start": (end - back, all_known),
            "prediction_end": (end + ahead, all_known),
            "churn_label": ((later == 0).astype(np.int64), all_known),
            "orders_in_obs_window": (seen, all_known),
            "orders_in_pred_window": (later, all_known),
            "last_order_date": (days.day[high - 1] if len(high) else high, all_known),
        }

    out = (
        "recency_days int, frequency_orders long, monetary_total double, monetary_avg_order double, spending_intensity double, "
        "trend_slope_30d double, avg_delivery_days double, return_rate double, observation_start date, prediction_end date, "
        "churn_label int, orders_in_obs_window long, orders_in_pred_window long, last_order_date date"
    )
    whole = {c: c != "spent" for c in ("seen", "done", "named", "paid", "spent", "delivered", "waited", "returned")}
    return _windows(slices, cutoffs, whole, out, measure)


def sliding_support(tickets: DataFrame, cutoffs: Sequence[date], observation_days: int) -> DataFrame:
    """Tickets and their mean satisfaction per customer and cutoff, for customers with a ticket in the window."""
    cutoffs = sorted(set(cutoffs))
    score = F.col("satisfaction_score").cast("double")
    slices = _spanned(tickets, "created_date", cutoffs, observation_days).groupBy("customer_id", _number("created_date")).agg(
        F.count(F.lit(1)).alias("seen"), F.count("ticket_id").alias("tickets"), F.count(score).alias("rated"), F.sum(score).alias("score")
    )

    def measure(days, customer, number, end):
        low, high = days.before(customer, end - observation_days, "left"), days.before(customer, end, "right")
        kept = days.sums("seen", low, high) > 0
        low, high = low[kept], high[kept]
        rated = days.sums("rated", low, high)
        return kept, {
            "support_tickets_90d": (days.sums("tickets", low, high), np.ones(len(low), bool)),
            "avg_satisfaction_score": (days.sums("score", low, high) / np.maximum(rated, 1), rated > 0),
        }

    whole = {c: c != "score" for c in ("seen", "tickets", "rated", "score")}
    return _windows(slices, cutoffs, whole, "support_tickets_90d long, avg_satisfaction_score double", measure)


def sliding_diversity(done: DataFrame, categories: DataFrame | None, cutoffs: Sequence[date], observation_days: int) -> DataFrame:
    """Distinct categories of the completed orders ``done`` per customer and cutoff; ``categories`` by order, or a column of ``done``.

    A category counts from a day on which it was bought until its window has passed or it was bought again, so each day of a
    category adds one at its day and takes one away behind; the number of categories at a cutoff is the sum so far.
    """
    cutoffs, back = sorted(set(cutoffs)), observation_days
    near = _spanned(done, "order_date", cutoffs, back)
    held = near if categories is None else near.join(categories, "order_id", "left")
    bought = held.select("customer_id", _number("order_date"), F.explode("categories").alias("category")).filter("category IS NOT NULL").distinct()
    again = F.lead("day").over(Window.partitionBy("customer_id", "category").orderBy("day"))
    until = F.least(F.col("day") + back + 1, F.coalesce(again, F.col("day") + back + 1))
    spans = bought.select("customer_id", "day", until.alias("until"))
    zero = F.lit(0).cast("long")
    steps = (
        near.select("customer_id", _number("order_date"), F.lit(1).cast("long").alias("done"), zero.alias("step"))
        .unionByName(spans.select("customer_id", "day", zero.alias("done"), F.lit(1).cast("long").alias("step")))
        .unionByName(spans.select("customer_id", F.col("until").alias("day"), zero.alias("done"), F.lit(-1).cast("long").alias("step")))
    )
    slices = steps.groupBy("customer_id", "day").agg(F.sum("done").alias("done"), F.sum("step").alias("step"))

    def measure(days, customer, number, end):
        low, high = days.before(customer, end - back, "left"), days.before(customer, end, "right")
        kept = days.sums("done", low, high) > 0
        first = days.before(customer, np.full_like(end, -_SHIFT), "left")
        return kept, {"category_diversity": (days.sums("step", first[kept], high[kept]), np.ones(int(kept.sum()), bool))}

    return _windows(slices, cutoffs, {"done": True, "step": True}, "category_diversity long", measure)
