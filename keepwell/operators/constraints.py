"""Row rules: audit, filter, defaults, and the validation of scoring requests."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.sources.schemas import DEFAULTS, RULES, SEGMENTS, Rule


def breaks(rule: Rule) -> Column:
    return F.coalesce(~F.expr(rule.holds), F.lit(False))


def constraint_audit(df: DataFrame, table: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """(table_name, rule_name, rows_checked, violations) for every rule, in one pass over the table."""
    rules = RULES[table] if rules is None else rules
    rows = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(breaks(rule), True)).alias(f"_broken_{i}") for i, rule in enumerate(rules)],
    )
    cells = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule.name).alias("rule_name"),
            F.col("_rows").alias("rows_checked"),
            F.col(f"_broken_{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return rows.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(breaks(rule), F.lit(rule.name)) for rule in rules]), lambda name: name.isNotNull()
    )
    judged = df.withColumn("broken_rules", broken)
    accepted = judged.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return accepted, judged.filter(F.size("broken_rules") > 0)


def with_defaults(df: DataFrame, table: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    values = DEFAULTS[table] if defaults is None else defaults
    return df.withColumns({
        column: F.coalesce(F.col(column), F.lit(value)) for column, value in values.items() if column in df.columns
    })


def keep_one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by ``order``.

    An aggregation rather than a window: repeats of one key collapse on the map side.
    """
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if keep == "last" else F.min_by
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(chosen).select(*key, "_row.*").select(*df.columns)


def insert_if_absent(
    target: DataFrame,
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    rules: Sequence[Rule] = (),
    not_null: Sequence[str] = (),
) -> DataFrame:
    """The rows an "insert or ignore" would add: valid, first of their key, and with a key not in the target."""
    for column in not_null:
        rows = rows.filter(F.col(column).isNotNull())
    valid = split_by_rules(rows, rules)[0] if rules else rows
    first = keep_one_per_key(valid, key, order, keep="first")
    return first.join(target.select(*key), list(key), "left_anti").select(*rows.columns)


# Accepted ranges of a scoring request. None leaves a side open.
REQUEST_RANGES: dict[str, tuple[float | None, float | None]] = {
    "recency_days": (0, 3650),
    "frequency_orders": (0, 10000),
    "monetary_total": (0, None),
    "monetary_avg_order": (0, None),
    "category_diversity": (0, 50),
    "support_tickets_90d": (0, None),
    "avg_satisfaction_score": (1.0, 5.0),
    "avg_delivery_days": (0, 365),
    "return_rate": (0.0, 1.0),
    "days_since_registration": (0, None),
}
REQUEST_OPTIONAL = ("avg_satisfaction_score", "avg_delivery_days")
REQUEST_DEFAULTS = {
    "trend_slope_30d": 0.0,
    "support_tickets_90d": 0,
    "return_rate": 0.0,
    "preferred_category": "Unknown",
    "customer_segment": "STANDARD",
}
REQUEST_REQUIRED = (
    "customer_id", "recency_days", "frequency_orders", "monetary_total", "monetary_avg_order",
    "category_diversity", "days_since_registration",
)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("no rows to score")


def validate_requests(df: DataFrame, segments: Sequence[str] = SEGMENTS) -> DataFrame:
    """Requests with defaults filled in and ``errors``, the sorted names of the fields out of range or absent."""
    require_columns(df, REQUEST_REQUIRED)
    absent = {
        **{c: F.lit(v) for c, v in REQUEST_DEFAULTS.items() if c not in df.columns},
        **{c: F.lit(None).cast("double") for c in REQUEST_OPTIONAL if c not in df.columns},
    }
    filled = df.withColumns(absent) if absent else df
    filled = with_defaults(filled, "", REQUEST_DEFAULTS)
    checks = {}
    for name, (low, high) in REQUEST_RANGES.items():
        value = F.col(name)
        wrong = F.lit(False) if name in REQUEST_OPTIONAL else value.isNull()
        if low is not None:
            wrong = wrong | (value < low)
        if high is not None:
            wrong = wrong | (value > high)
        checks[name] = wrong
    checks["customer_id"] = F.col("customer_id").isNull()
    checks["customer_segment"] = ~F.col("customer_segment").isin(*segments)
    marks = [F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)) for name, wrong in sorted(checks.items())]
    return filled.withColumn("errors", F.filter(F.array(*marks), lambda mark: mark.isNotNull()))
