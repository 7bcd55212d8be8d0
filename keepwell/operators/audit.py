"""Data-quality audits: keys, orphans, fan-out, invariants, missing values, coverage and the Stop/Go gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.numeric import percent
from keepwell.operators.constraints import breaks
from keepwell.sources.schemas import Rule


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- keys ---------------------------------------------------------------------------------------------


# Rows of keys that one task groups, about.
GROUP_ROWS = 1_000_000


def _dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` partitioned by ``by``, with about ``GROUP_ROWS`` rows in a task however large the table is.

    Keys hardly repeat, so a grouping holds nearly every row: in a fixed number of partitions a task would hold more of them the
    larger the table. Tables that the session's shuffle partitions suffice for stay as they are.
    """
    parts = -(-df.count() // GROUP_ROWS)
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(parts, *by)


def _grouped(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))


def _grouped_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key of a table whose keys are expected to be unique."""
    return _grouped(_dealt(df.select(*key), key), key)


def key_counts(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicates of one table; composite keys are really counted."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    distinct = F.count(F.when(known, True))
    counted = _grouped_keys(df, key).agg(total.alias("total_rows"), distinct.alias("distinct_keys"))
    return counted.select(*_key_figures(table))


def _key_figures(table: str) -> list[Column]:
    repeats = F.col("total_rows") - F.col("distinct_keys")
    return [
        F.lit(table).alias("table_name"),
        F.col("total_rows"),
        F.col("distinct_keys"),
        repeats.alias("duplicate_keys"),
        percent(repeats, F.col("total_rows"), 4).alias("dup_rate_pct"),
    ]


def orphan_rows(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Child rows without a parent; a NULL reference has none."""
    keys = parent.select(F.col(parent_column or column).alias(column))
    return child.join(keys, column, "left_anti")


def _lost_rows() -> Column:
    lost = F.sum(F.when(F.col("_found").isNull(), F.col("_rows")).otherwise(0))
    return F.coalesce(lost, F.lit(0)).alias("orphan_rows")


def _matched(totals: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Rows per reference value with ``_found``, null without a parent."""
    keys = parent.select(F.col(column).alias("_key"), F.lit(True).alias("_found")).distinct()
    return totals.join(keys, totals[column] == keys["_key"], "left")


def _counts_in_one_pass(child: DataFrame, parent: DataFrame, table: str, key: Sequence[str], column: str) -> DataFrame:
    """``key_counts`` and ``orphan_counts`` of a table whose key holds the reference: rows are shuffled by the reference only."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    keys = _grouped(_dealt(child.select(*key), [column]), key)
    totals = keys.groupBy(column).agg(F.sum("_rows").alias("_rows"), F.count(F.when(known, True)).alias("_known"))
    counted = _matched(totals, parent, column).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("_known"), F.lit(0)).alias("distinct_keys"),
        _lost_rows(),
    )
    rate = percent(F.col("orphan_rows"), F.col("total_rows"), 4).alias("orphan_rate_pct")
    return counted.select(*_key_figures(table), "orphan_rows", rate)


def orphan_counts(child: DataFrame, parent: DataFrame, table: str, column: str) -> DataFrame:
    """Orphans counted per reference value: the anti join sees each value once, however often it is used."""
    return _matched(_grouped(child, [column]), parent, column).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked_rows"), _lost_rows()
    ).select(
        F.lit(table).alias("table_name"),
        "checked_rows",
        "orphan_rows",
        percent(F.col("orphan_rows"), F.col("checked_rows"), 4).alias("orphan_rate_pct"),
    )


def key_integrity(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    parents: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """One row per table: duplicates of its key and orphans of its (first listed) parent."""
    checked, lost, whole = set(), [], {}
    for child, column, parent in parents:
        if child in tables and parent in tables and child not in checked:
            checked.add(child)
            if column in keys[child]:
                whole[child] = _counts_in_one_pass(tables[child], tables[parent], child, keys[child], column)
            else:
                lost.append(orphan_counts(tables[child], tables[parent], child, column).drop("checked_rows"))
    apart = [key_counts(df, name, keys[name]) for name, df in tables.items() if name not in whole]
    if not apart:
        return stack(list(whole.values()))
    counts = stack(apart)
    if lost:
        # One row per table on both sides.
        counts = counts.join(F.broadcast(stack(lost)), "table_name", "left")
    else:
        counts = counts.withColumns({
            "orphan_rows": F.lit(None).cast("bigint"), "orphan_rate_pct": F.lit(None).cast("double")
        })
    return stack([counts, *whole.values()])


def duplicate_keys(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once."""
    return (
        _grouped_keys(df, key)
        .filter(F.col("_rows") > 1)
        .select(F.lit(table).alias("table_name"), F.concat_ws("|", *key).alias("key_value"), F.col("_rows").alias("cnt"))
    )


# -- joins --------------------------------------------------------------------------------------------


def explosion_factor(left: DataFrame, right: DataFrame, name: str, empty: float | None = None) -> DataFrame:
    """Right rows per left row. An empty left side counts as one row, or gives ``empty`` when that is set."""
    n_right = right.agg(F.count(F.lit(1))).scalar()
    counted = left.agg(F.count(F.lit(1)).alias("n_left")).withColumn("n_right", n_right)
    quotient = F.col("n_right").cast("double") / F.greatest(F.col("n_left"), F.lit(1)).cast("double")
    factor = F.round(quotient, 3)
    if empty is not None:
        factor = F.when(F.col("n_left") == 0, F.lit(empty)).otherwise(factor)
    return counted.select(F.lit(name).alias("join_name"), "n_left", "n_right", factor.alias("explosion_factor"))


def join_fanout(left: DataFrame, right: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of the inner join per left row, from the counts per key; the join itself is not built."""
    a = left.groupBy(column).agg(F.count(F.lit(1)).alias("_l"))
    b = right.groupBy(column).agg(F.count(F.lit(1)).alias("_r"))
    joined = a.join(b, column, "left").agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum(F.col("_l") * F.col("_r")), F.lit(0)).alias("n_joined"),
    )
    factor = F.round(F.col("n_joined").cast("double") / F.greatest("n_left", F.lit(1)).cast("double"), 3)
    return joined.select(F.lit(name).alias("join_name"), "n_left", "n_joined", factor.alias("fanout"))


# -- values -------------------------------------------------------------------------------------------

# The audited invariants. Rows where the guarded date is absent are not checked.
INVARIANTS = (
    ("fact_orders", Rule("delivery_date >= order_date", "delivery_date >= order_date"), "delivery_date"),
    (
        "fact_support_tickets",
        Rule("resolved_date >= created_date (support)", "resolved_date >= created_date"),
        "resolved_date",
    ),
    ("fact_orders", Rule("total_amount >= 0 (orders)", "total_amount >= 0"), None),
)


def business_invariants(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One pass per table; (invariant_name, total_checked, violations, violation_rate_pct)."""
    frames = []
    for table in dict.fromkeys(t for t, _, _ in INVARIANTS):
        mine = [(rule, guard) for t, rule, guard in INVARIANTS if t == table]
        counts = []
        for i, (rule, guard) in enumerate(mine):
            checked = F.col(guard).isNotNull() if guard else F.lit(True)
            counts += [
                F.count(F.when(checked, True)).alias(f"_c{i}"),
                F.count(F.when(checked & breaks(rule), True)).alias(f"_v{i}"),
            ]
        cells = [
            F.struct(
                F.lit(rule.name).alias("invariant_name"),
                F.col(f"_c{i}").alias("total_checked"),
                F.col(f"_v{i}").alias("violations"),
                percent(F.col(f"_v{i}"), F.col(f"_c{i}"), 4).alias("violation_rate_pct"),
            )
            for i, (rule, _) in enumerate(mine)
        ]
        frames.append(
            tables[table].agg(*counts).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
        )
    return stack(frames)


# Kind of absence and treatment of the features that are known to have gaps, and of the others.
MISSING_KINDS = {
    "avg_satisfaction_score": ("MNAR", "Imputación por mediana + indicador binario 'has_csat'"),
    "avg_delivery_days": ("MAR", "Imputación por mediana estratificada por order_status"),
    "return_rate": ("MCAR", "Imputación por media de la distribución observada"),
    "trend_slope_30d": ("MAR", "Imputación por 0.0 (sin tendencia detectable)"),
}
DEFAULT_KIND = ("MCAR (default)", "Imputación por mediana/moda")
NO_KIND = ("—", "No requiere")


def missingness(matrix: DataFrame, threshold: float = 0.40, skip: Sequence[str] = ("churn_label",)) -> DataFrame:
    """(column_name, null_count, null_pct, missing_type, treatment, over_threshold); one pass for all columns."""
    columns = [c for c in matrix.columns if c not in skip]
    counted = matrix.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), True)).alias(c) for c in columns],
    )

    def kind(column: str, part: int) -> Column:
        if column in MISSING_KINDS:
            return F.lit(MISSING_KINDS[column][part])
        return F.when(F.col(column) > 0, DEFAULT_KIND[part]).otherwise(NO_KIND[part])

    cells = []
    for c in columns:
        pct = percent(F.col(c), F.col("_rows"), 2)
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("null_count"),
                pct.alias("null_pct"),
                kind(c, 0).alias("missing_type"),
                kind(c, 1).alias("treatment"),
                (F.col(c) > threshold * F.col("_rows")).alias("over_threshold"),
            )
        )
    return counted.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def missing_ranking(report: DataFrame) -> DataFrame:
    return report.filter(F.col("null_pct") > 0).select("column_name", "null_pct", "missing_type").orderBy(
        "null_pct", "column_name"
    )


# -- gates --------------------------------------------------------------------------------------------

# Status texts.
COVERAGE_GO = "GO — Cobertura 100%"
COVERAGE_STOP = "STOP — Clientes sin features"


def feature_coverage(labels: DataFrame, store: DataFrame) -> DataFrame:
    """Labelled customers with and without stored features at the same cutoff."""
    key = ["customer_id", "cutoff_date"]
    stored = store.select(*key).distinct().withColumn("_stored", F.lit(True))
    per_customer = (
        labels.select(*key).join(stored, key, "left").groupBy("customer_id").agg(F.max("_stored").alias("_stored"))
    )
    counted = per_customer.agg(
        F.count("customer_id").alias("customers_with_labels"),
        F.count(F.when(F.col("_stored") & F.col("customer_id").isNotNull(), True)).alias("customers_with_features"),
    )
    have, all_ = F.col("customers_with_features"), F.col("customers_with_labels")
    return counted.select(
        "customers_with_labels",
        "customers_with_features",
        (all_ - have).alias("customers_without_features"),
        percent(have, all_, 2).alias("coverage_pct"),
        F.when(have == all_, COVERAGE_GO).otherwise(COVERAGE_STOP).alias("stop_go_status"),
    )


# The three checks and what they ask for.
CHECKS = {
    "Key Integrity": "dup_rate=0% en todas las tablas, orphan_rate=0%",
    "Business Invariants": "Sin violaciones temporales ni de integridad de valores",
    "Feature Coverage": "Todos los clientes con etiquetas tienen features calculadas",
}


def stop_go_summary(keys: DataFrame, invariants: DataFrame, coverage: DataFrame) -> DataFrame:
    """PASS or FAIL of the three checks, decided on counts: a rounded rate hides a few rows of a large table."""

    def verdict(df: DataFrame, name: str, passed: Column) -> DataFrame:
        return df.agg(passed.alias("_ok")).select(
            F.lit(name).alias("check_name"),
            F.when(F.col("_ok"), "PASS").otherwise("FAIL").alias("status"),
            F.lit(CHECKS[name]).alias("description"),
        )

    no_orphans = F.coalesce(F.sum("orphan_rows"), F.lit(0)) == 0
    covered = (F.max("customers_without_features") == 0) & (F.max("customers_with_labels") > 0)
    return stack([
        verdict(keys, "Key Integrity", (F.sum("duplicate_keys") == 0) & no_orphans),
        verdict(invariants, "Business Invariants", F.sum("violations") == 0),
        verdict(coverage, "Feature Coverage", covered),
    ])


def stop_go_reasons(
    keys: DataFrame,
    missing: DataFrame,
    matrix: DataFrame,
    churn_range: tuple[float, float] = (0.01, 0.50),
) -> DataFrame:
    """(criterion, subject, amount) for each reason to stop; no row means go. Counts decide, rates are shown."""
    duplicates = keys.filter(F.col("duplicate_keys") > 0).select(
        F.lit("duplicates").alias("criterion"), F.col("table_name").alias("subject"), F.col("dup_rate_pct").alias("amount")
    )
    orphans = keys.filter(F.col("orphan_rows") > 0).select(
        F.lit("orphans").alias("criterion"), F.col("table_name").alias("subject"), F.col("orphan_rate_pct").alias("amount")
    )
    sparse = missing.filter("over_threshold").select(
        F.lit("nulls").alias("criterion"), F.col("column_name").alias("subject"), F.col("null_pct").alias("amount")
    )
    facts = matrix.agg(
        F.count(F.when(F.col("avg_delivery_days") < 0, True)).cast("double").alias("_negative"),
        F.coalesce(F.avg("churn_label"), F.lit(0.0)).alias("_churn"),
    )
    low, high = churn_range
    values = facts.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("negative delivery").alias("criterion"), F.lit("avg_delivery_days").alias("subject"),
                    F.col("_negative").alias("amount"), (F.col("_negative") > 0).alias("_stop"),
                ),
                F.struct(
                    F.lit("churn rate").alias("criterion"), F.lit("churn_label").alias("subject"),
                    F.round("_churn", 6).alias("amount"), (~F.col("_churn").between(low, high)).alias("_stop"),
                ),
            )
        ).alias("cell")
    ).select("cell.*")
    return stack([duplicates, orphans, sparse, values.filter("_stop").drop("_stop")])


class StopGoError(RuntimeError):
    """The data did not pass the gate."""


def gate(reasons: DataFrame, on_stop: str = "raise") -> str:
    """GO, or STOP; ``on_stop="raise"`` refuses to go on. There are at most a few reasons per table and column."""
    rows = reasons.collect()
    if rows and on_stop == "raise":
        raise StopGoError("; ".join(f"{r['criterion']}: {r['subject']} ({r['amount']})" for r in rows))
    return "STOP" if rows else "GO"
