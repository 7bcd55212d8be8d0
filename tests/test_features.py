from datetime import date

import pytest
from pyspark.sql import functions as F

import star
from keepwell.operators import features as feats
from keepwell.params import MATRIX_NUMERIC, Params
from keepwell.plans.matrix import assemble, feature_matrix
from keepwell.plans.training import clean_bundle, labelled
from keepwell.sources.retail import CUTOFF, Retail
from keepwell.sources.tables import bounded

JAN = Params(cutoff=date(2023, 1, 1))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_features_do_not_see_the_future(spark):
    row = one(feature_matrix(star.leakage_bundle(spark), JAN))
    expected = {
        "frequency_orders": 1, "monetary_total": 100, "support_tickets_90d": 1, "recency_days": 2,
        "monetary_avg_order": 100, "spending_intensity": 100 / 90, "trend_slope_30d": 0.0, "category_diversity": 1,
        "avg_satisfaction_score": 5, "avg_delivery_days": 2, "return_rate": 0, "days_since_registration": 365,
        "churn_label": 0, "customer_segment": "STANDARD", "preferred_category": "Home",
    }
    assert {k: row[k] for k in expected} == pytest.approx(expected)


def test_future_rows_change_nothing(spark):
    bundle = star.leakage_bundle(spark)
    more = bundle.having(
        orders=bundle.orders.unionByName(
            star.orders(spark, ("O3", "C1", "2023-01-20", None, "RETURNED", 9), ("O4", "C9", "2023-02-01", None, "COMPLETED", 9))
        ),
        tickets=bundle.tickets.unionByName(star.tickets(spark, ("T3", "C1", "2023-03-01", 2))),
    )
    assert one(feature_matrix(bundle, JAN)) == one(feature_matrix(more, JAN))


def test_window_edges(spark):
    rows = star.orders(
        spark,
        ("A", "before", "2022-10-02", None, "COMPLETED", 1),  # 91 days back
        ("B", "first", "2022-10-03", None, "COMPLETED", 1),  # 90 days back
        ("C", "last", "2023-01-01", None, "COMPLETED", 1),
        ("D", "last", "2023-01-02", None, "COMPLETED", 1),
        ("E", "first", "2023-01-31", None, "CANCELLED", 1),  # 30 days ahead
        ("F", "before", "2023-01-31", None, "COMPLETED", 1),
        ("G", "late", "2022-12-01", None, "FAILED", 1),
        ("H", "late", "2023-02-01", None, "COMPLETED", 1),  # 31 days ahead
    )
    got = {
        r["customer_id"]: (r["churn_label"], r["orders_in_obs_window"], r["orders_in_pred_window"], r["last_order_date"])
        for r in feats.churn_labels(rows, [JAN.cutoff]).collect()
    }
    assert got == {
        "first": (0, 1, 1, date(2022, 10, 3)),
        "last": (0, 1, 1, date(2023, 1, 1)),
        "late": (1, 1, 0, date(2022, 12, 1)),
    }


def test_status_mix(spark):
    rows = star.orders(
        spark,
        ("A", "mixed", "2022-12-01", "2022-12-05", "COMPLETED", 10),
        ("B", "mixed", "2022-12-02", "2022-12-03", "RETURNED", 20),
        ("C", "mixed", "2022-12-03", None, "CANCELLED", 30),
        ("D", "cancelled", "2022-12-04", None, "CANCELLED", 40),
    )
    got = {r["customer_id"]: r for r in feats.order_rollup(rows, [JAN.cutoff]).collect()}
    mixed, cancelled = got["mixed"], got["cancelled"]
    assert (mixed["return_rate"], mixed["frequency_orders"], mixed["avg_delivery_days"]) == (pytest.approx(1 / 3), 1, 4)
    assert cancelled["return_rate"] == 0
    assert [cancelled[c] for c in feats.ORDER_FEATURES if c != "return_rate"] == [None] * 7


def slope_of(spark, rows, cutoff, **options):
    df = star.orders(spark, *[(f"O{i}", "C", d, None, "COMPLETED", a) for i, (d, a) in enumerate(rows)])
    return one(feats.order_rollup(df, [cutoff], **options))["trend_slope_30d"]


def test_slope_skips_weeks_without_orders(spark):
    cutoff = date(2023, 6, 30)
    weeks = [("2023-05-02", 1), ("2023-05-30", 1.5), ("2023-05-31", 1.5), ("2023-06-06", 2)]
    assert slope_of(spark, weeks, cutoff) == pytest.approx(0.5)
    assert slope_of(spark, weeks[:1], cutoff) == 0.0


def test_slope_week_key_around_new_year(spark):
    # Keys 202152, 202201 and, for Saturday 1 January in ISO week 52, 202252.
    rows = [("2021-12-31", 1.0), ("2022-01-01", 2.0), ("2022-01-05", 4.0)]
    cutoff = date(2022, 1, 10)
    assert slope_of(spark, rows, cutoff) == pytest.approx(0.5)  # 1, 4, 2
    assert slope_of(spark, rows, cutoff, iso_year=True) == pytest.approx(1.0)  # 1 + 2, 4


def test_order_without_lines_adds_no_category(spark):
    df = star.orders(spark, ("A", "C", "2022-12-01", None, "COMPLETED", 1), ("B", "D", "2022-12-01", None, "COMPLETED", 1))
    lines = star.items(spark, ("A", "x"), ("A", "y"), ("A", "x"), ("A", None))
    got = {r["customer_id"]: r["category_diversity"] for r in feats.category_diversity(df, lines, [JAN.cutoff]).collect()}
    assert got == {"C": 2, "D": 0}


def test_preferred_category_takes_the_first_name_among_equals(spark):
    df = star.orders(spark, ("A", "C", "2022-12-01", None, "FAILED", 1), ("B", "C", "2023-05-01", None, "COMPLETED", 1))
    lines = star.items(spark, ("A", "b"), ("A", "a"), ("B", "b"))
    row = one(feats.preferred_category(df, lines, JAN.cutoff))
    assert (row["preferred_category"], row["preferred_lines"]) == ("a", 1)


def test_imputation_and_its_options(spark):
    bundle = star.leakage_bundle(spark)
    people = [("C1", 10, 2), ("C2", 20, 4), ("C3", 60, 0)]
    rows = [
        (f"{c}-{i}", c, "2022-12-01", None, "COMPLETED", amount) for c, amount, _ in people for i in range(1)
    ] + [("X", "C4", "2022-12-01", None, "CANCELLED", 5)]
    seen = [(f"{c}-t{i}", c, "2022-12-01", 3) for c, _, n in people for i in range(n)]
    bundle = bundle.having(
        orders=star.orders(spark, *rows), tickets=star.tickets(spark, *seen), labels=None,
        customers=star.customers(spark, ("C1", "2022-01-01", None, None)),
    )
    got = {r["customer_id"]: r for r in feature_matrix(bundle, JAN).collect()}
    assert got["C4"]["monetary_total"] == 20  # median of 10, 20, 60
    assert got["C3"]["support_tickets_90d"] == 3  # median of 2, 4
    assert (got["C4"]["customer_segment"], got["C4"]["preferred_category"]) == ("STANDARD", "Unknown")
    zero = {r["customer_id"]: r["support_tickets_90d"] for r in feature_matrix(bundle, JAN, zero_tickets=True).collect()}
    assert zero == {"C1": 2, "C2": 4, "C3": 0, "C4": 0}


def test_several_cohorts_equal_each_alone(spark, folder):
    bundle = Retail(spark, folder).bundle()
    cutoffs = [date(1996, 12, 31), date(1997, 3, 31), CUTOFF]

    def canonical(df):
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()
        )

    together = canonical(assemble(bundle, Params(), cutoffs))
    alone = [row for c in cutoffs for row in canonical(assemble(bundle, Params(cutoff=c)))]
    assert together == sorted(alone)


def test_many_cohorts_by_join(spark, folder, monkeypatch):
    from keepwell.operators import cohorts

    orders = Retail(spark, folder).orders_head
    cutoffs = [date(1996, 12, 31), date(1997, 3, 31), CUTOFF]
    inline = sorted(map(tuple, feats.churn_labels(orders, cutoffs).collect()))
    monkeypatch.setattr(cohorts, "INLINE_COHORTS", 1)
    assert sorted(map(tuple, feats.churn_labels(orders, cutoffs).collect())) == inline
    monkeypatch.setattr(cohorts, "BROADCAST_DAYS", 0)
    assert sorted(map(tuple, feats.churn_labels(orders, cutoffs).collect())) == inline


def test_partitioning_does_not_change_features(spark, folder):
    bundle = Retail(spark, folder).bundle()
    params = Params(cutoff=CUTOFF)

    def rows(shaken):
        b = bundle.having(orders=bundle.orders.orderBy(F.rand(1)).repartition(7)) if shaken else bundle
        return sorted(
            tuple(round(r[c], 5) if r[c] is not None else None for c in ("customer_id", *MATRIX_NUMERIC))
            for r in assemble(b, params).collect()
        )

    assert rows(False) == rows(True)


def test_given_labels_set_the_population(spark):
    bundle = star.leakage_bundle(spark).having(labels=star.labels(spark, ("C1", "2023-01-01", 1), ("C7", "2022-06-30", 0)))
    known = bounded(bundle, JAN)
    assert [r["customer_id"] for r in assemble(known, JAN).collect()] == ["C1"]


def test_bounding_needs_labels(spark):
    with pytest.raises(ValueError):
        bounded(star.leakage_bundle(spark).having(labels=None), JAN)


def test_clean_bundle_draws_labels_before_bounding(spark):
    bundle = star.leakage_bundle(spark).having(labels=None)
    clean = clean_bundle(bundle, JAN).bundle
    assert clean.orders.count() == 1
    assert one(clean.labels)["churn_label"] == 0
    assert labelled(bundle, JAN).orders.count() == 2
