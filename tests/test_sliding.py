"""Windows over one table of days against the rows of every window."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from keepwell.catalog.base import CUTOFF
from keepwell.operators import cohorts, features
from keepwell.session import settle
from keepwell.sources.retail import Retail

DAILY = [CUTOFF - timedelta(days=i) for i in range(70)]


@pytest.fixture(scope="module")
def tables(spark, folder):
    bundle = Retail(spark, folder).bundle()
    odd = bundle.orders.limit(40)
    # Gaps and a null customer among the orders.
    gaps = odd.withColumn("total_amount", F.lit(None).cast(odd.schema["total_amount"].dataType)).withColumn("customer_id", F.lit(None).cast(odd.schema["customer_id"].dataType))
    return bundle.having(orders=bundle.orders.unionByName(gaps.withColumn("order_date", F.lit(CUTOFF - timedelta(days=5)))))


def same(many, plain):
    assert many.columns == plain.columns
    assert [f.dataType for f in many.schema] == [f.dataType for f in plain.schema]
    got, want = ({(r["customer_id"], r["cutoff_date"]): r for r in df.collect()} for df in (many, plain))
    assert got.keys() == want.keys() and len(got) > 100
    for key, row in got.items():
        for own, other in zip(row, want[key]):
            assert own == (pytest.approx(other, rel=1e-9, abs=1e-9) if isinstance(other, float) else other), (row, want[key])


@pytest.mark.parametrize("iso_year", [False, True])
def test_orders(tables, monkeypatch, iso_year):
    new_year = [date(1998, 1, 20) - timedelta(days=i) for i in range(66)]
    for days in (DAILY, new_year):
        many = features.order_rollup(tables.orders, days, 90, 200, iso_year=iso_year)
        monkeypatch.setattr(features, "INLINE_COHORTS", 1000)
        plain = features.order_rollup(tables.orders, days, 90, 200, iso_year=iso_year)
        monkeypatch.setattr(features, "INLINE_COHORTS", cohorts.INLINE_COHORTS)
        same(many, plain)


def test_support_and_diversity(tables, monkeypatch):
    many = [features.support_features(tables.tickets, DAILY), features.category_diversity(tables.orders, tables.items, DAILY)]
    monkeypatch.setattr(features, "INLINE_COHORTS", 1000)
    plain = [features.support_features(tables.tickets, DAILY), features.category_diversity(tables.orders, tables.items, DAILY)]
    for a, b in zip(many, plain):
        same(a, b)


def test_orders_are_read_and_shuffled_once_for_a_year_of_days(spark, tables):
    year = [CUTOFF - timedelta(days=i) for i in range(365)]
    found = features.order_rollup(settle(tables.orders), year, 90, 30)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan.split("HashAggregate")[0]
    assert plan.count("Exchange hashpartitioning") <= 2  # days, then days of a customer
    assert found.select("cutoff_date").distinct().count() > 300
