"""Daily sketches against the rows they stand for."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators.decisions import stability_index
from keepwell.session import settle
from keepwell.sources import sketches

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    rows = spark.range(40_000).select(
        F.date_add(F.lit(START), (F.col("id") % 40).cast("int")).alias("day_of"), (F.col("id") % 3).cast("string").alias("segment"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7.0 + F.when(F.col("id") % 40 >= 20, 6000).otherwise(0)).alias("amount"),
        (F.xxhash64("id") % 9000).alias("customer"),
    )
    return settle(rows)


@pytest.fixture(scope="module")
def path(spark, facts, tmp_path_factory):
    home = f"file://{tmp_path_factory.mktemp('sketches')}/daily"
    daily = sketches.daily_sketches(facts, "day_of", ["amount"], ["customer"], ["segment"])
    sketches.write_sketches(daily, home)
    # The last days again: they replace themselves.
    sketches.write_sketches(daily.filter(F.col("day") >= F.lit(START + timedelta(days=35))), home)
    return home


def window(facts, first, last):
    return facts.filter(F.col("day_of").between(F.lit(START + timedelta(days=first)), F.lit(START + timedelta(days=last))))


@pytest.mark.parametrize("first,last", [(0, 39), (3, 11), (30, 39)])
def test_quantiles_and_distinct_counts_of_a_window(spark, facts, path, first, last):
    own = sketches.merged(spark, path, START + timedelta(days=first), START + timedelta(days=last))
    rows = window(facts, first, last)
    values = np.sort([r[0] for r in rows.select("amount").collect() if r[0] is not None])
    assert own.filter("kind = 'quantiles'").first()["rows"] == len(values)
    for r in sketches.quantiles_of(own, {"amount": [0.05, 0.25, 0.5, 0.9]}).collect():
        rank = np.searchsorted(values, r["value"], "right") / len(values)
        assert abs(rank - r["p"]) <= r["rank_error"] + 1 / len(values)
    (d,) = sketches.distinct_of(own).collect()
    true = rows.select("customer").distinct().count()
    assert abs(d["distinct_values"] - true) <= d["relative_error"] * true


def test_groups_and_fences(spark, facts, path):
    own = sketches.merged(spark, path, START, START + timedelta(days=39), ["segment"])
    direct = facts.groupBy("segment").agg(F.expr("percentile(amount, array(0.25D, 0.75D))").alias("q"))
    both = sketches.fences_of(own, ["amount"], 1.5, ["segment"]).join(direct, "segment").collect()
    assert len(both) == 3
    for r in both:
        reach = 1.5 * (r["q"][1] - r["q"][0])
        assert r["low"] == pytest.approx(r["q"][0] - reach, abs=0.1 * reach) and r["high"] == pytest.approx(r["q"][1] + reach, abs=0.1 * reach)


def test_drift_from_two_stored_ranges(spark, facts, path):
    early, late, same = (sketches.merged(spark, path, START + timedelta(days=a), START + timedelta(days=b)) for a, b in ((0, 19), (20, 39), (5, 19)))
    moved = sketches.drift(early, late, ["amount"]).first()
    exact = stability_index(window(facts, 0, 19), window(facts, 20, 39), ["amount"]).first()
    assert moved["retrain"] and exact["retrain"] and moved["psi"] == pytest.approx(exact["psi"], rel=0.1)
    still = sketches.drift(early, same, ["amount"]).first()
    assert not still["retrain"] and still["psi"] < 0.01
    assert moved["share_error"] == pytest.approx(sketches.rank_error(sketches.QUANTILE_K, True))


def test_months(spark, facts, tmp_path):
    home = f"file://{tmp_path}/monthly"
    sketches.write_sketches(sketches.daily_sketches(facts, "day_of", ["amount"], grain="month"), home)
    assert spark.read.parquet(home).select("day").distinct().count() == 2
    assert sketches.merged(spark, home, START, date(2024, 1, 31)).first()["rows"] == window(facts, 0, 30).filter("amount IS NOT NULL").count()
    with pytest.raises(ValueError, match="grain"):
        sketches.daily_sketches(facts, "day_of", ["amount"], grain="year")


def test_empty_and_blank(spark, facts, path):
    none = sketches.merged(spark, path, date(2030, 1, 1), date(2030, 2, 1))
    assert none.count() == 0 and sketches.drift(none, none, ["amount"]).count() == 0
    blank = sketches.daily_sketches(facts.withColumn("amount", F.lit(None).cast("double")), "day_of", ["amount"])
    assert blank.count() == 0
    with pytest.raises(ValueError, match="no column"):
        sketches.daily_sketches(facts, "day_of")
