import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from keepwell.operators.quantiles import exact_quantiles, medians, quantiles

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def frame(spark, values, groups=None):
    rows = [(groups[i] if groups else "g", None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("sortable", [200_000, 20, 1])
@pytest.mark.parametrize("kind", ["normal", "heavy tail", "hot value", "few values"])
def test_against_numpy(spark, kind, sortable):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=400),
        "heavy tail": np.exp(rng.normal(size=400) * 8),
        "hot value": np.where(rng.random(400) < 0.4, 7.0, rng.normal(size=400) * 10),
        "few values": rng.integers(0, 3, 400).astype(float),
    }[kind]
    got = exact_quantiles(frame(spark, [*values, None]), {"x": PROBS}, sortable=sortable)[()]["x"]
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30))
def test_any_list(spark, values):
    got = exact_quantiles(frame(spark, values), {"x": [0.5]}, sortable=3)[()]["x"][0.5]
    assert got == pytest.approx(float(np.quantile(values, 0.5)), rel=1e-9, abs=1e-9)


def test_groups_and_absent_values(spark):
    df = frame(spark, [1, 2, 3, 10, None], ["a", "a", "a", "a", "b"])
    fit = exact_quantiles(df, {"x": [0.25, 0.5]}, ["g"])
    assert fit[("a",)]["x"] == {0.25: 1.75, 0.5: 2.5}
    assert fit[("b",)]["x"] == {0.25: None, 0.5: None}
    assert medians(df, ["x"])[()] == {"x": 2.5}


def test_sketch(spark):
    df = frame(spark, range(1001))
    assert quantiles(df, {"x": [0.5]}, accuracy=10_000)[()]["x"][0.5] == pytest.approx(500, abs=1)


def test_many_groups(spark):
    draw = np.random.default_rng(4)
    groups = [f"g{i % 2_000}" for i in range(10_000)]
    values = draw.normal(size=10_000).round(3)
    got = exact_quantiles(frame(spark, [float(v) for v in values], groups), {"x": [0.5]}, ["g"])
    assert len(got) == 2_000
    for k in range(0, 2_000, 97):
        assert got[(f"g{k}",)]["x"][0.5] == pytest.approx(np.quantile(values[k::2_000], 0.5))


@pytest.mark.parametrize("parts", [1, 7])
def test_grouped_table_with_a_hot_group(spark, parts):
    from keepwell.operators.quantiles import grouped_quantiles

    draw = np.random.default_rng(5)
    groups = [None if i % 50 == 0 else "hot" if i % 3 == 0 else f"g{i % 40}" for i in range(3_000)]
    values = [None if i % 11 == 0 else float(v) for i, v in enumerate(draw.normal(size=3_000).round(2))]
    df = frame(spark, values, groups).unionByName(frame(spark, [None, None], ["blank", "blank"]))
    found = grouped_quantiles(df.withColumn("y", df.x * 2), {"x": PROBS, "y": [0.5]}, ["g"], parts).collect()
    assert len(found) == 6 * len({*groups, "blank"})
    for r in found:
        own = [v for v, g in zip(values, groups) if g == r["g"] and v is not None]
        if not own:
            assert r["g"] == "blank" and r["value"] is None
            continue
        want = np.quantile(own, r["p"]) * (2 if r["column"] == "y" else 1)
        assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_hundred_thousand_groups(spark):
    """As many groups as SQL gives, equal to SQL; the driver gets only what the test compares."""
    from pyspark.sql import functions as F

    from keepwell.operators.quantiles import grouped_quantiles

    df = spark.range(300_000).select((F.col("id") % 100_000).alias("g"), (F.xxhash64("id") % 1000 / 8).alias("x"))
    table = grouped_quantiles(df, {"x": [0.5, 0.9]}, ["g"], 8)
    plain = df.groupBy("g").agg(F.expr("percentile(x, array(0.5D, 0.9D))").alias("q"))
    both = table.join(plain, "g").withColumn("want", F.when(F.col("p") == 0.5, F.col("q")[0]).otherwise(F.col("q")[1]))
    row = both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("value") - F.col("want"))).alias("gap")).first()
    assert row["n"] == 200_000 and row["gap"] < 1e-9
