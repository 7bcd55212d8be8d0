"""The ledger: each key once, over failures, restarts and streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keepwell.sources import store
from keepwell.sources.ledger import Ledger
from keepwell.streaming import scoring

SCHEMA = "id long, note string, value double"


def rows(spark, *ids, note="x"):
    return spark.createDataFrame([(i, note, float(i or 0)) for i in ids], SCHEMA)


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, f"file://{tmp_path}/ledger", rows(spark, 1).schema, ["id"], bits=1 << 16)


def held(ledger):
    return sorted((r["id"], r["note"]) for r in ledger.rows().collect())


def test_each_key_once(spark, ledger):
    assert held(ledger) == []
    assert ledger.commit("a", rows(spark, 1, 2, 2, 3))
    assert ledger.commit("b", rows(spark, 3, 4, note="y").unionByName(rows(spark, 4, note="z")), ["note"])
    assert held(ledger) == [(1, "x"), (2, "x"), (3, "x"), (4, "y")]
    assert not ledger.commit("b", rows(spark, 9))
    assert held(ledger) == [(1, "x"), (2, "x"), (3, "x"), (4, "y")]


def test_null_keys_and_empty_batches(spark, ledger):
    assert ledger.commit("a", rows(spark))
    assert ledger.commit("b", rows(spark, 1).unionByName(spark.createDataFrame([(None, "n", 0.0)], SCHEMA)))
    assert ledger.commit("c", spark.createDataFrame([(None, "m", 0.0), (2, "m", 0.0)], SCHEMA))
    assert ledger.rows().count() == 3 and ledger.rows().filter("id IS NULL").first()["note"] == "n"


def test_a_writer_that_dies_before_its_commit(spark, ledger, monkeypatch):
    ledger.commit("a", rows(spark, 1))
    publish = Ledger._publish

    def dies(self, batch, manifest):
        raise RuntimeError("killed")

    monkeypatch.setattr(Ledger, "_publish", dies)
    with pytest.raises(RuntimeError, match="killed"):
        ledger.commit("b", rows(spark, 1, 2))
    assert held(ledger) == [(1, "x")]
    monkeypatch.setattr(Ledger, "_publish", publish)
    # A new process repeats the batch.
    again = Ledger(spark, ledger.folder, ledger.schema, ["id"], bits=1 << 16)
    assert again.commit("b", rows(spark, 1, 2)) and held(again) == [(1, "x"), (2, "x")]
    assert again.sweep() == 1 and held(again) == [(1, "x"), (2, "x")]


def test_bitmaps_leave_out_most_comparisons(spark, tmp_path):
    big = Ledger(spark, f"file://{tmp_path}/big", rows(spark, 1).schema, ["id"], bits=1 << 20)
    ids = spark.range(5000).select("id", F.lit("x").alias("note"), F.lit(0.0).alias("value"))
    big.commit("a", ids)
    fresh = spark.range(4000, 24000).select("id", F.lit("y").alias("note"), F.lit(0.0).alias("value"))
    assert big.commit("b", fresh)
    assert big.rows().count() == 24000 and big.rows().select("id").distinct().count() == 24000
    # Sharing bits never loses a row: two thousand keys in 32768 bits collide often.
    small = Ledger(spark, f"file://{tmp_path}/small", rows(spark, 1).schema, ["id"], bits=1 << 15)
    small.commit("a", ids.filter("id < 2000"))
    small.commit("b", ids)
    assert small.rows().count() == 5000


def test_valid_rows_only(spark, tmp_path):
    from keepwell.sources.schemas import KEYS

    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (2, 1)], "customer_id long, churn_label int"
    ).withColumn("cutoff_date", F.lit("2023-09-30").cast("date"))
    ledger = Ledger(spark, f"file://{tmp_path}/labels", labels.schema, KEYS["ml_churn_labels"], bits=1 << 15)
    assert store.commit_new(ledger, "a", labels, "ml_churn_labels", ["churn_label"])
    assert {(r["customer_id"], r["churn_label"]) for r in ledger.rows().collect()} == {(1, 0), (2, 1)}


def test_streams_log_each_key_once(spark, tmp_path):
    """Beyond the watermark, with a new checkpoint, and over two streams at different times."""
    schema = "id long, note string, value double, at timestamp"
    start = datetime(2024, 1, 1)

    def send(*ids, hours):
        spark.createDataFrame([(i, "x", 0.0, start + timedelta(hours=hours)) for i in ids], schema).write.mode("append").parquet(f"{tmp_path}/in")

    arriving = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    send(1, 2, 2, hours=0)
    ledger = Ledger(spark, f"file://{tmp_path}/log", arriving().schema, ["id"], bits=1 << 15)
    once = lambda progress: scoring.log_once(arriving(), ledger, f"{tmp_path}/{progress}", available_now=True).awaitTermination()
    once("first")
    send(1, 3, hours=500)
    once("first")
    assert sorted(r["id"] for r in ledger.rows().collect()) == [1, 2, 3]
    send(4, 3, hours=501)
    once("second")  # reads everything from the start
    assert sorted(r["id"] for r in ledger.rows().collect()) == [1, 2, 3, 4]
