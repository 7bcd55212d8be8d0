from datetime import datetime, timedelta

from pyspark.sql import functions as F

from keepwell.streaming import scoring

SCHEMA = (
    "customer_id string, recency_days double, frequency_orders int, monetary_total double, monetary_avg_order double, "
    "category_diversity int, days_since_registration double, requested_at timestamp"
)
START = datetime(2024, 1, 1)


def requests(spark, *rows):
    return spark.createDataFrame(
        [(c, r, 1, 90.0, 90.0, 1, 10.0, START + timedelta(minutes=m)) for c, r, m in rows], SCHEMA
    )


def by_recency(df):
    return df.withColumn("score", F.col("recency_days") / 100)


def run(spark, tmp_path):
    arriving = scoring.read_requests(spark, str(tmp_path / "in"), requests(spark, ("x", 1.0, 0)).schema)
    key = ("customer_id", "requested_at")
    scored = scoring.score_requests(arriving, by_recency, 0.3, "v1", key)
    once = scoring.once_per_key(scored, ("customer_id",), "requested_at")
    query = scoring.log_predictions(once, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True)
    query.awaitTermination()
    return {r["customer_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}, spark.read.parquet(
        str(tmp_path / "out")
    ).count()


def test_stream_scores_each_key_once(spark, tmp_path):
    rows = requests(spark, ("a", 80.0, 0), ("b", 35.0, 1), ("bad", -1.0, 1))
    rows.write.parquet(str(tmp_path / "in"))
    got, count = run(spark, tmp_path)
    assert count == 2 and set(got) == {"a", "b"}
    assert got["a"]["recommended_action"] == "IMMEDIATE_CALL_SCHEDULED"
    assert (got["b"]["churn_flag"], got["b"]["churn_probability"]) == (1, 0.35)
    # After a restart the repeats of known keys add nothing, new ones do.
    requests(spark, ("a", 80.0, 2), ("c", 10.0, 3)).write.mode("append").parquet(str(tmp_path / "in"))
    got, count = run(spark, tmp_path)
    assert count == 3 and set(got) == {"a", "b", "c"}


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    requests(spark, ("a", 80.0, 0), ("b", 35.0, 1)).write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    (tmp_path / "progress").rename(tmp_path / "lost")
    again = tmp_path / "again"
    again.mkdir()
    (tmp_path / "out").rename(again / "out")
    requests(spark, ("c", 10.0, 3)).write.parquet(str(again / "in"))
    got, count = run(spark, again)
    assert count == 3 and set(got) == {"a", "b", "c"}


def test_requests_are_counted(spark):
    row = scoring.counted(requests(spark, ("a", 80.0, 0), ("bad", -1.0, 1))).first()
    assert tuple(row) == (2, 1, 1)


def test_rejected_requests(spark):
    bad = scoring.rejected(requests(spark, ("a", 80.0, 0), ("bad", -1.0, 1))).collect()
    assert [(r["customer_id"], r["errors"]) for r in bad] == [("bad", ["recency_days"])]
