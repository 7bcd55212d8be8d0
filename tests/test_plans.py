"""What the physical plans must and must not contain."""

from datetime import date, timedelta

import pytest

import star
from keepwell.operators import audit, features as feats
from keepwell.params import Params
from keepwell.plans.matrix import assemble, feature_matrix
from keepwell.session import shared_folder
from keepwell.sources import lineage, store
from keepwell.sources.retail import CUTOFF, EVENT_SHIFT_DAYS, Retail
from keepwell.sources.schemas import COLUMNS, KEYS, schema_of
from keepwell.sources.tables import between_dates, items_with_products, labels_of, read_bundle, run_sql, scan

JAN = Params(cutoff=date(2023, 1, 1))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pairwise_joins(spark, folder):
    tables = Retail(spark, folder)
    whole = plan(assemble(tables.bundle(), Params(cutoff=CUTOFF), [CUTOFF, date(1997, 3, 31)]))
    assert "CartesianProduct" not in whole and "NestedLoop" not in whole


def test_window_reaches_the_scan(spark, folder):
    text = plan(feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF]))
    assert "GreaterThanOrEqual(o_orderdate,1997-04-01T00:00)" in text
    assert "LessThan(o_orderdate,1997-07-31T00:00)" in text


def test_scan_reads_needed_columns_only(spark, folder):
    text = plan(feats.churn_labels(Retail(spark, folder).orders_head, [CUTOFF]))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_order_features_take_one_shuffle(spark, folder):
    text = plan(feats.order_rollup(Retail(spark, folder).orders_head, [CUTOFF], 90, 30, parts=("trend_slope_30d", "recency_days")))
    assert text.count("Exchange") == 1


def test_parts_join_without_shuffling_again(spark):
    """Four tables by customer: only the shuffles of the grouped tables and of the customers."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bundle = star.leakage_bundle(spark).having(labels=None)
        text = plan(assemble(bundle, JAN))
        # orders; orders by id, their ids, lines of those by order, categories twice; tickets; customers
        assert text.count("Exchange hashpartitioning") == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_reaches_events_and_picks_lines_first(spark, folder):
    tables = Retail(spark, folder)
    text = plan(tables.tickets_between(date(1997, 4, 1), CUTOFF))
    first, after = date(1997, 4, 1) + timedelta(days=EVENT_SHIFT_DAYS), CUTOFF + timedelta(days=EVENT_SHIFT_DAYS + 1)
    assert f"GreaterThanOrEqual(ts,{first}T00:00)" in text and f"LessThan(ts,{after}T00:00)" in text
    near = feats.category_diversity(tables.orders_head, tables.items, [CUTOFF])
    lines = near._jdf.queryExecution().optimizedPlan().toString()
    # Read from the top: grouped by order last, after the catalogue, after the semi join of the lines.
    assert lines.index("Aggregate [order_id") < lines.index("Join Inner, (product_id") < lines.index("Join LeftSemi")


def test_matrix_reads_lines_twice_at_most(spark, folder):
    day = (date(1997, 4, 1), date(1997, 7, 30))
    text = plan(assemble(Retail(spark, folder).bundle(CUTOFF, day), Params(cutoff=CUTOFF)))
    # One more scan made the stored orders of the window; this one is the preferred category's.
    assert text.count("lineitem.parquet") <= 1


def test_fanout_does_not_build_the_join(spark, folder):
    tables = Retail(spark, folder)
    text = plan(audit.join_fanout(tables.orders_head, tables.lines, "order_id", "j"))
    assert text.count("partial_count") >= 2


def test_checkpoint_folder_is_the_named_one(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


def write_star(spark, root):
    from pyspark.sql import functions as F

    bundle = star.leakage_bundle(spark)
    products = spark.createDataFrame(
        [("P1", "thing", "Home", "s", 1.0, None, 1)],
        "product_id string, product_name string, category string, subcategory string, unit_price double, unit_cost double, is_active int",
    )
    lines = bundle.items.select(
        F.lit(1).cast("bigint").alias("item_id"), "order_id", "product_id", F.lit(2).alias("quantity"), F.lit(3.0).alias("unit_price")
    )
    frames = {
        "dim_customers": bundle.customers, "dim_products": products, "fact_order_items": lines,
        "fact_support_tickets": bundle.tickets,
    }
    for name, df in frames.items():
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schema_of(name) if f.name not in df.columns}
        (df.withColumns(missing) if missing else df).write.parquet(f"{root}/{name}")
    store.write_fact(bundle.orders, f"{root}/fact_orders", "order_date", "customer_id")
    store.write_labels(bundle.labels, f"{root}/ml_churn_labels")


def test_star_schema_on_disk(spark, tmp_path):
    root = str(tmp_path)
    write_star(spark, root)
    bundle = read_bundle(spark, root)
    row = feature_matrix(bundle, JAN).first()
    assert (row["frequency_orders"], row["monetary_total"], row["category_diversity"]) == (1, 100, 1)
    orders = between_dates(scan(spark, root, "fact_orders"), "order_date", date(2022, 12, 1), date(2023, 1, 1))
    assert orders.count() == 1
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date,2022-12-01)" in plan(orders)
    assert labels_of(scan(spark, root, "ml_churn_labels"), date(2022, 1, 1)).count() == 0
    assert "PartitionFilters: [isnotnull(cutoff_date" in plan(labels_of(scan(spark, root, "ml_churn_labels"), JAN.cutoff))
    items = items_with_products(scan(spark, root, "fact_order_items"), scan(spark, root, "dim_products"))
    assert items.columns == ["order_id", "product_id", "quantity", "unit_price", "category", "subcategory"]


def test_scan_knows_one_marker_of_absence(spark, tmp_path):
    rows = star.orders(spark, ("A", "C", "2023-01-05", None, "COMPLETED", float("nan")))
    rows.write.parquet(f"{tmp_path}/fact_orders")
    assert scan(spark, str(tmp_path), "fact_orders").first()["total_amount"] is None


def test_every_schema_parses():
    for table in COLUMNS:
        assert set(KEYS.get(table, ())) <= set(schema_of(table).fieldNames())


def test_parameterised_query(spark):
    df = star.labels(spark, ("A", "2023-01-01", 1), ("B", "2023-01-01", 0))
    text = "SELECT customer_id FROM {t} WHERE churn_label = :y"
    assert [r[0] for r in run_sql(spark, text, {"y": 1}, t=df).collect()] == ["A"]


def test_matrix_store_replaces_only_its_cutoffs(spark, tmp_path):
    path = str(tmp_path / "store")
    matrix = star.labels(spark, ("A", "2023-01-01", 1), ("A", "2023-02-01", 0))
    store.write_matrix(matrix, path, "1.0")
    store.write_matrix(star.labels(spark, ("B", "2023-02-01", 1)), path, "1.1")
    got = sorted((r["customer_id"], str(r["cutoff_date"]), r["pipeline_version"]) for r in store.read_matrix(spark, path).collect())
    assert got == [("A", "2023-01-01", "1.0"), ("B", "2023-02-01", "1.1")]
    assert store.read_matrix(spark, path, date(2023, 1, 1)).count() == 1


def test_append_new_labels(spark, tmp_path):
    path = str(tmp_path / "labels")
    star.labels(spark, ("A", "2023-01-01", 1)).write.parquet(path)
    rows = star.labels(spark, ("A", "2023-01-01", 0), ("B", "2023-01-01", 0), ("C", "2023-01-01", 7))
    store.append_new(spark, rows, path, "ml_churn_labels", ["churn_label"])
    assert sorted(map(tuple, spark.read.parquet(path).select("customer_id", "churn_label").collect())) == [("A", 1), ("B", 0)]


def test_fingerprint_ignores_order_and_sees_repeats(spark):
    df = star.labels(spark, ("A", "2023-01-01", 1), ("B", "2023-01-01", 0))
    first = lineage.fingerprint(df).first()
    assert lineage.fingerprint(df.orderBy("churn_label").repartition(3)).first() == first
    assert lineage.fingerprint(df.unionByName(df)).first() != first
    assert lineage.fingerprint(df.limit(0)).first()["fingerprint"] == "0"


def test_parameters_from_configuration():
    config = {
        "temporal": {"cutoff_date": "2023-09-30", "prediction_window_days": 60},
        "etl": {"iqr_factor": 3.0},
        "model": {"hyperparams": {"n_estimators": 50}, "smote": {"k_neighbors": 3}, "threshold": {"grid_end": 0.5}},
        "evaluation": {"cv_folds": 4},
        "project": {"random_seed": 1},
    }
    got = Params.from_config(config)
    assert (got.cutoff, got.prediction_days, got.observation_days, got.seed) == (date(2023, 9, 30), 60, 90, 1)
    assert (got.cleaning.iqr_factor, got.cleaning.null_threshold) == (3.0, 0.4)
    assert (got.boosting.trees, got.boosting.depth, got.oversampling.neighbours) == (50, 6, 3)
    assert (got.threshold.end, got.evaluation.folds) == (0.5, 4)
    assert Params.from_config({}) == Params()


def test_manifest(spark):
    import json

    df = star.labels(spark, ("A", "2023-01-01", 1), ("B", "2023-01-01", 0))
    row = lineage.as_manifest(lineage.lineage_record(df, "labels", "p", date(2023, 1, 1))).first()
    entry = json.loads(row["entry"])
    assert (row["artifact"], entry["rows"], entry["churn_rate"], entry["cutoff_date"]) == ("labels", 2, 0.5, "2023-01-01")


def test_cluster_without_a_named_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_medians_move_no_row_of_the_matrix(spark):
    """Joined by the cutoff, all rows of one cutoff would be one task, and so would all that reads them."""
    from keepwell.params import MATRIX_NUMERIC
    from keepwell.plans.matrix import impute

    columns = ", ".join(f"CAST(nullif(id % 3, 0) AS DOUBLE) AS {c}" for c in MATRIX_NUMERIC)
    matrix = spark.sql(
        f"SELECT id AS customer_id, DATE '2023-01-01' AS cutoff_date, {columns}, 'VIP' AS customer_segment, 'a' AS preferred_category, 0 AS churn_label FROM range(70)"
    ).repartition(7)
    fit = spark.sql(f"SELECT DATE '2023-01-01' AS cutoff_date, {', '.join(f'1.5D AS _med_{c}' for c in MATRIX_NUMERIC)}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = impute(matrix, fit)
        assert filled.rdd.getNumPartitions() == 7 and "hashpartitioning(cutoff_date" not in plan(filled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert filled.filter("recency_days = 1.5").count() == 24


def test_known_orders_pick_the_lines_of_the_preferred_category(spark, folder):
    tables = Retail(spark, folder)
    text = feats.preferred_category(tables.orders_head, tables.items, CUTOFF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner, (product_id") < text.index("Join LeftSemi")


def test_matrix_prefers_categories_of_its_own_customers(spark, folder):
    window = (date(1997, 4, 1), date(1997, 7, 30))
    tables = Retail(spark, folder)
    own = tables.bundle(CUTOFF, window, CUTOFF).customers.select("customer_id", "preferred_category")
    every = tables.customers(CUTOFF).select("customer_id", "preferred_category")
    seen = between_dates(tables.orders_head, "order_date", window[0], CUTOFF).select("customer_id").distinct()
    assert own.join(seen, "customer_id").exceptAll(every.join(seen, "customer_id")).count() == 0
    assert own.count() == every.count()
    assert own.filter("preferred_category IS NOT NULL").count() <= seen.count()
