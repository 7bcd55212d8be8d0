"""Reading the star schema and the point-in-time bundle."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.numeric import as_null
from keepwell.params import Params
from keepwell.sources.schemas import schema_of


@dataclass(frozen=True)
class Bundle:
    """The inputs of a feature build; all lazy."""

    customers: DataFrame
    orders: DataFrame
    items: DataFrame
    tickets: DataFrame
    labels: DataFrame | None = None

    def having(self, **changes: DataFrame) -> "Bundle":
        return replace(self, **changes)


def scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table with its declared types. NaN becomes NULL, so that one marker of absence is left."""
    rows = spark.read.schema(schema_of(table)).parquet(f"{root}/{table}")
    return rows.select(*[as_null(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes])


def between_dates(df: DataFrame, column: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included; an absent bound does not restrict."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def items_with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the category of their product.

    No broadcast hint: the planner broadcasts the catalogue when its size allows and otherwise joins by
    shuffle, where adaptive execution splits a product that holds many lines.
    """
    catalogue = products.select("product_id", "category", "subcategory")
    lines = items.select("order_id", "product_id", "quantity", "unit_price")
    return lines.join(catalogue, "product_id").select(
        "order_id", "product_id", "quantity", "unit_price", "category", "subcategory"
    )


def labels_of(labels: DataFrame, cutoff: date | None = None) -> DataFrame:
    return labels if cutoff is None else labels.filter(F.col("cutoff_date") == F.lit(cutoff))


def bounded(bundle: Bundle, params: Params) -> Bundle:
    """The bundle as known at the cutoff: orders and tickets of the observation window only.

    Lines carry no date; they are bounded by the join with the orders. Labels have to be there already, as
    they need the orders after the cutoff.
    """
    if bundle.labels is None:
        raise ValueError("draw the labels before the orders are bounded")
    start, end = params.observation_start, params.cutoff
    return bundle.having(
        orders=between_dates(bundle.orders, "order_date", start, end),
        tickets=between_dates(bundle.tickets, "created_date", start, end),
        labels=labels_of(bundle.labels, end),
    )


def read_bundle(spark: SparkSession, root: str, with_labels: bool = True) -> Bundle:
    """The bundle of a star schema stored as one Parquet folder per table, not yet bounded."""
    return Bundle(
        customers=scan(spark, root, "dim_customers"),
        orders=scan(spark, root, "fact_orders"),
        items=items_with_products(scan(spark, root, "fact_order_items"), scan(spark, root, "dim_products")),
        tickets=scan(spark, root, "fact_support_tickets"),
        labels=scan(spark, root, "ml_churn_labels") if with_labels else None,
    )


def run_sql(spark: SparkSession, text: str, args: Mapping | list | None = None, **frames: DataFrame) -> DataFrame:
    """A parameterised query. ``:name`` or ``?`` take ``args``; ``{name}`` takes a DataFrame."""
    return spark.sql(text, args=args, **frames) if args is not None else spark.sql(text, **frames)
