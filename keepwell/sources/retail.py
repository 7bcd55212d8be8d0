"""The star schema seen over the retail benchmark tables (customer, orders, lineitem, part, events)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.operators.features import preferred_category
from keepwell.session import settle
from keepwell.sources.tables import Bundle, between_dates, items_with_products

CUTOFF = date(1997, 6, 30)

# The event log covers January 2024; moved back by this many days it ends at the cutoff.
EVENT_SHIFT_DAYS = 9710


COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Retail:
    """Star-schema tables of one folder. Each property builds only what it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[table]).parquet(f"{self.folder}/{table}.parquet")

    @property
    def orders_head(self) -> DataFrame:
        """Orders without the delivery date, which needs the lines."""
        status = F.col("o_orderstatus")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.when(status == "F", "COMPLETED").when(status == "O", "RETURNED").when(status == "P", "CANCELLED")
            .alias("order_status"),
            F.col("o_totalprice").alias("total_amount"),
            F.lit(None).cast("double").alias("discount_applied"),
            F.col("o_orderpriority").alias("payment_method"),
            F.lit(None).cast("string").alias("channel"),
        )

    @property
    def orders(self) -> DataFrame:
        """Orders; delivered when the last line was shipped."""
        delivered = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.to_date(F.max("l_shipdate")).alias("delivery_date"))
        )
        return self.orders_head.join(delivered, "order_id", "left").select(
            "order_id", "customer_id", "order_date", "delivery_date", "order_status", "total_amount",
            "discount_applied", "payment_method", "channel",
        )

    def orders_between(self, start: date, end: date) -> DataFrame:
        """Orders of the closed window with delivery date and ``categories``, both from one rollup of their lines.

        The window's orders pick their lines before lines meet the catalogue or are grouped. The result is stored:
        several features read it.
        """
        head = between_dates(self.orders_head, "order_date", start, end)
        near = self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "l_shipdate"
        ).join(head.select("order_id"), "order_id", "left_semi")
        rolled = (
            near.join(self.products.select("product_id", "category"), "product_id", "left")
            .groupBy("order_id")
            .agg(F.to_date(F.max("l_shipdate")).alias("delivery_date"), F.collect_set("category").alias("categories"))
        )
        return settle(head.join(rolled, "order_id", "left").select(
            "order_id", "customer_id", "order_date", "delivery_date", "order_status", "total_amount",
            "discount_applied", "payment_method", "channel", "categories",
        ))

    def tickets_between(self, start: date, end: date) -> DataFrame:
        """Tickets of the closed window; the bounds are moved, not the column, so they reach the scan."""
        shift = timedelta(days=EVENT_SHIFT_DAYS)
        first, after = start + shift, end + shift + timedelta(days=1)
        return self._tickets((F.col("ts") >= F.lit(first).cast("timestamp_ntz")) & (F.col("ts") < F.lit(after).cast("timestamp_ntz")))

    @property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        )

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.col("p_retailprice").alias("unit_price"),
            F.lit(None).cast("double").alias("unit_cost"),
            F.lit(None).cast("int").alias("is_active"),
        )

    @property
    def items(self) -> DataFrame:
        return items_with_products(self.lines, self.products)

    @property
    def tickets(self) -> DataFrame:
        return self._tickets(F.lit(True))

    def _tickets(self, where: Column) -> DataFrame:
        return self.raw("events").filter(where).select(
            F.col("event_id").alias("ticket_id"),
            F.col("user_id").alias("customer_id"),
            F.date_sub(F.to_date("ts"), EVENT_SHIFT_DAYS).alias("created_date"),
            F.lit(None).cast("date").alias("resolved_date"),
            F.col("event_type").alias("ticket_type"),
            F.lit(None).cast("string").alias("priority"),
            F.lit(None).cast("string").alias("resolution_status"),
            F.col("value").alias("satisfaction_score"),
        )

    @property
    def customers_head(self) -> DataFrame:
        """Customers with their own attributes only."""
        nations = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
        )
        return (
            self.raw("customer")
            .join(nations, "c_nationkey", "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                "country",
                F.col("c_mktsegment").alias("customer_segment"),
                F.lit(None).cast("int").alias("email_opt_in"),
            )
        )

    @property
    def registrations(self) -> DataFrame:
        return self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.to_date(F.min("o_orderdate")).alias("registration_date")
        )

    def customers(self, cutoff: date = CUTOFF, among: DataFrame | None = None) -> DataFrame:
        """Customers, registered with their first order, preferring what they bought most up to the cutoff.

        With ``among`` only the customers it lists get a preferred category: their orders are stored and pick the lines.
        """
        orders = self.orders_head
        if among is not None:
            dated = between_dates(orders.select("order_id", "customer_id", "order_date"), "order_date", end=cutoff)
            orders = settle(dated.join(among.select("customer_id"), "customer_id", "left_semi"))
        preferred = preferred_category(orders, self.items, cutoff)
        return (
            self.customers_head.join(self.registrations, "customer_id", "left")
            .join(preferred.select("customer_id", "preferred_category"), "customer_id", "left")
            .select(
                "customer_id", "registration_date", "country", "customer_segment", "preferred_category",
                "email_opt_in",
            )
        )

    def bundle(
        self, cutoff: date = CUTOFF, window: tuple[date, date] | None = None, last: date | None = None
    ) -> Bundle:
        """All tables, or with ``window`` the orders and tickets of its days only.

        Then only customers with an order of the window, up to the day ``last`` when given, have a preferred category.
        """
        if window is not None:
            orders = self.orders_between(*window)
            return Bundle(
                customers=self.customers(cutoff, among=between_dates(orders, "order_date", end=last)), orders=orders,
                items=self.items, tickets=self.tickets_between(*window),
            )
        return Bundle(
            customers=self.customers(cutoff), orders=self.orders, items=self.items, tickets=self.tickets
        )
