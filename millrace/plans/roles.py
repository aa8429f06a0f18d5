"""The driver's test tables seen as orders, items, products, sellers, reviews.

Facts the test tables lack (delivery times, one review per order) come from
fixed integer formulas, written once here and once as text in ``role_sql``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F


# column types of the driver's tables; stating them saves a read of the files
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
    "ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'canceled' ELSE 'unavailable' END END AS order_status"
)
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"


class Shop:
    """Role tables of one folder, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return (
            self.table("orders")
            .selectExpr(
                "*",
                "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR + ((o_orderkey * 7) % 60) * INTERVAL '1' MINUTE AS purchase_ts",
            )
            .selectExpr("*", "purchase_ts + ((o_orderkey * 37) % 5000) * INTERVAL '1' MINUTE AS approved_ts")
            .selectExpr("*", "approved_ts + ((o_orderkey * 53) % 9000) * INTERVAL '1' MINUTE AS carrier_at")
            .selectExpr(
                "o_orderkey AS order_id",
                "o_custkey AS customer_id",
                STATUS,
                "purchase_ts",
                "approved_ts",
                "CASE WHEN o_orderstatus <> 'P' THEN carrier_at END AS carrier_ts",
                "CASE WHEN o_orderstatus = 'F' THEN carrier_at + ((o_orderkey * 71) % 50000) * INTERVAL '1' MINUTE END AS delivered_ts",
                "o_orderdate + (10 + o_custkey % 20) * INTERVAL '1' DAY AS estimated_ts",
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS item_no",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            f"{PRICE} AS price",
            f"CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) AS freight",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id", "p_type AS category", "p_brand AS brand"
        )

    @cached_property
    def sellers(self) -> DataFrame:
        joined = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.selectExpr("s_suppkey AS seller_id", "n_name AS seller_state")

    @cached_property
    def reviews(self) -> DataFrame:
        return (
            self.table("orders")
            .selectExpr(
                "o_orderkey AS review_id",
                "o_orderkey AS order_id",
                "CAST(1 + (o_orderkey * 3 + o_custkey) % 5 AS INT) AS review_score",
                "CAST(CAST((o_orderkey * 17 + o_custkey) % 201 - 100 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS sentiment_score",
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr("c_custkey AS customer_id")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")


def holidays(spark: SparkSession) -> DataFrame:
    """A caller-style holiday table: fixed month-day dates of 1995 to 2001."""
    dates = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
    days = ", ".join(f"make_date(CAST(id AS INT), {m}, {d})" for m, d in dates)
    return spark.range(1995, 2002).selectExpr(f"explode(array({days})) AS holiday_date")
