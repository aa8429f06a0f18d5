"""Order lines and their pre-aggregates, shared by the analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.fixed_values import DELIVERED


def order_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their items. Catalyst prunes the unused columns and pushes
    the filters a caller adds; AQE splits an order that holds too many items."""
    return orders.join(items, "order_id")


def delivered_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    return order_lines(orders.filter(F.col("order_status") == DELIVERED), items)


def product_periods(lines: DataFrame, period: Column, name: str) -> DataFrame:
    """Units and revenue per product and period. Reducing to this grain before
    the product join leaves a hot product with one row per period."""
    return lines.groupBy("product_id", period.alias(name)).agg(
        F.count("*").alias("units"), F.sum("price").alias("revenue")
    )


def category_periods(lines: DataFrame, products: DataFrame, period: Column, name: str, *, keep_null: bool = False) -> DataFrame:
    """Units and revenue per category and period."""
    if not keep_null:
        products = products.filter(F.col("category").isNotNull())
    return (
        product_periods(lines, period, name)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy(name, "category")
        .agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    )


def daily_demand(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """(sale_date, category, units_sold, revenue) of delivered orders."""
    daily = category_periods(
        delivered_lines(orders, items), products, F.to_date("purchase_ts"), "sale_date"
    )
    return daily.withColumnsRenamed({"units": "units_sold"})
