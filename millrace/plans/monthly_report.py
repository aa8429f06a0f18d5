"""The monthly supply report: a header and four sections over one month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.fixed_values import (
    LOST_STATUSES,
    REORDER_ADEQUATE,
    REORDER_CRITICAL,
    REORDER_LOW,
    REPORT_TITLE,
    SECTION_DELAYED,
    SECTION_REORDER,
    SECTION_REVENUE,
    SECTION_STOCKOUT,
)
from millrace.functions.numeric import count_when, half_up, percent, sum_when
from millrace.functions.timing import is_late, purchase_window
from millrace.operators.lines import order_lines


def month_lines(orders: DataFrame, items: DataFrame, month: dt.date | str, end_inclusive: bool = False) -> DataFrame:
    """Order lines bought in the month of the given day. By default the upper
    bound is the first instant of the month's last day."""
    first = dt.date.fromisoformat(str(month)).replace(day=1)
    last = (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
    return order_lines(orders.filter(purchase_window(F.col("purchase_ts"), first, last, end_inclusive)), items)


def delayed_sellers(lines: DataFrame, min_orders: int = 5, limit: int = 5) -> DataFrame:
    return (
        lines.filter(F.col("delivered_ts").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("total_orders"),
            count_when(is_late()).alias("delayed_orders"),
            F.round(sum_when(is_late(), F.col("price")), 2).alias("revenue_at_risk"),
        )
        .filter(F.col("total_orders") >= min_orders)
        .select(
            F.lit(SECTION_DELAYED).alias("section"),
            "seller_id",
            "total_orders",
            "delayed_orders",
            half_up(percent(F.col("delayed_orders"), F.col("total_orders")), 1).alias("delay_pct"),
            "revenue_at_risk",
        )
        .orderBy(F.desc("delay_pct"), "seller_id")
        .limit(limit)
    )


def cancel_alerts(lines: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Canceled and unavailable lines by category; NULL is a category here."""
    per_product = (
        lines.filter(F.col("order_status").isin(*LOST_STATUSES))
        .groupBy("product_id")
        .agg(F.sum("price").alias("revenue"), F.min("purchase_ts").alias("first_seen"))
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.count("*").alias("products_at_risk"),
            F.sum("revenue").alias("total_category_revenue"),
            F.min("first_seen").alias("first_signal_date"),
        )
        .select(F.lit(SECTION_STOCKOUT).alias("section"), "*")
        .orderBy(F.desc("products_at_risk"), "category")
        .limit(limit)
    )


def revenue_summary(lines: DataFrame) -> DataFrame:
    value = F.col("price") + F.col("freight")
    return (
        lines.filter(F.col("delivered_ts").isNotNull())
        .agg(
            F.count_distinct("order_id").alias("total_orders_this_month"),
            F.sum(value).alias("total_revenue"),
            F.sum(F.when(is_late(), value).otherwise(F.lit(0).cast("decimal(16,4)"))).alias("revenue_at_risk"),
            count_when(is_late()).alias("late"),
        )
        .select(
            F.lit(SECTION_REVENUE).alias("section"),
            "total_orders_this_month",
            "total_revenue",
            "revenue_at_risk",
            half_up(percent(F.col("late"), F.col("total_orders_this_month")), 1).alias("overall_delay_pct"),
        )
    )


def reorder_alerts(lines: DataFrame, products: DataFrame, critical: int = 5, low: int = 15, limit: int = 20) -> DataFrame:
    units = F.col("units_sold_this_month")
    return (
        lines.groupBy("product_id")
        .agg(F.count("*").alias("units_sold_this_month"))
        .filter(units < low)
        .join(products.select("product_id", "category"), "product_id")
        .select(
            F.lit(SECTION_REORDER).alias("section"),
            "category",
            "product_id",
            "units_sold_this_month",
            F.when(units < critical, REORDER_CRITICAL)
            .when(units < low, REORDER_LOW)
            .otherwise(REORDER_ADEQUATE)
            .alias("reorder_status"),
        )
        .orderBy("units_sold_this_month", "product_id")
        .limit(limit)
    )


def monthly_report(
    orders: DataFrame, items: DataFrame, products: DataFrame, month: dt.date | str, as_of: dt.datetime | str
) -> dict[str, DataFrame]:
    """All sections from one month slice, which is persisted because four
    results read it; call ``unpersist`` on ``result['lines']`` when done."""
    lines = month_lines(orders, items, month).persist()
    header = orders.sparkSession.range(1).select(
        F.lit(REPORT_TITLE).alias("report_title"),
        F.lit(str(month)[:7]).alias("report_period"),
        F.lit(str(as_of)).cast("timestamp_ntz").alias("generated_at"),
    )
    return {
        "lines": lines,
        "header": header,
        "delayed_sellers": delayed_sellers(lines),
        "cancel_alerts": cancel_alerts(lines, products),
        "revenue_summary": revenue_summary(lines),
        "reorder_alerts": reorder_alerts(lines, products),
    }
