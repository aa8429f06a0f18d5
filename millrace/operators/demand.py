"""Category demand: trend, rolling means, stockout runs, seasonality, top list."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.fixed_values import SEASON
from millrace.functions.numeric import exact, half_up, percent, ratio
from millrace.functions.timing import month_label, purchase_window
from millrace.operators.lines import category_periods, daily_demand, delivered_lines


def monthly_demand_trend(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    start: dt.date | str = "2017-01-01",
    end: dt.date | str = "2018-12-31",
    end_inclusive: bool = False,
) -> DataFrame:
    """Items sold, revenue and mean item price per month and category."""
    in_window = orders.filter(purchase_window(F.col("purchase_ts"), start, end, end_inclusive))
    monthly = category_periods(
        delivered_lines(in_window, items), products, F.trunc("purchase_ts", "month"), "order_month"
    )
    return monthly.select(
        month_label(F.col("order_month")).alias("order_month"),
        "category",
        F.col("units").alias("total_orders"),
        F.col("revenue").alias("total_revenue"),
        half_up(ratio(F.col("revenue"), F.col("units")), 2).alias("avg_order_value"),
    ).orderBy("order_month", F.desc("total_revenue"), "category")


def top_categories(orders: DataFrame, items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most delivered items."""
    return (
        daily_demand(orders, items, products)
        .groupBy("category")
        .agg(F.sum("units_sold").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "category")
        .limit(n)
    )


def rolling_demand(orders: DataFrame, items: DataFrame, products: DataFrame, days: int = 7) -> DataFrame:
    """Daily demand with its mean over the last ``days`` rows of the category.

    The window runs on daily totals, so a partition holds at most one row per
    calendar day whatever the size of the category."""
    frame = W.partitionBy("category").orderBy("order_date").rowsBetween(-(days - 1), W.currentRow)
    daily = daily_demand(orders, items, products).select(
        F.col("sale_date").alias("order_date"),
        "category",
        F.col("units_sold").alias("daily_orders"),
        F.col("revenue").alias("daily_revenue"),
    )
    rows = F.count("*").over(frame)
    return daily.withColumns(
        {
            "rolling_avg_orders": half_up(ratio(F.sum("daily_orders").over(frame), rows), 2),
            "rolling_avg_revenue": half_up(ratio(F.sum("daily_revenue").over(frame), rows), 2),
        }
    ).orderBy("category", "order_date")


def stockout_runs(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    window: int = 30,
    drop: float = 0.5,
    min_run: int = 3,
    dense: bool = False,
) -> DataFrame:
    """Runs of at least ``min_run`` consecutive rows whose demand lies under
    ``drop`` times the rolling mean. A day without sales has no row and does
    not break a run; ``dense=True`` counts such days as zero demand instead."""
    daily = daily_demand(orders, items, products)
    if dense:
        from millrace.operators.features import dense_demand

        daily = dense_demand(daily)
    return low_demand_runs(daily, window, drop, min_run)


def low_demand_runs(daily: DataFrame, window: int = 30, drop: float = 0.5, min_run: int = 3) -> DataFrame:
    """Gaps-and-islands over a daily demand table."""
    by_day = W.partitionBy("category").orderBy("sale_date")
    frame = by_day.rowsBetween(-(window - 1), W.currentRow)
    expected = ratio(F.sum("units_sold").over(frame), F.count("*").over(frame))
    flagged = daily.withColumn("expected", expected).withColumn(
        "low", (F.col("units_sold") < F.col("expected") * drop) & (F.col("expected") > 0)
    )
    island = F.row_number().over(by_day) - F.row_number().over(W.partitionBy("category", "low").orderBy("sale_date"))
    return (
        flagged.withColumn("island", island)
        .filter("low")
        .groupBy("category", "island")
        .agg(
            F.min("sale_date").alias("stockout_start"),
            F.max("sale_date").alias("stockout_end"),
            F.count("*").alias("consecutive_days"),
            F.sum("revenue").alias("estimated_revenue_loss"),
            half_up(ratio(F.sum(exact(F.col("expected"))), F.count("*")), 1).alias("expected_daily_demand"),
            half_up(ratio(F.sum("units_sold"), F.count("*")), 1).alias("actual_daily_demand"),
        )
        .filter(F.col("consecutive_days") >= min_run)
        .drop("island")
        .orderBy(F.desc("estimated_revenue_loss"), "category", "stockout_start")
    )


def monthly_index(orders: DataFrame, items: DataFrame, products: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Demand per category and calendar month with the category's month mean."""
    if years:
        ts = F.col("purchase_ts")
        spans = [purchase_window(ts, f"{y}-01-01", f"{y}-12-31", end_inclusive=True) for y in years]
        span = spans[0]
        for other in spans[1:]:
            span = span | other
        orders = orders.filter(span)
    return month_means(
        category_periods(delivered_lines(orders, items), products, F.month("purchase_ts"), "month_num")
    )


def month_means(monthly: DataFrame) -> DataFrame:
    whole = W.partitionBy("category")  # at most twelve rows
    return monthly.select(
        "month_num",
        "category",
        F.col("units").alias("monthly_orders"),
        ratio(F.sum("units").over(whole), F.count("*").over(whole)).alias("mean_orders"),
    )


def seasonality_index(
    orders: DataFrame, items: DataFrame, products: DataFrame, years: Sequence[int] | None = None
) -> DataFrame:
    """Month demand against the category's mean month (100 = average)."""
    raw = percent(F.col("monthly_orders"), F.col("mean_orders"))
    high, low, normal = SEASON
    return (
        monthly_index(orders, items, products, years)
        .withColumn("raw", exact(raw))
        .select(
            "month_num",
            F.date_format(F.make_date(F.lit(2000), "month_num", F.lit(1)), "MMM").alias("month_name"),
            "category",
            "monthly_orders",
            half_up(F.col("mean_orders"), 1).alias("annual_avg_orders"),
            half_up(F.col("raw"), 1).alias("seasonality_index"),
            F.when(F.col("raw") > 130, high).when(F.col("raw") < 70, low).otherwise(normal).alias("season_label"),
        )
        .orderBy("category", "month_num")
    )


def seasonality_lookup(daily: DataFrame) -> DataFrame:
    """(month_num, category, seasonality_index) over all years of a daily
    demand table, for the features."""
    monthly = daily.groupBy("category", F.month("sale_date").alias("month_num")).agg(F.sum("units_sold").alias("units"))
    return month_means(monthly).select(
        "month_num",
        "category",
        half_up(percent(F.col("monthly_orders"), F.col("mean_orders")), 1).alias("seasonality_index"),
    )
