"""From order lines to feature rows, reading the lines once."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.demand import seasonality_lookup
from millrace.operators.features import (
    category_stats,
    dense_demand,
    demand_features,
    holiday_calendar,
    usable_series,
)
from millrace.operators.lines import daily_demand
from millrace.session import materialize


@dataclass(frozen=True)
class DemandSeries:
    """Tables that share one daily demand table."""

    daily: DataFrame
    dense: DataFrame
    stats: DataFrame
    seasonality: DataFrame
    calendar: DataFrame
    features: DataFrame


def demand_series(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    holidays: DataFrame | None,
    first_day: dt.date | str,
    last_day: dt.date | str,
    top: DataFrame | None = None,
    min_active: int = 60,
    fill: str = "zero",
    window: int = 30,
) -> DemandSeries:
    """Daily demand is written once and every later table reads that copy: it
    has one row per category and day, against billions of order lines.

    ``first_day`` and ``last_day`` bound the holiday calendar; ``top`` limits
    the categories."""
    daily = daily_demand(orders, items, products)
    if top is not None:
        daily = daily.join(top.select("category"), "category", "left_semi")
    daily = materialize(daily)
    dense = dense_demand(daily, fill)
    stats = category_stats(dense, min_active)
    seasonality = seasonality_lookup(daily)
    calendar = holiday_calendar(orders.sparkSession, first_day, last_day, holidays)
    features = demand_features(usable_series(dense, stats), seasonality, calendar, window)
    return DemandSeries(daily, dense, stats, seasonality, calendar, features)


def indexed_series(dense: DataFrame) -> DataFrame:
    """(category, idx, sale_date, y): a series numbered from 0."""
    by_day = W.partitionBy("category").orderBy("sale_date")
    return dense.select(
        "category",
        (F.row_number().over(by_day) - 1).alias("idx"),
        "sale_date",
        F.col("units_sold").cast("double").alias("y"),
    )
