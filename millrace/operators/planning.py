"""From forecasts to stock: safety stock, reorder points, costs, scenarios.

Forecasts are long rows (category, day, forecast, lower, upper); the bounds may
be NULL. Scenario values are exploded from literal arrays, so no scenario table
is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.fixed_values import LEAD_TIMES, SERVICE_LEVEL_Z, SERVICE_LEVELS
from millrace.functions.numeric import half_up
from millrace.operators.global_order import number_globally

PLAN_KEYS = ("category",)


def z_for(service_level: Column) -> Column:
    """z of the nearest tabulated service level; the lower of two as near."""
    entries = F.array(
        *[
            F.struct(F.abs(F.lit(level) - service_level).alias("off"), F.lit(i).alias("i"), F.lit(z).alias("z"))
            for i, (level, z) in enumerate(SERVICE_LEVEL_Z)
        ]
    )
    return F.array_min(entries)["z"]


def demand_profile(forecasts: DataFrame, by: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """Mean demand and its deviation per entity: from the width of the 95 %
    interval where there is one, else a quarter of the demand."""
    width = F.col("upper") - F.col("lower")
    profile = forecasts.groupBy(*by).agg(
        F.coalesce(F.avg("forecast"), F.lit(0.0)).alias("avg_daily_demand"),
        F.sum("forecast").alias("total"),
        F.avg(width).alias("_width"),
        F.max(width).alias("_widest"),
    )
    has_width = F.coalesce(F.col("_widest") > 0, F.lit(False))
    return profile.select(
        *by,
        "avg_daily_demand",
        "total",
        F.when(has_width, F.col("_width") / (2 * 1.96)).otherwise(F.col("avg_daily_demand") * 0.25).alias("avg_std"),
        has_width.alias("interval_based_std"),
    )


def with_plan(
    profile: DataFrame,
    lead_time: Column | float = 7,
    service_level: Column | float = 0.95,
    unit_cost: float = 25.0,
    holding_rate: float = 0.2,
    ordering_cost: float = 500.0,
) -> DataFrame:
    """Stock plan columns on rows with avg_daily_demand and avg_std."""
    lead = (lead_time if isinstance(lead_time, Column) else F.lit(float(lead_time))).cast("double")
    level = service_level if isinstance(service_level, Column) else F.lit(float(service_level))
    demand = F.col("avg_daily_demand")
    holding = float(unit_cost) * float(holding_rate)
    eoq = F.sqrt(F.lit(2.0) * F.col("annual_demand") * ordering_cost / holding) if holding > 0 else F.lit(0.0)
    per_unit = 2.0 * unit_cost
    plan = profile.withColumns(
        {
            "lead_time_demand": demand * lead,
            "safety_stock": z_for(level) * F.col("avg_std") * F.sqrt(F.greatest(lead, F.lit(1.0))),
            "annual_demand": demand * 365,
            "stockout_prob": F.lit(1.0) - level,
            "stockout_cost_per_unit": F.lit(per_unit),
        }
    )
    plan = plan.withColumns({"reorder_point": F.col("lead_time_demand") + F.col("safety_stock"), "eoq": eoq})
    plan = plan.withColumns(
        {
            "orders_per_year": F.when(F.col("eoq") > 0, F.col("annual_demand") / F.nullif("eoq", F.lit(0.0))).otherwise(0.0),
            "annual_holding_cost": F.when(F.col("eoq") > 0, F.col("eoq") / 2 * holding).otherwise(0.0),
            "expected_stockout_cost": F.col("stockout_prob") * demand * lead * per_unit,
        }
    )
    return plan.withColumn("annual_ordering_cost", F.col("orders_per_year") * ordering_cost).withColumn(
        "total_annual_cost", F.col("annual_ordering_cost") + F.col("annual_holding_cost")
    )


def inventory_plan(forecasts: DataFrame, by: Sequence[str] = PLAN_KEYS, **parameters) -> DataFrame:
    """Safety stock, reorder point, order quantity and yearly costs."""
    return with_plan(demand_profile(forecasts, by), **parameters).drop("total")


def _gained(model_mape: Column | float, base_mape: Column | float) -> Column:
    """MAPE points that the model saves."""
    model, base = (x if isinstance(x, Column) else F.lit(float(x)) for x in (model_mape, base_mape))
    return base - model


def business_impact(
    plan: DataFrame,
    model_mape: Column | float,
    base_mape: Column | float,
    unit_cost: float = 25.0,
    holding_rate: float = 0.2,
) -> DataFrame:
    """Yearly savings of a more accurate forecast, half of it as stockouts; the
    MAPEs are those measured for the served model and for the baseline."""
    gained = _gained(model_mape, base_mape)
    units = F.col("annual_demand") * (gained / 100.0)
    impact = plan.select(
        *[c for c in plan.columns if c in PLAN_KEYS],
        gained.alias("mape_improvement_pct"),
        units.alias("units_better_estimated"),
        (units * unit_cost * holding_rate).alias("excess_holding_savings"),
        (units * unit_cost * 2.0 * 0.5).alias("stockout_savings"),
    )
    total = F.col("excess_holding_savings") + F.col("stockout_savings")
    return impact.withColumns(
        {"total_annual_savings": total, "cost_per_mape_pct": F.when(gained > 0, total / gained).otherwise(0.0)}
    )


def abc_by_rank(totals: DataFrame, value: str = "total", ties: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """Top fifth by value A, next three tenths B, the rest C; no class without a value."""
    ranked = number_globally(totals.filter(F.col(value).isNotNull()), value, ties)
    share = F.col("row_no") / ranked.agg(F.count("*")).scalar()
    classed = ranked.withColumn("abc", F.when(share <= 0.20, "A").when(share <= 0.50, "B").otherwise("C"))
    without = totals.filter(F.col(value).isNull()).withColumn("abc", F.lit(None).cast("string"))
    return classed.select(*without.columns).unionByName(without)


def portfolio(forecasts: DataFrame, stats: DataFrame, selection: DataFrame) -> DataFrame:
    """Per known category: served model, forecast mean and total, historical
    mean, class, and a flag when forecast and history are not of one scale. A
    category without a forecast stays, with the model ``ERROR`` and no total."""
    totals = forecasts.groupBy("category").agg(
        F.avg("forecast").alias("_mean"), half_up(F.sum("forecast"), 1).alias("total_7d")
    )
    ratio = F.try_divide(half_up(F.col("_mean"), 3), F.col("historical_avg"))
    off = (F.col("_mean") > 0) & (F.col("historical_avg") > 0) & ~((ratio > 0.3) & (ratio < 3.0))
    return (
        stats.select("category", F.col("avg_daily_demand").alias("historical_avg"))
        .join(abc_by_rank(totals, "total_7d"), "category", "full")
        .join(selection.select("category", "selected_model", "confidence"), "category", "left")
        .select(
            "category",
            F.when(F.col("total_7d").isNotNull(), F.coalesce(F.upper("selected_model"), F.lit("ERROR"))).otherwise("ERROR").alias("model"),
            half_up(F.col("_mean"), 3).alias("avg_daily_forecast"),
            "total_7d",
            "historical_avg",
            "confidence",
            "abc",
            F.coalesce(off, F.lit(False)).alias("scaling_flag"),
        )
        .orderBy(F.desc("total_7d"), "category")
    )


def routing_counts(portfolio_rows: DataFrame) -> DataFrame:
    return portfolio_rows.groupBy("model").agg(F.count("*").alias("categories"), F.sum("total_7d").alias("total_7d"))


def _spread(profile: DataFrame, name: str, values: Sequence[float]) -> DataFrame:
    return profile.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))


def demand_spike(forecasts: DataFrame, uplifts: Sequence[float] = (0, 50, 100, 200), **parameters) -> DataFrame:
    """The plan at scaled demand against the plan at forecast demand. Scaling
    the forecast scales its mean and its deviation alike."""
    profile = demand_profile(forecasts)
    base = with_plan(profile, **parameters).select(
        "category",
        F.col("avg_daily_demand"),
        "avg_std",
        F.col("reorder_point").alias("base_reorder_point"),
        F.col("safety_stock").alias("base_safety_stock"),
        F.col("total_annual_cost").alias("base_cost"),
    )
    factor = F.lit(1.0) + F.col("uplift_pct") / 100.0
    scaled = _spread(base, "uplift_pct", uplifts).withColumns(
        {"avg_daily_demand": F.col("avg_daily_demand") * factor, "avg_std": F.col("avg_std") * factor}
    )
    plan = with_plan(scaled, **parameters)
    return plan.select(
        "category",
        "uplift_pct",
        "reorder_point",
        "safety_stock",
        "total_annual_cost",
        "eoq",
        (F.col("reorder_point") - F.col("base_reorder_point")).alias("reorder_point_delta"),
        (F.col("safety_stock") - F.col("base_safety_stock")).alias("safety_stock_delta"),
        (F.col("total_annual_cost") - F.col("base_cost")).alias("cost_delta"),
    )


def service_level_curve(
    forecasts: DataFrame, levels: Sequence[float] = SERVICE_LEVELS, **parameters
) -> DataFrame:
    rows = _spread(demand_profile(forecasts), "service_level", levels)
    return with_plan(rows, service_level=F.col("service_level"), **parameters).select(
        "category", "service_level", "safety_stock"
    )


def lead_time_curve(forecasts: DataFrame, lead_times: Sequence[float] = LEAD_TIMES, **parameters) -> DataFrame:
    rows = _spread(demand_profile(forecasts), "lead_time_days", lead_times)
    return with_plan(rows, lead_time=F.col("lead_time_days"), **parameters).select(
        "category", "lead_time_days", "reorder_point"
    )


def executive_summary(
    portfolio_rows: DataFrame,
    forecasts: DataFrame,
    model_mape: Column | float,
    base_mape: Column | float,
    lead_time: float = 7,
    unit_cost: float = 25.0,
    holding_rate: float = 0.2,
) -> DataFrame:
    """One row: total demand, stock value over the lead time, savings, routing."""
    gained = _gained(model_mape, base_mape)
    total = forecasts.agg(F.sum("forecast")).scalar()
    daily = F.col("total_7d_demand") / 7.0
    counted = portfolio_rows.agg(
        F.count("*").alias("total_categories"),
        F.count_if(F.col("model") == "GBM").alias("gbm_routed"),
    )
    return counted.withColumn("total_7d_demand", total).select(
        "total_categories",
        "total_7d_demand",
        daily.alias("avg_daily_total"),
        (daily * lead_time * unit_cost).alias("inventory_value"),
        (daily * 365 * (gained / 100.0) * unit_cost * (holding_rate + 2.0 * 0.5)).alias("est_annual_savings"),
        gained.alias("mape_points_gained"),
        "gbm_routed",
        (F.col("total_categories") - F.col("gbm_routed")).alias("other_routed"),
    )


def forecast_export(forecasts: DataFrame) -> DataFrame:
    """Day, forecast and bounds per category, ready for a CSV sink."""
    return forecasts.select(
        "category",
        F.col("day"),
        F.col("forecast").alias("forecast_units"),
        F.col("lower").alias("lower_95"),
        F.col("upper").alias("upper_95"),
    ).orderBy("category", "day")
