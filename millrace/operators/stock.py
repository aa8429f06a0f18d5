"""Product stock rules: reorder points and revenue classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.fixed_values import (
    ABC_POLICY_A,
    ABC_POLICY_B,
    ABC_POLICY_C,
    ABC_PRIORITY,
    DELIVERED,
    VELOCITY,
)
from millrace.functions.numeric import count_when, half_up, percent, ratio
from millrace.functions.timing import lead_days
from millrace.operators.global_order import order_globally
from millrace.operators.lines import order_lines


def reorder_point(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    min_active_days: int = 30,
    z: float = 1.65,
    default_lead: float = 7,
) -> DataFrame:
    """Mean daily sales, lead time, safety stock and reorder point per product.

    Sales come from delivered orders, lead time from every order with a
    delivery date; both are taken from the same (product, day) aggregate. The
    means are rounded before they enter the formula."""
    days = (
        order_lines(orders, items)
        .groupBy("product_id", F.to_date("purchase_ts").alias("day"))
        .agg(
            count_when(F.col("order_status") == DELIVERED).alias("units"),
            F.sum(lead_days()).alias("lead_sum"),
            F.count(lead_days()).alias("lead_rows"),
        )
    )
    sold = F.when(F.col("units") > 0, F.col("units"))
    stats = (
        days.groupBy("product_id")
        .agg(
            half_up(F.avg(sold), 2).alias("avg_daily_sales"),
            half_up(F.stddev_pop(sold), 2).alias("sales_stddev"),
            F.count(F.when(sold.isNotNull(), F.col("day"))).alias("active_days"),
            half_up(ratio(F.sum("lead_sum"), F.sum("lead_rows")), 1).alias("lead"),
        )
        .filter(F.col("active_days") >= min_active_days)
        .withColumn("avg_lead_days", F.coalesce("lead", F.lit(float(default_lead))))
    )
    safety = F.lit(float(z)) * F.col("sales_stddev") * F.sqrt("avg_lead_days")
    fast, regular, slow = VELOCITY
    return (
        stats.join(products.select("product_id", "category"), "product_id")
        .select(
            "product_id",
            "category",
            "avg_daily_sales",
            "avg_lead_days",
            "sales_stddev",
            half_up(safety, 0).alias("safety_stock"),
            half_up(F.col("avg_daily_sales") * F.col("avg_lead_days") + safety, 0).alias("reorder_point"),
            F.when(F.col("avg_daily_sales") > 5, fast)
            .when(F.col("avg_daily_sales") > 1, regular)
            .otherwise(slow)
            .alias("velocity_class"),
        )
        .orderBy(F.desc("avg_daily_sales"), "product_id")
    )


def abc_analysis(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue rank, share, running share and ABC class of every product.

    Items are summed per product before the join. Rank and running total use
    the range-partitioned order; the category mean is a grouped join, because a
    window per category would put a hot category into one task."""
    revenue = (
        items.groupBy("product_id")
        .agg(F.count("*").alias("total_units"), F.round(F.sum("price"), 2).alias("total_revenue"))
        .join(products.filter(F.col("category").isNotNull()).select("product_id", "category"), "product_id")
    )
    ranked = order_globally(revenue, "total_revenue", ["product_id"], running="total_revenue")
    whole = ranked.agg(F.struct(F.sum("total_revenue").alias("total"), F.count("*").alias("n"))).scalar()
    by_category = ranked.groupBy("category").agg(
        half_up(ratio(F.sum("total_revenue"), F.count("*")), 2).alias("avg_category_revenue")
    )
    share = half_up(percent(F.col("running_total"), whole["total"]), 1)
    is_a, is_b = F.col("cumulative_pct") <= 80, F.col("cumulative_pct") <= 95

    def by_class(a, b, c):
        return F.when(is_a, a).when(is_b, b).otherwise(c)

    return (
        ranked.withColumn("cumulative_pct", share)
        .join(by_category, "category")
        .select(
            "product_id",
            "category",
            F.col("dense_rank").alias("revenue_rank"),
            "total_units",
            "total_revenue",
            half_up(percent(F.col("total_revenue"), whole["total"]), 3).alias("revenue_share_pct"),
            "cumulative_pct",
            half_up(
                F.coalesce(ratio(F.col("rank") - 1, whole["n"] - 1), F.lit(0.0)) * 100, 2
            ).alias("revenue_percentile_pct"),
            by_class("A", "B", "C").alias("abc_class"),
            by_class(ABC_POLICY_A, ABC_POLICY_B, ABC_POLICY_C).alias("inventory_policy"),
            by_class(*ABC_PRIORITY).alias("inventory_priority_score"),
            "avg_category_revenue",
        )
        .orderBy(F.desc("total_revenue"), "product_id")
    )
