"""Seller reliability, delay cost, review signals and combined risk.

Reviews are reduced to one row per order before the join. A review counts once
per item of its order, and sums over order lines of per-order review totals
give the same numbers without multiplying rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.fixed_values import (
    LEAD_RISK_CATEGORY,
    LEAD_RISK_LEVEL,
    SENTIMENT_TREND,
    SEVERITY,
    SUPPLIER_RISK,
    WARNING_LEVEL,
)
from millrace.functions.numeric import count_when, exact, half_up, null_aware_greatest, percent, ratio, sum_when
from millrace.functions.timing import delay_days, is_late, is_on_time, lead_days, month_label
from millrace.operators.global_order import bounded_dense_rank, order_globally
from millrace.operators.lines import order_lines


def seller_lead_time(orders: DataFrame, items: DataFrame, sellers: DataFrame, min_orders: int = 10) -> DataFrame:
    """Lead time, promise and delay per seller with a reliability rank."""
    arrived = orders.filter(F.col("delivered_ts").isNotNull() & F.col("purchase_ts").isNotNull())
    timed = order_lines(arrived, items).select(
        "seller_id",
        lead_days().alias("lead"),
        F.datediff("estimated_ts", "purchase_ts").alias("promised"),
        delay_days().alias("delay"),
    )
    stats = (
        timed.groupBy("seller_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.avg("lead").alias("lead"),
            F.avg("promised").alias("promised"),
            F.stddev_pop("lead").alias("spread"),
            F.avg("delay").alias("delay"),
            count_when(F.col("delay") > 0).alias("late_deliveries"),
            count_when(F.col("delay") <= 0).alias("kept"),
        )
        .filter(F.col("total_orders") >= min_orders)
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .withColumns({"spread": exact(F.col("spread")), "delay": exact(F.col("delay"))})
    )
    raw = F.lit(100.0) - F.col("delay").cast("double") * 5 - F.col("spread").cast("double") * 2
    high = (F.col("spread") > 10) & (F.col("delay") > 5)
    medium = (F.col("spread") > 5) | (F.col("delay") > 3)

    def banded(labels):
        return F.when(high, labels[0]).when(medium, labels[1]).otherwise(labels[2])

    scored = stats.withColumn("score", exact(null_aware_greatest(0.0, raw)))
    return (
        order_globally(scored, "score", ["seller_id"])
        .select(
            "seller_id",
            "seller_state",
            "total_orders",
            half_up(F.col("lead"), 1).alias("avg_lead_days"),
            half_up(F.col("promised"), 1).alias("avg_promised_days"),
            half_up(F.col("spread"), 2).alias("lead_time_stddev"),
            half_up(F.col("delay"), 1).alias("avg_delay_days"),
            "late_deliveries",
            half_up(percent(F.col("late_deliveries"), F.col("total_orders")), 1).alias("late_pct"),
            half_up(percent(F.col("kept"), F.col("total_orders")), 1).alias("on_time_pct"),
            banded(LEAD_RISK_LEVEL).alias("risk_level"),
            banded(LEAD_RISK_CATEGORY).alias("risk_category"),
            half_up(F.col("score"), 1).alias("reliability_score"),
            F.col("dense_rank").alias("seller_rank"),
        )
        .orderBy(F.desc("reliability_score"), "late_pct", "seller_id")
    )


def seller_cohort(orders: DataFrame, items: DataFrame) -> DataFrame:
    """On-time share by month of first sale and month of activity.

    One pass reduces lines to (seller, month); the first month is then a
    minimum over the months of one seller."""
    months = (
        order_lines(orders, items)
        .groupBy("seller_id", F.trunc("purchase_ts", "month").alias("activity"))
        .agg(
            count_when(F.col("delivered_ts").isNotNull()).alias("delivered"),
            count_when(is_on_time()).alias("on_time"),
        )
        .withColumn("cohort", F.min("activity").over(W.partitionBy("seller_id")))
        .filter(F.col("delivered") > 0)
    )
    elapsed = (F.year("activity") - F.year("cohort")) * 12 + F.month("activity") - F.month("cohort")
    return (
        months.groupBy("cohort", "activity")
        .agg(
            F.count("*").alias("active_sellers"),
            F.sum("delivered").alias("total_orders"),
            F.sum("on_time").alias("on_time"),
        )
        .select(
            month_label(F.col("cohort")).alias("cohort_month"),
            month_label(F.col("activity")).alias("activity_month"),
            elapsed.alias("months_since_join"),
            "active_sellers",
            "total_orders",
            half_up(percent(F.col("on_time"), F.col("total_orders")), 1).alias("on_time_pct"),
        )
        .orderBy("cohort_month", "months_since_join")
    )


def revenue_at_risk(
    orders: DataFrame, items: DataFrame, sellers: DataFrame, min_orders: int = 10, limit: int | None = 50
) -> DataFrame:
    """Cost of late deliveries per seller. Late items are set against distinct
    orders, so the delay rate can pass 100 for sellers of multi-item orders."""
    arrived = orders.filter(F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull())
    value = F.col("price") + F.col("freight")
    days_late = F.when(is_late(), delay_days())
    per_seller = (
        order_lines(arrived, items)
        .groupBy("seller_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            count_when(is_late()).alias("delayed_orders"),
            F.sum(value).alias("revenue"),
            sum_when(is_late(), value).alias("late_revenue"),
            F.avg(days_late).alias("late_days"),
            F.coalesce(F.max(days_late), F.lit(0)).alias("max_days_late"),
        )
        .withColumn("max_days_late", F.greatest("max_days_late", F.lit(0)))
        .filter((F.col("total_orders") >= min_orders) & (F.col("delayed_orders") > 0))
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
    )
    rate = percent(F.col("delayed_orders"), F.col("total_orders"))
    late_days = exact(F.col("late_days"))
    severe, moderate, minor = SEVERITY
    report = per_seller.select(
        "seller_id",
        "seller_state",
        "total_orders",
        "delayed_orders",
        half_up(rate, 1).alias("delay_rate_pct"),
        F.round("revenue", 2).alias("total_revenue"),
        F.round("late_revenue", 2).alias("revenue_at_risk"),
        half_up(percent(F.col("late_revenue"), F.col("revenue")), 2).alias("revenue_risk_pct"),
        half_up(F.col("late_days"), 1).alias("avg_days_late"),
        "max_days_late",
        F.when(late_days > 10, severe).when(late_days > 5, moderate).otherwise(minor).alias("delay_severity"),
        half_up(rate * 0.6 + F.col("late_days") * 0.4, 2).alias("supplier_risk_score"),
    ).orderBy(F.desc("supplier_risk_score"), F.desc("revenue_at_risk"), "seller_id")
    return report if limit is None else report.limit(limit)


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Review totals per order; sentiment is summed as a decimal, so exactly."""
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.sum("review_score").alias("stars"),
        F.sum(F.col("sentiment_score").cast("decimal(5,4)")).alias("sentiment"),
        count_when(F.col("review_score") <= 2).alias("bad"),
    )


def review_early_warning(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, min_reviews: int = 5
) -> DataFrame:
    """Review and delivery signal per seller and month with a risk rank."""
    usable = reviews.filter(F.col("review_score").isNotNull() & F.col("sentiment_score").isNotNull())
    monthly = (
        order_lines(orders, items)
        .join(reviews_per_order(usable), "order_id", "left")
        .groupBy("seller_id", F.trunc("purchase_ts", "month").alias("month"))
        .agg(
            F.sum("reviews").alias("total_reviews"),
            F.sum("stars").alias("stars"),
            F.sum("sentiment").alias("sentiment"),
            F.sum("bad").alias("bad_reviews"),
            count_when(F.col("delivered_ts").isNotNull()).alias("delivered"),
            count_when(is_on_time()).alias("on_time"),
        )
        .filter(F.col("total_reviews") >= min_reviews)
    )
    measured = monthly.withColumns(
        {
            "review_month": month_label(F.col("month")),
            "mood": exact(ratio(F.col("sentiment"), F.col("total_reviews"))),
            "bad_review_pct": half_up(percent(F.col("bad_reviews"), F.col("total_reviews")), 1),
            "on_time_pct": half_up(percent(F.col("on_time"), F.col("delivered")), 1),
        }
    )
    # a month without deliveries is shown as 0 % on time but scored as 100 %
    score = (
        F.col("bad_review_pct") * 0.5
        + (F.lit(100.0) - F.coalesce("on_time_pct", F.lit(100.0))) * 0.3
        + F.abs(F.col("mood").cast("double")) * 100 * 0.2
    )
    strong, negative, neutral, positive = SENTIMENT_TREND
    critical, warning, normal = WARNING_LEVEL
    shown = F.coalesce("on_time_pct", F.lit(0.0))
    return (
        order_globally(measured.withColumn("score", exact(score)), "score", ["seller_id", "review_month"])
        .select(
            "seller_id",
            "review_month",
            "total_reviews",
            half_up(ratio(F.col("stars"), F.col("total_reviews")), 2).alias("avg_star_rating"),
            half_up(F.col("mood"), 3).alias("avg_sentiment_score"),
            "bad_reviews",
            "bad_review_pct",
            shown.alias("on_time_delivery_pct"),
            half_up(F.lit(100.0) - shown, 1).alias("delivery_failure_pct"),
            F.when(F.col("mood") < F.lit("-0.30").cast("decimal(5,2)"), strong)
            .when(F.col("mood") < 0, negative)
            .when(F.col("mood") < F.lit("0.20").cast("decimal(5,2)"), neutral)
            .otherwise(positive)
            .alias("sentiment_trend"),
            half_up(F.col("score"), 2).alias("supply_risk_score"),
            F.when(F.col("score") >= 40, critical)
            .when(F.col("score") >= 25, warning)
            .otherwise(normal)
            .alias("early_warning_level"),
            F.col("dense_rank").alias("seller_risk_rank"),
        )
        .orderBy(F.desc("supply_risk_score"), F.desc("bad_review_pct"), "review_month", "seller_id")
    )


def supplier_risk(
    orders: DataFrame, items: DataFrame, sellers: DataFrame, reviews: DataFrame, limit: int | None = 100
) -> DataFrame:
    """Lead-time spread, delay, revenue at risk and sentiment of every seller.

    The four measures come from one aggregate over the order lines. With a
    ``limit`` the rank is taken over the limited rows: they are the head of
    the score order, so it equals the rank over all sellers."""
    scored_reviews = reviews_per_order(reviews.filter(F.col("sentiment_score").isNotNull()))
    arrived = F.col("delivered_ts").isNotNull() & F.col("purchase_ts").isNotNull()
    per_seller = (
        order_lines(orders, items)
        .join(scored_reviews, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            count_when(arrived).alias("arrived"),
            F.stddev_pop(F.when(arrived, lead_days())).alias("spread"),
            count_when(arrived & is_late()).alias("late"),
            sum_when(is_late(), F.col("price") + F.col("freight")).alias("late_revenue"),
            F.sum("reviews").alias("reviews"),
            F.sum("sentiment").alias("sentiment"),
            F.sum("bad").alias("bad"),
        )
    )
    measured = (
        sellers.select("seller_id", "seller_state")
        .join(per_seller, "seller_id", "left")
        .select(
            "seller_id",
            "seller_state",
            half_up(F.col("spread"), 2).alias("lead_time_variability"),
            half_up(percent(F.col("late"), F.col("arrived")), 2).alias("delay_pct"),
            F.round("late_revenue", 2).alias("revenue_at_risk"),
            half_up(ratio(F.col("sentiment"), F.col("reviews")), 3).alias("avg_sentiment"),
            half_up(percent(F.col("bad"), F.col("reviews")), 2).alias("bad_review_pct"),
        )
    )

    def known(name: str):
        return F.coalesce(name, F.lit(0.0))

    score = (
        known("delay_pct") * 0.35
        + known("lead_time_variability") * 1.5
        + known("bad_review_pct") * 0.25
        + F.abs(known("avg_sentiment")) * 100 * 0.15
    )
    measured = measured.withColumn("score", exact(score))
    if limit is None:
        ranked = order_globally(measured, "score", ["seller_id"]).withColumnRenamed("dense_rank", "supplier_rank")
    else:
        head = measured.orderBy(F.desc("score"), "seller_id").limit(limit)
        ranked = bounded_dense_rank(head, "score", "supplier_rank")
    critical, high, medium, low = SUPPLIER_RISK
    return ranked.select(
        "seller_id",
        "seller_state",
        "lead_time_variability",
        "delay_pct",
        "revenue_at_risk",
        "avg_sentiment",
        "bad_review_pct",
        half_up(F.col("score"), 2).alias("supplier_risk_score"),
        F.when(F.col("score") >= 50, critical)
        .when(F.col("score") >= 30, high)
        .when(F.col("score") >= 15, medium)
        .otherwise(low)
        .alias("risk_category"),
        "supplier_rank",
    ).orderBy(F.desc("supplier_risk_score"), "supplier_rank", "seller_id")
