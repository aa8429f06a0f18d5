"""Hours spent in each fulfilment stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.fixed_values import BOTTLENECK, STAGE_APPROVAL, STAGE_DELIVERY, STAGE_PICKUP
from millrace.functions.numeric import exact, half_up
from millrace.functions.timing import whole_hours


def fulfilment_stages(orders: DataFrame, max_hours: int = 720) -> DataFrame:
    """Mean, maximum, spread and count of whole hours per stage, with the
    slowest stage flagged.

    All three stages are aggregated in one scan into one row, which is then
    turned into three; a stage without orders still gets its row."""
    spans = {
        STAGE_APPROVAL: ("purchase_ts", "approved_ts"),
        STAGE_PICKUP: ("approved_ts", "carrier_ts"),
        STAGE_DELIVERY: ("carrier_ts", "delivered_ts"),
    }
    complete = orders.filter(
        F.col("delivered_ts").isNotNull() & F.col("approved_ts").isNotNull() & F.col("carrier_ts").isNotNull()
    )
    measures = []
    for position, (start, end) in enumerate(spans.values()):
        hours = whole_hours(F.col(start), F.col(end))
        usual = F.when(hours.between(0, max_hours), hours)
        measures += [
            half_up(F.avg(usual), 1).alias(f"avg_{position}"),
            F.max(usual).alias(f"max_{position}"),
            half_up(F.stddev_pop(usual), 1).alias(f"std_{position}"),
            F.count(usual).alias(f"n_{position}"),
        ]
    wide = complete.agg(*measures)
    rows = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.col(f"avg_{i}").alias("avg_hours"),
            F.col(f"max_{i}").cast("double").alias("max_hours"),
            F.col(f"std_{i}").alias("stddev_hours"),
            F.col(f"n_{i}").alias("order_count"),
        )
        for i, stage in enumerate(spans)
    ]
    slowest = F.greatest("avg_0", "avg_1", "avg_2")
    return (
        wide.select(slowest.alias("slowest"), F.inline(F.array(*rows)))
        .select(
            "stage",
            "avg_hours",
            half_up(exact(F.col("avg_hours")) / 24, 1).alias("avg_days"),
            "max_hours",
            "stddev_hours",
            "order_count",
            F.when(F.col("avg_hours") == F.col("slowest"), BOTTLENECK).otherwise("").alias("bottleneck_flag"),
        )
        .orderBy(F.desc("avg_hours"), "stage")
    )
