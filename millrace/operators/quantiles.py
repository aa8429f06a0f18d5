"""Exact interpolated quantiles of groups of any size.

Spark's own exact percentile holds the distinct values of a group in one task.
Here the rows are numbered in (group, value) order by range partitions, and
only the two rows next to each wanted position are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.global_order import number_globally


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], ties: Sequence[str]
) -> DataFrame:
    """(by..., prob, quantile, n): position ``prob * (n - 1)`` of the sorted
    non-NULL values, linear between neighbours. ``ties`` spread equal values."""
    rows = df.filter(F.col(value).isNotNull()).select(
        F.struct(*by).alias("_group"), F.col(value).cast("double").alias("_value"), *[F.col(t) for t in ties if t not in by]
    )
    numbered = number_globally(rows, "_group", ["_value", *[t for t in ties if t not in by]], descending=False)
    spans = numbered.groupBy("_group").agg(F.min("row_no").alias("_first"), F.count("*").alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    spot = F.col("prob") * (F.col("n") - 1)
    targets = spans.select("_group", "n", "_first", wanted).select(
        "_group",
        "n",
        "prob",
        (spot - F.floor(spot)).alias("_part"),
        F.explode(F.array_distinct(F.array(F.floor(spot), F.ceil(spot)))).alias("_at"),
        "_first",
    ).withColumn("row_no", F.col("_first") + F.col("_at"))
    # one or two rows per group and quantile meet the numbered rows on their number
    hits = targets.join(numbered.select("row_no", "_value"), "row_no")
    low, high = F.min("_value"), F.max("_value")
    return hits.groupBy("_group", "prob").agg(
        F.first("n").alias("n"), (low + (high - low) * F.first("_part")).alias("quantile")
    ).select("_group.*", "prob", "quantile", "n")
