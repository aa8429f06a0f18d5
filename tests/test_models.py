"""Trees over many categories, and what must not leak into a test window."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import backtest, features, intervals, models

FEW = models.TreeParams(max_iter=2, max_depth=2, min_rows=1)


def rows(spark, categories, days, bump_from=None):
    """Daily demand by category; ``bump_from`` multiplies the demand from that day on."""
    demand = F.col("day") % 7 + F.col("c") % 5 + 1
    if bump_from is not None:
        demand = F.when(F.col("day") >= bump_from, demand * 50).otherwise(demand)
    return (
        spark.range(categories).withColumnRenamed("id", "c")
        .select("c", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day"))
        .select(
            F.concat(F.lit("category "), F.col("c")).alias("category"),
            F.date_add(F.lit("2020-01-01").cast("date"), "day").alias("sale_date"),
            demand.cast("long").alias("units_sold"),
        )
    )


def matrix(spark, categories, days):
    data = rows(spark, categories, days).withColumn("units_sold", F.col("units_sold").cast("double"))
    for name in features.FEATURES:
        if name not in data.columns:
            data = data.withColumn(name, F.col("units_sold") * 0.5)
    return backtest.chronological_split(features.horizon_targets(data, 1))


def test_many_categories_train(spark):
    """No list of labels on the driver, and bins do not grow with categories."""
    fitted = models.train_horizon_models(matrix(spark, 50_000, 9), FEW, horizon=1)
    assert not hasattr(fitted, "labels") and fitted.by_day[1].getMaxBins() == 32
    unseen = matrix(spark, 1, 9).withColumn("category", F.lit("never seen"))
    assert fitted.predict(unseen).where("yhat_d1 is null").count() == 0


def test_seasonality_knows_only_days_before_the_fold(spark):
    def train_rows(bump_from):
        table = rows(spark, 2, 300, bump_from).withColumn("seasonality_index", F.lit(None).cast("double"))
        numbered = models.numbered(table)
        return sorted(features.with_seasonality(numbered, numbered.where("idx < 200")).where("idx < 200").collect())

    assert train_rows(None) == train_rows(200)


def test_targets_of_used_rows_end_before_the_holdout(spark):
    split = backtest.chronological_split(features.horizon_targets(rows(spark, 3, 120), 7), 0.1, 0.1)
    used = models.before_holdout(split, 7)
    first = split.where("split = 'holdout'").groupBy("category").agg(F.min("row_idx").alias("held"))
    assert used.join(first, "category").where("row_idx + 7 >= held").count() == 0
    assert used.count() == split.where("split <> 'holdout'").count() - 3 * 7


def test_bounds_are_not_judged_on_the_rows_they_come_from(spark):
    pred = spark.range(200).select(
        F.lit("a").alias("category"), F.lit(1).alias("horizon"), F.col("id").alias("idx"),
        F.when(F.col("id") < 100, 5.0).otherwise(500.0).alias("actual"), F.lit(5.0).alias("predicted"),
    )
    bounds = intervals.quantile_bounds(pred, F.col("idx") < 100)
    assert bounds.agg(F.min("idx"), F.max("upper")).first()[:] == (100, pytest.approx(5.0))
