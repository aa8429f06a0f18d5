"""One batch from feature rows to served forecasts with calibrated intervals.

Takes the place of per-request serving: every category is scored in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.backtest import chronological_split
from millrace.operators.features import scaler_fit
from millrace.operators.intervals import LEVELS, apply_intervals, apply_pad, conformal_pad, residual_intervals
from millrace.operators.models import (
    HorizonModels,
    TreeParams,
    before_holdout,
    long_forecasts,
    model_rows,
    score_forecasts,
    scoring_rows,
    train_horizon_models,
)
from millrace.session import materialize


@dataclass(frozen=True)
class ForecastRun:
    models: HorizonModels
    scaler: DataFrame
    held_out: DataFrame
    offsets: DataFrame
    pads: DataFrame
    served: DataFrame


def forecast_run(
    features: DataFrame,
    params: TreeParams = TreeParams(),
    horizon: int = 7,
    levels: Sequence[float] = LEVELS,
    es: float = 0.10,
    holdout: float = 0.07,
    as_of: Column | None = None,
) -> ForecastRun:
    """Train on the early part of each series, take residual intervals and
    their padding from the held-out tail, and score the newest row, or that of
    the day ``as_of`` up to which demand is complete.

    Days that overlap the held-out tail through their targets are not trained
    on. The pad is fitted on every other held-out day and reported on the rest.
    ``served`` has (category, as_of, horizon, level, predicted, lower, upper)."""
    features = materialize(features)
    tail = chronological_split(
        features.withColumn("row_idx", F.datediff("sale_date", F.lit("1970-01-01"))), es, holdout
    )
    scaler = materialize(scaler_fit(tail.filter(F.col("split") != "holdout")))
    split = materialize(chronological_split(model_rows(features, scaler, horizon), es, holdout))
    models = train_horizon_models(before_holdout(split, horizon), params, horizon)
    held = split.filter(F.col("split") == "holdout")
    held_out = materialize(
        long_forecasts(models.predict(held), scaler, list(models.by_day), ["category", F.col("row_idx").alias("idx"), "sale_date"])
    )
    offsets = materialize(residual_intervals(held_out, levels))
    bounds = apply_intervals(held_out, offsets)
    pads = materialize(conformal_pad(bounds, F.col("idx") % 2 == 0, levels))
    newest = score_forecasts(models, scoring_rows(features, scaler, as_of), scaler).withColumnRenamed("yhat", "predicted")
    served = apply_pad(apply_intervals(newest, offsets), pads)
    return ForecastRun(models, scaler, held_out, offsets, pads, served)


def as_plan_input(served: DataFrame, level: float = 0.95) -> DataFrame:
    """Served forecasts at one level as (category, day, forecast, lower, upper)."""
    return served.filter(F.col("level") == level).select(
        "category", F.col("horizon").alias("day"), F.col("predicted").alias("forecast"), "lower", "upper"
    )
