"""Prediction intervals from residuals and their calibration.

Predictions are long rows keyed by (category, idx, horizon) with ``actual`` and
``predicted``. Quantiles are exact at any group size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.quantiles import exact_quantiles

LEVELS = (0.8, 0.95)


def _ends(levels: Sequence[float]) -> list[float]:
    return sorted({round(p, 6) for level in levels for p in ((1 - level) / 2, 1 - (1 - level) / 2)})


def residual_intervals(
    pred: DataFrame,
    levels: Sequence[float] = LEVELS,
    by: Sequence[str] = ("horizon",),
    ties: Sequence[str] = ("category", "idx"),
) -> DataFrame:
    """(by..., level, lower_offset, upper_offset): central residual quantiles."""
    residuals = pred.withColumn("_residual", F.col("actual") - F.col("predicted"))
    quantiles = exact_quantiles(residuals, by, "_residual", _ends(levels), ties)

    def at(p: float) -> Column:
        return F.max(F.when(F.col("prob") == round(p, 6), F.col("quantile")))

    wide = quantiles.groupBy(*by).agg(
        *[
            F.struct(at((1 - level) / 2).alias("lower_offset"), at(1 - (1 - level) / 2).alias("upper_offset")).alias(f"_l{i}")
            for i, level in enumerate(levels)
        ]
    )
    rows = [
        F.struct(F.lit(float(level)).alias("level"), f"_l{i}.lower_offset", f"_l{i}.upper_offset")
        for i, level in enumerate(levels)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def apply_intervals(forecast: DataFrame, offsets: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Forecast rows times levels, with bounds not under 0. The offsets have one
    row per horizon and level (and per category only if fitted so)."""
    joined = forecast.join(offsets, list(by))
    return joined.withColumns(
        {
            "lower": F.greatest(F.col("predicted") + F.col("lower_offset"), F.lit(0.0)),
            "upper": F.greatest(F.col("predicted") + F.col("upper_offset"), F.lit(0.0)),
        }
    ).drop("lower_offset", "upper_offset")


def quantile_bounds(
    pred: DataFrame,
    fit: Column,
    levels: Sequence[float] = LEVELS,
    by: Sequence[str] = ("horizon", "category"),
) -> DataFrame:
    """Lower and upper bounds of each prediction that ``fit`` does not mark,
    from the residuals of those it marks, by horizon and category."""
    return apply_intervals(pred.filter(~fit), residual_intervals(pred.filter(fit), levels, by), by)


def ordered_bounds(bounds: DataFrame) -> DataFrame:
    return bounds.withColumns({"lower": F.least("lower", "upper"), "upper": F.greatest("lower", "upper")})


def conformal_pad(
    bounds: DataFrame,
    calibration: Column | None = None,
    levels: Sequence[float] = LEVELS,
    by: Sequence[str] = ("horizon",),
    ties: Sequence[str] = ("category", "idx"),
    tolerance: float = 0.07,
) -> DataFrame:
    """Per horizon and level: how far to widen so that the level is met, with
    coverage and width before and after.

    ``calibration`` marks the rows the pad is fitted on, coverage is reported
    on the others; by default all rows serve both ends."""
    rows = ordered_bounds(bounds)
    actual, lower, upper = F.col("actual"), F.col("lower"), F.col("upper")
    rows = rows.withColumn("_miss", F.greatest(lower - actual, actual - upper, F.lit(0.0)))
    fit = rows if calibration is None else rows.filter(calibration)
    report = rows if calibration is None else rows.filter(~calibration)
    keys = [*by, "level"]
    pads = exact_quantiles(fit, keys, "_miss", levels, ties).filter(F.col("prob") == F.col("level"))
    padded = report.join(pads.select(*keys, F.col("quantile").alias("conformal_pad")), keys)
    pad = F.col("conformal_pad")
    inside = (actual >= lower) & (actual <= upper)
    inside_padded = (actual >= lower - pad) & (actual <= upper + pad)
    summary = padded.groupBy(*keys).agg(
        F.first("conformal_pad").alias("conformal_pad"),
        F.avg(inside.cast("double")).alias("raw_coverage"),
        F.avg(inside_padded.cast("double")).alias("padded_coverage"),
        F.avg(upper - lower).alias("raw_width"),
        F.avg(upper - lower + 2 * pad).alias("padded_width"),
    )
    return summary.withColumns(
        {
            "well_calibrated_raw": F.abs(F.col("raw_coverage") - F.col("level")) < tolerance,
            "well_calibrated": F.abs(F.col("padded_coverage") - F.col("level")) < tolerance,
        }
    )


def apply_pad(bounds: DataFrame, pads: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    keys = [*by, "level"]
    return (
        ordered_bounds(bounds)
        .join(pads.select(*keys, "conformal_pad"), keys)
        .withColumns(
            {
                "lower": F.greatest(F.col("lower") - F.col("conformal_pad"), F.lit(0.0)),
                "upper": F.col("upper") + F.col("conformal_pad"),
            }
        )
        .drop("conformal_pad")
    )
