"""Forecast metrics, diagnostics, tests and labels. Predictions are long rows
with ``actual`` and ``predicted``; ``by`` names the grain of the result."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.fixed_values import COVERAGE_HIGH, COVERAGE_LOW, COVERAGE_NONE, COVERAGE_OK, LIFT
from millrace.functions.numeric import count_when

METRICS = ("mape", "smape", "rmse", "mae", "bias", "mase")


def naive_scale(train: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean absolute day-to-day change of the training part, NULL when 0."""
    step = F.abs(F.col("y") - F.lag("y").over(W.partitionBy(*by).orderBy("idx")))
    scale = train.withColumn("_step", step).groupBy(*by).agg(F.avg("_step").alias("naive_error"))
    return scale.withColumn("naive_error", F.nullif("naive_error", F.lit(0.0)))


def metric_columns() -> list[Column]:
    actual, predicted = F.col("actual"), F.col("predicted")
    off = F.abs(actual - predicted)
    positive = actual > 0
    middle = (F.abs(actual) + F.abs(predicted)) / 2
    return [
        F.when(count_when(positive) >= 5, F.avg(F.when(positive, F.try_divide(off, actual))) * 100).alias("mape"),
        F.when(count_when(middle > 0) >= 5, F.avg(F.when(middle > 0, F.try_divide(off, middle))) * 100).alias("smape"),
        F.sqrt(F.avg((actual - predicted) * (actual - predicted))).alias("rmse"),
        F.avg(off).alias("mae"),
        F.avg(predicted - actual).alias("bias"),
    ]


def forecast_metrics(pred: DataFrame, by: Sequence[str], scale: DataFrame | None = None) -> DataFrame:
    """MAPE and sMAPE (NULL under five usable points), RMSE, MAE, bias and, with
    a scale table from ``naive_scale``, MASE."""
    metrics = pred.groupBy(*by).agg(*metric_columns())
    if scale is None:
        return metrics.withColumn("mase", F.lit(None).cast("double"))
    keys = [c for c in scale.columns if c != "naive_error"]
    return (
        metrics.join(scale, keys, "left")
        .withColumn("mase", F.try_divide(F.col("mae"), F.col("naive_error")))
        .drop("naive_error")
    )


def interval_coverage(pred: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of actuals inside their interval and what it says about it."""
    inside = (F.col("actual") >= F.col("lower")) & (F.col("actual") <= F.col("upper"))
    covered = pred.groupBy(*by).agg((F.avg(inside.cast("double")) * 100).alias("coverage"))
    share = F.col("coverage")
    return covered.withColumn(
        "coverage_quality",
        F.when(share.isNull(), COVERAGE_NONE)
        .when(share < 80, COVERAGE_LOW)
        .when(share > 95, COVERAGE_HIGH)
        .otherwise(COVERAGE_OK),
    )


def fold_average(metrics: DataFrame, by: Sequence[str], columns: Sequence[str] = METRICS) -> DataFrame:
    """Metrics averaged over folds; folds without a value do not count."""
    kept = [c for c in columns if c in metrics.columns]
    return metrics.groupBy(*by).agg(*[F.avg(c).alias(c) for c in kept], F.count("*").alias("n_folds"))


def residual_diagnostics(pred: DataFrame, by: Sequence[str]) -> DataFrame:
    """Spread and weekend shift of the residual ``actual - predicted``."""
    residual = F.col("actual") - F.col("predicted")
    weekend = F.weekday("sale_date") >= 5
    close = F.abs(residual / (F.col("actual") + 1e-6)) < 0.20
    return (
        pred.groupBy(*by)
        .agg(
            F.avg(residual).alias("mean_residual"),
            F.stddev_pop(residual).alias("std_residual"),
            F.max(residual).alias("max_overforecast"),
            F.min(residual).alias("max_underforecast"),
            count_when(F.col("actual") == 0).alias("zero_day_count"),
            (F.avg(close.cast("double")) * 100).alias("pct_within_20pct"),
            (F.avg(F.when(weekend, residual)) - F.avg(F.when(~weekend, residual))).alias("weekend_bias"),
        )
        .withColumn("has_weekend_bias", F.coalesce(F.abs("weekend_bias") > 1.0, F.lit(False)))
    )


def two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| > |t|) of Student's t with whole degrees of freedom, from the
    finite cosine series, as one built-in expression."""
    angle = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    cos2 = F.cos(angle) * F.cos(angle)
    odd = df % 2 == 1

    def series(terms: Column, first: Column, numerator, denominator) -> Column:
        start = F.struct(first.alias("term"), first.alias("total"))

        def step(acc, k):
            term = acc["term"] * cos2 * numerator(k) / denominator(k)
            return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

        ks = F.when(terms >= 1, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(ks, start, step, lambda acc: acc["total"])

    odd_terms = ((df - 3) / 2).cast("int")
    even_terms = ((df - 2) / 2).cast("int")
    inside_odd = (2 / math.pi) * (
        angle
        + F.when(df > 1, F.sin(angle) * series(odd_terms, F.cos(angle), lambda k: 2.0 * k, lambda k: 2.0 * k + 1)).otherwise(0.0)
    )
    inside_even = F.sin(angle) * series(even_terms, F.lit(1.0), lambda k: 2.0 * k - 1, lambda k: 2.0 * k)
    return F.lit(1.0) - F.when(odd, inside_odd).otherwise(inside_even)


def paired_error_test(
    pred: DataFrame, model_a: str, model_b: str, by: Sequence[str] = ("category",), max_gap: float = 5.0
) -> DataFrame:
    """One-sample t test on the difference of absolute errors of two models.

    Made only where their mean fold MAPEs lie within ``max_gap`` points. Both
    models are read in one pass: errors are paired by grouping, not by a join."""
    point = [*by, "fold", "idx"]
    error = F.abs(F.col("actual") - F.col("predicted"))

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, error))

    both = pred.filter(F.col("model").isin(model_a, model_b))
    gaps = both.groupBy(*point).agg((of(model_a) - of(model_b)).alias("gap"))
    stats = gaps.groupBy(*by).agg(
        F.count("gap").alias("n"), F.avg("gap").alias("mean_gap"), F.stddev_samp("gap").alias("sd")
    )
    fold_mape = forecast_metrics(both, ["model", *by, "fold"])
    mapes = fold_mape.groupBy(*by).agg(
        F.avg(F.when(F.col("model") == model_a, F.col("mape"))).alias("mape_a"),
        F.avg(F.when(F.col("model") == model_b, F.col("mape"))).alias("mape_b"),
    )
    tested = stats.join(mapes, list(by)).filter((F.abs(F.col("mape_a") - F.col("mape_b")) < max_gap) & (F.col("n") >= 3))
    t = F.try_divide(F.col("mean_gap"), F.col("sd") / F.sqrt("n"))
    return (
        tested.withColumn("t", t)
        .withColumn("p", two_sided_p(F.col("t"), F.col("n") - 1))
        .select(
            *by,
            F.lit(model_a).alias("model_a"),
            F.lit(model_b).alias("model_b"),
            "n",
            "t",
            "p",
            (F.col("p") < 0.05).alias("significant"),
            F.when(F.col("p") < 0.05, F.when(F.col("t") < 0, model_a).otherwise(model_b)).alias("better"),
        )
    )


def skill(model_mape: Column, base_mape: Column) -> Column:
    """Improvement on the base in percent; NULL without both."""
    return F.try_divide(base_mape - model_mape, base_mape) * 100


def forecast_skill(df: DataFrame, model: str = "mape", base: str = "baseline_mape") -> DataFrame:
    return df.withColumn("skill_pct", skill(F.col(model), F.col(base)))


def skill_tables(category_board: DataFrame) -> DataFrame:
    """(comparison, category, skill_pct): three pairings of a category board."""
    pairs = {
        "gbm_vs_baseline": ("gbm_mape", "baseline_mape"),
        "lstm_vs_baseline": ("lstm_mape", "baseline_mape"),
        "gbm_vs_lstm": ("gbm_mape", "lstm_mape"),
    }
    rows = [
        F.struct(F.lit(name).alias("comparison"), skill(F.col(a), F.col(b)).alias("skill_pct"))
        for name, (a, b) in pairs.items()
    ]
    return category_board.select("category", F.inline(F.array(*rows))).select("comparison", "category", "skill_pct")


def skill_summary(tables: DataFrame) -> DataFrame:
    return tables.groupBy("comparison").agg(
        F.avg("skill_pct").alias("avg_pct"), F.count("skill_pct").alias("n_categories_compared")
    )


def noise_threshold(
    fold_metrics: DataFrame, column: str = "mape", fallback: float = 1.5, by: Sequence[str] = ("category",)
) -> DataFrame:
    """One row: mean over categories of the fold-to-fold deviation."""
    spread = fold_metrics.groupBy(*by).agg(F.stddev_pop(column).alias("_sd"), F.count(column).alias("_n"))
    return spread.filter(F.col("_n") >= 2).agg(
        F.coalesce(F.avg("_sd"), F.lit(float(fallback))).alias("threshold")
    )


def lift_label(lift: Column, threshold: Column) -> Column:
    beat, loses, none, unknown = LIFT
    return (
        F.when(lift.isNull() | F.isnan(lift), unknown)
        .when(lift > threshold, beat)
        .when(lift < -threshold, loses)
        .otherwise(none)
    )


def classify_lift(
    df: DataFrame, threshold: DataFrame, model: str = "mape", base: str = "baseline_mape"
) -> DataFrame:
    return df.withColumn("lift_label", lift_label(F.col(base) - F.col(model), threshold.select("threshold").scalar()))


def direction(value: Column, anchor: Column, eps: float) -> Column:
    """-1, 0 or 1: the move from the anchor, 0 within the flat band."""
    move = (value - anchor) / F.greatest(F.abs(anchor), F.lit(1e-6))
    return F.when(F.abs(move) < eps, 0.0).otherwise(F.signum(move))


def directional_accuracy(pred: DataFrame, by: Sequence[str], eps: float = 0.02) -> DataFrame:
    """How often the predicted move has the direction of the actual one, against
    no move at all and against a three-way guess. Needs ``anchor``."""
    moved = pred.select(
        *by,
        direction(F.col("actual"), F.col("anchor"), eps).alias("_actual"),
        direction(F.col("predicted"), F.col("anchor"), eps).alias("_predicted"),
    )
    counted = moved.groupBy(*by).agg(
        (F.avg((F.col("_actual") == F.col("_predicted")).cast("double")) * 100).alias("model_directional_acc"),
        (F.avg((F.col("_actual") == 0).cast("double")) * 100).alias("persistence_directional_acc"),
        F.count("*").alias("n_obs"),
    )
    chance = F.lit(100.0 / 3.0)
    return counted.withColumns(
        {
            "random_guess_directional_acc": chance,
            "directional_lift_pp": F.col("model_directional_acc") - F.col("persistence_directional_acc"),
            "directional_lift_vs_random_pp": F.col("model_directional_acc") - chance,
            "flat_share": F.col("persistence_directional_acc"),
        }
    )


def directional_lift_label(
    accuracy: DataFrame, fold_accuracy: DataFrame, fallback: float = 5.0, by: Sequence[str] = ("category",)
) -> DataFrame:
    """Labels of both lifts against the fold-to-fold deviation of the accuracy."""
    bar = noise_threshold(fold_accuracy, "model_directional_acc", fallback, by).scalar()
    return accuracy.withColumns(
        {
            "directional_noise_threshold_pp": bar,
            "directional_lift_label": lift_label(F.col("directional_lift_pp"), bar),
            "directional_lift_vs_random_label": lift_label(F.col("directional_lift_vs_random_pp"), bar),
        }
    )


def level_bias(pred: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    means = pred.groupBy(*by).agg(F.avg("actual").alias("mean_actual"), F.avg("predicted").alias("mean_predicted"))
    return means.withColumns(
        {
            "direction": F.when(F.col("mean_predicted") < F.col("mean_actual"), "UNDER").otherwise("OVER"),
            "gap": F.abs(F.col("mean_predicted") - F.col("mean_actual")),
        }
    )


def worst_category(labelled: DataFrame, series: DataFrame, recent: int = 60) -> DataFrame:
    """The losing category of lowest skill with its bias and recent demand.

    ``labelled`` has category, mape, baseline_mape, bias and lift_label."""
    worst = (
        forecast_skill(labelled.filter(F.col("lift_label") == LIFT[1]))
        .orderBy("skill_pct", "category")
        .limit(1)
        .select(
            "category",
            "mape",
            "baseline_mape",
            "skill_pct",
            "bias",
            F.when(F.col("bias") > 0, "over-forecasting").otherwise("under-forecasting").alias("direction"),
        )
    )
    # one row against the series: the broadcast is bounded by the limit above
    tail = series.join(F.broadcast(worst.select("category")), "category", "left_semi").withColumn(
        "_back", F.row_number().over(W.partitionBy("category").orderBy(F.desc("idx")))
    )
    stats = tail.filter(F.col("_back") <= recent).groupBy("category").agg(
        F.min("y").alias("recent_min"),
        F.max("y").alias("recent_max"),
        F.avg("y").alias("recent_mean"),
        F.stddev_pop("y").alias("recent_std"),
    )
    return worst.join(stats, "category", "left").withColumn(
        "recent_cv", F.col("recent_std") / F.greatest(F.col("recent_mean"), F.lit(1e-6))
    )


def beat_target(metrics: DataFrame, factor: float = 0.85) -> DataFrame:
    """Best baseline per category, the MAPE a model must reach, and whether the
    best baseline beats a naive step. ``metrics`` has category, model, mape, mase."""
    best = F.struct("mape", "model", "mase")
    return (
        metrics.filter(F.col("mape").isNotNull())
        .groupBy("category")
        .agg(F.min(best).alias("_best"))
        .select(
            "category",
            F.col("_best.model").alias("best_model"),
            F.col("_best.mape").alias("best_baseline"),
            (F.col("_best.mape") * factor).alias("target_mape"),
            (F.col("_best.mase") < 1).alias("beats_naive"),
        )
    )
