"""Leaderboards and the model served per category.

Results are long rows (model, category, mape, mase, forecast_skill_pct,
noise_threshold_pp); the three model families are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.fixed_values import INSUFFICIENT_DATA, MODEL_FAMILIES, NO_CLEAR_WINNER
from millrace.functions.numeric import half_up
from millrace.operators.quantiles import exact_quantiles


def results_filter(df: DataFrame, mode: str = "global") -> DataFrame:
    """Only the rows of one mode, where there are any of it."""
    if "mode" not in df.columns:
        return df
    any_of_mode = df.agg(F.coalesce(F.bool_or(F.col("mode") == mode), F.lit(False))).scalar()
    return df.filter(~any_of_mode | (F.col("mode") == mode))


def model_leaderboard(results: DataFrame) -> DataFrame:
    """Mean and median MAPE, mean MASE and mean skill per model, best first."""
    usable = results.filter(F.col("mape").isNotNull())
    medians = exact_quantiles(usable, ["model"], "mape", [0.5], ["category"]).select(
        "model", F.col("quantile").alias("median_mape")
    )
    means = usable.groupBy("model").agg(
        F.avg("mape").alias("avg_mape"),
        F.count("*").alias("n_categories"),
    )
    others = results.groupBy("model").agg(
        F.avg("mase").alias("avg_mase"), F.avg("forecast_skill_pct").alias("avg_forecast_skill_pct")
    )
    board = means.join(medians, "model").join(others, "model")
    # as many rows as model families
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("avg_mape", "model"))
    return board.select(
        place.alias("rank"),
        "model",
        "avg_mape",
        "median_mape",
        "n_categories",
        "avg_mase",
        "avg_forecast_skill_pct",
    )


def category_leaderboard(results: DataFrame, min_rel: float = 5.0, floor: float = 1.5) -> DataFrame:
    """All models of a category side by side; a winner only where the margin
    clears the noise threshold and ``min_rel`` percent of the runner-up."""
    def mape_of(model: str) -> Column:
        value = F.max(F.when(F.col("model") == model, F.col("mape")))
        return value.alias(f"{model}_mape")

    wide = results.groupBy("category").agg(
        *[mape_of(m) for m in MODEL_FAMILIES],
        F.max(F.when(F.col("model") == "gbm", F.col("noise_threshold_pp"))).alias("_threshold"),
    )
    entries = F.array(
        *[
            F.when(
                F.col(f"{m}_mape").isNotNull(),
                F.struct(F.col(f"{m}_mape").alias("mape"), F.lit(i).alias("place"), F.lit(m).alias("model")),
            )
            for i, m in enumerate(MODEL_FAMILIES)
        ]
    )
    ranked = wide.withColumn("_ranked", F.array_sort(F.array_compact(entries)))
    best, second, n = F.get("_ranked", F.lit(0)), F.get("_ranked", F.lit(1)), F.size("_ranked")
    margin = second["mape"] - best["mape"]
    ranked = ranked.withColumns(
        {
            "margin_pp": margin,
            "margin_pct": F.try_divide(margin, second["mape"]) * 100,
            "noise_threshold_pp": F.when(n > 0, F.coalesce("_threshold", F.lit(float(floor)))),
            "threshold_source": F.when(n > 0, F.when(F.col("_threshold").isNull(), "flat_floor").otherwise("gbm_cv")),
        }
    )
    genuine = F.coalesce(
        (F.col("margin_pp") > F.col("noise_threshold_pp")) & (F.col("margin_pct") >= min_rel), F.lit(False)
    )
    return ranked.select(
        "category",
        *[f"{m}_mape" for m in MODEL_FAMILIES],
        F.when(n == 0, INSUFFICIENT_DATA)
        .when(genuine | (n == 1), best["model"])
        .otherwise(NO_CLEAR_WINNER)
        .alias("best_model"),
        "margin_pp",
        "margin_pct",
        "noise_threshold_pp",
        "threshold_source",
        genuine.alias("margin_is_genuine"),
    )


def _lowest(models: Sequence[str] = MODEL_FAMILIES) -> Column:
    entries = F.array(
        *[F.when(F.col(f"{m}_mape").isNotNull(), F.struct(F.col(f"{m}_mape").alias("mape"), F.lit(i).alias("i"), F.lit(m).alias("model")))
          for i, m in enumerate(models)]
    )
    return F.get(F.array_sort(F.array_compact(entries)), F.lit(0))["model"]


def global_default(leaderboard: DataFrame) -> DataFrame:
    """One row: the model with the lowest pooled MAPE, or the baseline."""
    return leaderboard.agg(F.coalesce(F.min_by("model", "rank"), F.lit("baseline")).alias("default_model"))


def model_selection(board: DataFrame, leaderboard: DataFrame, min_rel: float = 5.0) -> DataFrame:
    """(category, selected_model, confidence, reason, mapes). Without a clear
    winner the global best is served if it has a result there, else the lowest."""
    default = global_default(leaderboard).scalar()
    has_default = F.lit(False)
    for m in MODEL_FAMILIES:
        has_default = has_default | ((default == m) & F.col(f"{m}_mape").isNotNull())
    unclear = F.col("best_model") == NO_CLEAR_WINNER
    selected = (
        F.when(unclear & has_default, default)
        .when(unclear, F.coalesce(_lowest(), F.lit(INSUFFICIENT_DATA)))
        .otherwise(F.col("best_model"))
    )

    def number(name: str, digits: int) -> Column:
        # format_string would write a NULL as text
        return F.when(F.col(name).isNotNull(), F.format_string(f"%.{digits}f", half_up(F.col(name), digits)))

    margin = F.concat(number("margin_pp", 2), F.lit(" points, "), number("margin_pct", 1), F.lit("% relative"))
    bars = F.concat(number("noise_threshold_pp", 2), F.lit(f" points and {min_rel:.0f}% relative"))
    reason = (
        F.when(F.col("best_model") == INSUFFICIENT_DATA, F.lit("no model has a result here"))
        .when(
            unclear & has_default,
            F.concat(F.lit("margin ("), margin, F.lit(") is under the bar ("), bars, F.lit("); global best served")),
        )
        .when(unclear, F.lit("margin is under the bar and the global best has no result here; lowest MAPE served"))
        .otherwise(
            F.coalesce(
                F.concat(F.lit("lowest MAPE, ahead by "), margin, F.lit("; bar "), bars),
                F.lit("only model with a result here"),
            )
        )
    )
    return board.select(
        "category",
        selected.alias("selected_model"),
        F.when(F.col("margin_is_genuine"), "high").otherwise("low").alias("confidence"),
        reason.alias("reason"),
        *[f"{m}_mape" for m in MODEL_FAMILIES],
    )


def selection_counts(selection: DataFrame) -> DataFrame:
    """How many categories each model serves."""
    return selection.groupBy("selected_model").agg(F.count("*").alias("categories"))


def resolve_model(requests: DataFrame, selection: DataFrame, default: DataFrame) -> DataFrame:
    """The model for each (category, requested) row: an explicit known name is
    taken as it is, ``auto`` or NULL follows the selection, a category without
    a selection falls back to the default, and an unknown name is an error row."""
    asked = F.lower(F.trim(F.coalesce("requested", F.lit("auto"))))
    asked = F.when(asked == "", "auto").otherwise(asked)
    fallback = default.select("default_model").scalar()
    known = selection.select("category", "selected_model", "confidence", "reason", F.lit(True).alias("_known"))
    rows = requests.withColumn("_asked", asked).join(known, "category", "left")
    auto, valid = F.col("_asked") == "auto", F.col("_asked").isin(*MODEL_FAMILIES)
    found = F.coalesce("_known", F.lit(False))
    return rows.select(
        "category",
        F.when(valid, F.col("_asked")).when(auto, F.coalesce("selected_model", fallback)).alias("model"),
        F.when(valid, "unknown").when(auto & found, F.coalesce("confidence", F.lit("unknown"))).when(auto, "low").alias(
            "resolved_confidence"
        ),
        F.when(valid, "requested by the caller")
        .when(auto & found, F.col("reason"))
        .when(auto, "category without a selection; global default served")
        .alias("resolved_reason"),
        F.col("_asked").alias("requested"),
        F.when(valid | auto, auto).alias("was_auto"),
        found.alias("known"),
        F.when(~(valid | auto), F.concat(F.lit("unknown model "), F.col("_asked"))).alias("error"),
    ).withColumnsRenamed({"resolved_confidence": "confidence", "resolved_reason": "reason"})


def flatten_metrics(df: DataFrame, metrics: Sequence[str], key: str = "category") -> DataFrame:
    """(name, value) rows named key__metric."""
    return df.unpivot([key], [F.col(m).cast("double").alias(m) for m in metrics], "_metric", "value").select(
        F.concat(F.col(key), F.lit("__"), F.col("_metric")).alias("name"), "value"
    )
