"""Boosted-tree forecasts, one pooled MLlib model per horizon day.

Every fit is a distributed job over all categories; only the loops over folds,
horizon days and parameter sets, all fixed and small, run on the driver.
Training and scoring rows come from the same function, scalers are fitted on
training rows only, and no training target reaches into a test window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.fixed_values import FEATURES
from millrace.operators.backtest import chronological_split, walk_forward_folds
from millrace.operators.evaluation import metric_columns
from millrace.operators.features import (
    horizon_targets,
    scaler_apply,
    scaler_fit,
    smooth_target,
    to_raw_scale,
    with_seasonality,
)
from millrace.operators.global_order import number_globally
from millrace.session import materialize

# A category enters as two numbers of its training rows, so neither the driver
# nor the trees' bins hold anything that grows with the categories.
LEVELS = ("category_mean", "category_spread")
INPUTS = (*LEVELS, *FEATURES, "anchor")
PARALLEL_FITS = 7


@dataclass(frozen=True)
class TreeParams:
    max_iter: int = 50
    max_depth: int = 5
    step_size: float = 0.1
    subsampling: float = 0.8
    min_rows: int = 15
    seed: int = 42


@dataclass
class HorizonModels:
    """Level and spread of each category, their means for a category not met in
    training, and one fitted model per horizon day."""

    levels: DataFrame
    unseen: dict[str, float]
    by_day: dict[int, GBTRegressionModel] = field(default_factory=dict)

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows with ``yhat_d1`` and so on, in scaled units."""
        scored = self.inputs(rows)
        for day, model in self.by_day.items():
            scored = model.setPredictionCol(f"yhat_d{day}").transform(scored)
        return scored.drop("_inputs", *LEVELS)

    def inputs(self, rows: DataFrame) -> DataFrame:
        known = rows.join(self.levels, "category", "left").fillna(self.unseen)
        return VectorAssembler(inputCols=list(INPUTS), outputCol="_inputs").transform(known)


# -- rows ---------------------------------------------------------------------


def model_rows(features: DataFrame, scaler: DataFrame, horizon: int = 7, smooth: int = 7) -> DataFrame:
    """Scaled and smoothed rows with targets and row index, for training."""
    return horizon_targets(smooth_target(scaler_apply(features, scaler), smooth), horizon)


def scoring_rows(features: DataFrame, scaler: DataFrame, as_of: Column | None = None, smooth: int = 7) -> DataFrame:
    """The same rows without targets, at the last (or given) day of a category."""
    rows = smooth_target(scaler_apply(features, scaler), smooth).withColumn("anchor", F.col("units_sold"))
    day = as_of if as_of is not None else F.max("sale_date").over(W.partitionBy("category"))
    return rows.withColumn("_day", day).filter(F.col("sale_date") == F.col("_day")).drop("_day")


# -- fitting --------------------------------------------------------------------


def train_horizon_models(
    matrix: DataFrame, params: TreeParams = TreeParams(), horizon: int = 7
) -> HorizonModels:
    """Fit one model per day on rows marked train or es in ``split``; boosting
    stops when the es rows no longer improve."""
    levels = materialize(
        matrix.filter(F.col("split") == "train").groupBy("category").agg(
            F.avg("anchor").alias("category_mean"), F.stddev_pop("anchor").alias("category_spread")
        )
    )
    means = levels.agg(*[F.avg(c).alias(c) for c in LEVELS]).first()
    models = HorizonModels(levels, {c: float(means[c] or 0.0) for c in LEVELS})
    targets = [f"target_d{d}" for d in range(1, horizon + 1)]
    ready = materialize(
        models.inputs(matrix).select("_inputs", *targets, (F.col("split") == "es").alias("_held"))
    )

    def fit(day: int) -> GBTRegressionModel:
        trees = GBTRegressor(
            featuresCol="_inputs",
            labelCol=f"target_d{day}",
            validationIndicatorCol="_held",
            maxIter=params.max_iter,
            maxDepth=params.max_depth,
            stepSize=params.step_size,
            subsamplingRate=params.subsampling,
            minInstancesPerNode=params.min_rows,
            seed=params.seed,
        )
        return trees.fit(ready)

    # A fit is a chain of small jobs; those of several days fill the cluster together.
    with ThreadPool(min(horizon, PARALLEL_FITS)) as pool:
        days = range(1, horizon + 1)
        models.by_day.update(zip(days, pool.map(inheritable_thread_target(ready.sparkSession)(fit), days)))
    return models


def before_holdout(split: DataFrame, horizon: int) -> DataFrame:
    """Rows whose targets all lie before the held-out tail of their category."""
    first_held = split.filter(F.col("split") == "holdout").groupBy("category").agg(F.min("row_idx").alias("_held"))
    kept = split.join(first_held, "category").filter((F.col("split") != "holdout") & (F.col("row_idx") + horizon < F.col("_held")))
    return kept.drop("_held")


def long_forecasts(scored: DataFrame, scaler: DataFrame, days: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """One row per horizon day in raw units, predictions not under 0."""
    has_target = all(f"target_d{d}" in scored.columns for d in days)
    steps = [
        F.struct(
            F.lit(d).alias("horizon"),
            (F.col(f"target_d{d}") if has_target else F.lit(None).cast("double")).alias("actual"),
            F.col(f"yhat_d{d}").alias("predicted"),
        )
        for d in days
    ]
    rows = scored.select(*keep, "anchor", F.inline(F.array(*steps)))
    raw = to_raw_scale(rows, scaler, ["anchor", "actual"])
    return to_raw_scale(raw, scaler, ["predicted"], clip=True)


def score_forecasts(models: HorizonModels, rows: DataFrame, scaler: DataFrame) -> DataFrame:
    """(category, as_of, horizon, yhat) of every category at once."""
    scored = models.predict(rows.withColumn("as_of", F.col("sale_date")))
    return long_forecasts(scored, scaler, list(models.by_day), ["category", "as_of"]).select(
        "category", "as_of", "horizon", F.col("predicted").alias("yhat")
    )


def numbered(features: DataFrame) -> DataFrame:
    order = W.partitionBy("category").orderBy("sale_date")
    return features.withColumn("idx", F.row_number().over(order) - 1)


def fold_forecasts(
    features: DataFrame, folds: DataFrame, fold: int, params: TreeParams, horizon: int = 7
) -> DataFrame:
    """Fit on what lies before one fold and forecast its test window."""
    this = folds.filter(F.col("fold") == fold).select("category", "train_end", "test_start", "test_end")
    in_fold = numbered(features).join(this, "category")
    in_fold = with_seasonality(in_fold, in_fold.filter(F.col("idx") < F.col("train_end")))
    scaler = materialize(scaler_fit(in_fold.filter(F.col("idx") < F.col("train_end"))))
    rows = model_rows(in_fold, scaler, horizon)
    train = rows.filter(F.col("row_idx") + horizon < F.col("train_end"))
    models = train_horizon_models(chronological_split(train), params, horizon)
    tests = rows.filter((F.col("row_idx") >= F.col("test_start")) & (F.col("row_idx") < F.col("test_end")))
    scored = models.predict(tests.withColumn("fold", F.lit(fold)))
    return long_forecasts(
        scored, scaler, list(models.by_day), ["category", "fold", F.col("row_idx").alias("idx"), "sale_date"]
    )


def walk_forward_cv(
    features: DataFrame, params: TreeParams = TreeParams(), horizon: int = 7, n_folds: int = 3
) -> DataFrame:
    """Test forecasts of all folds: (category, fold, idx, sale_date, horizon,
    anchor, actual, predicted)."""
    folds = walk_forward_folds(numbered(features), n_folds)
    return reduce(
        DataFrame.unionByName,
        [fold_forecasts(features, folds, fold, params, horizon) for fold in range(1, n_folds + 1)],
    )


# -- importance and search ----------------------------------------------------------


def model_importance(models: HorizonModels) -> DataFrame:
    """Split importance of each input, averaged over the horizon models; as
    many rows as there are inputs."""
    names = list(INPUTS)
    totals = [sum(float(m.featureImportances[i]) for m in models.by_day.values()) for i in range(len(names))]
    spark = SparkSession.getActiveSession()
    rows = [(name, total / len(models.by_day)) for name, total in zip(names, totals)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def permutation_importance(
    models: HorizonModels,
    rows: DataFrame,
    scaler: DataFrame,
    columns: Sequence[str] = FEATURES,
    repeats: int = 5,
    seed: int = 42,
    by: Sequence[str] = (),
) -> DataFrame:
    """How much MAPE grows when one input is taken from another row.

    Each repeat pairs every row with the row at the same place of a hashed
    order. All inputs of a repeat are then scored in one job: a row is exploded
    into one copy per input, each copy with that input swapped."""
    keyed = materialize(rows.withColumn("_key", F.struct("category", "row_idx")))
    own = number_globally(keyed, "_key", [], descending=False)
    parts = []
    for repeat in range(repeats):
        mixed = keyed.select(
            "_key", F.xxhash64("category", "row_idx", F.lit(seed + repeat)).alias("_mix"), F.struct(*columns).alias("_other")
        )
        other = number_globally(mixed, "_mix", ["_key"], descending=False).select("row_no", "_other")
        pairs = own.join(other, "row_no")
        choice = F.explode(F.array(F.lit(""), *[F.lit(c) for c in columns])).alias("feature")
        copies = pairs.select("*", choice, F.lit(repeat).alias("repeat")).withColumns(
            {c: F.when(F.col("feature") == c, F.col("_other")[c]).otherwise(F.col(c)) for c in columns}
        )
        parts.append(copies.drop("_other", "_key", "row_no"))
    copies = reduce(DataFrame.unionByName, parts)
    forecasts = long_forecasts(
        models.predict(copies), scaler, list(models.by_day), [*dict.fromkeys(["feature", "repeat", *by])]
    )
    errors = forecasts.groupBy("feature", "repeat", *by).agg(metric_columns()[0])
    base = errors.filter(F.col("feature") == "").select("repeat", *by, F.col("mape").alias("base_mape"))
    gain = errors.filter(F.col("feature") != "").join(base, ["repeat", *by])
    return (
        gain.withColumn("gain", F.col("mape") - F.col("base_mape"))
        .groupBy("feature", *by)
        .agg(
            F.avg("gain").alias("mape_increase"),
            F.stddev_pop("gain").alias("mape_increase_std"),
            F.avg("base_mape").alias("baseline_mape"),
        )
        .orderBy(*by, F.desc("mape_increase"), "feature")
    )


def compare_lookbacks(
    features_of: dict[int, DataFrame], params: TreeParams = TreeParams(), horizon: int = 7
) -> DataFrame:
    """MAPE of the last fold for feature tables of several window lengths."""
    parts = []
    for window, features in features_of.items():
        folds = walk_forward_folds(numbered(features), 1, min_train=120 + window)
        scored = fold_forecasts(features, folds, 1, params, horizon)
        parts.append(scored.agg(metric_columns()[0]).select(F.lit(window).alias("lookback"), "mape"))
    return reduce(DataFrame.unionByName, parts).orderBy("mape", "lookback")


def tune_params(matrix: DataFrame, grid: Sequence[TreeParams], horizon: int = 7) -> DataFrame:
    """Mean absolute error of each parameter set on the last tenth of every
    category, best first, with the rows fitted and judged on. The tenth before
    it stops the boosting early; rows whose targets reach into the last tenth
    are not used."""
    split = materialize(chronological_split(matrix, es=0.10, holdout=0.10))
    held = split.filter(F.col("split") == "holdout")
    used = materialize(before_holdout(split, horizon))
    train_rows, held_rows = used.count(), held.count()
    parts = []
    for params in grid:
        models = train_horizon_models(used, params, horizon)
        scored = models.predict(held)
        off = [F.abs(F.col(f"yhat_d{d}") - F.col(f"target_d{d}")) for d in models.by_day]
        error = F.avg(reduce(lambda a, b: a + b, off) / len(off)).alias("score")
        parts.append(
            scored.agg(error).select(
                F.lit(params.max_depth).alias("max_depth"),
                F.lit(params.step_size).alias("step_size"),
                F.lit(params.max_iter).alias("max_iter"),
                F.lit(train_rows).cast("long").alias("train_rows"),
                F.lit(held_rows).cast("long").alias("held_rows"),
                "score",
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("score")
