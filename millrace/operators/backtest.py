"""Walk-forward folds and the baselines every model is measured against.

A series is (category, idx, sale_date, y) with idx counted from 0. Folds are
rows, so all categories and folds run in one plan; a window partition holds one
series at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.numeric import count_when

PREDICTION = ("model", "category", "fold", "idx", "sale_date", "actual", "predicted", "lower", "upper")


def walk_forward_folds(series: DataFrame, n_folds: int = 3, test_days: int = 30, min_train: int = 120) -> DataFrame:
    """(category, fold, train_end, test_start, test_end), the last ``n_folds``
    test windows of each series; folds with too little history are left out,
    ``fold_report`` names them."""
    test_end = F.col("n") - (n_folds - F.col("fold")) * test_days
    return (
        series.groupBy("category")
        .agg(F.count("*").alias("n"))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_folds))))
        .select(
            "category",
            "fold",
            (test_end - test_days).alias("train_end"),
            (test_end - test_days).alias("test_start"),
            test_end.alias("test_end"),
        )
        .filter(F.col("train_end") >= min_train)
    )


def fold_report(series: DataFrame, n_folds: int = 3, test_days: int = 30, min_train: int = 120) -> DataFrame:
    """(category, fold, days, needed, kept): each fold that ``walk_forward_folds``
    could make, the history it needs, and whether the series has as much."""
    needed = min_train + test_days * (n_folds - F.col("fold") + 1)
    return (
        series.groupBy("category")
        .agg(F.count("*").alias("days"))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_folds))))
        .select("category", "fold", "days", needed.cast("long").alias("needed"), (F.col("days") >= needed).alias("kept"))
    )


def part_sizes(n: Column, es: float, holdout: float) -> tuple[Column, Column]:
    """Rows of the early-stop and the holdout part of ``n`` rows."""
    def size(share: float) -> Column:
        return F.greatest(F.lit(1), F.floor(n * F.lit(float(share)))) if share else F.lit(0)

    return size(es), size(holdout)


def split_report(rows: DataFrame, es: float = 0.10, holdout: float = 0.0, min_left: int = 5) -> DataFrame:
    """(category, n, train, kept): the training rows that ``chronological_split``
    finds in each category, and whether they are enough for it to stay."""
    es_rows, held = part_sizes(F.col("n"), es, holdout)
    train = (F.col("n") - es_rows - held).cast("long")
    return rows.groupBy("category").agg(F.count("*").alias("n")).select(
        "category", "n", train.alias("train"), (train >= min_left).alias("kept")
    )


def chronological_split(
    rows: DataFrame, es: float = 0.10, holdout: float = 0.0, min_left: int = 5, order: str = "row_idx"
) -> DataFrame:
    """Add ``split``: train, then early-stop, then (if asked) holdout, by time
    within each category. A category with fewer than ``min_left`` training rows
    is left out; ``split_report`` names it."""
    series = W.partitionBy("category")
    counted = rows.withColumns(
        {"_n": F.count("*").over(series), "_at": F.row_number().over(series.orderBy(order))}
    )
    es_rows, held = part_sizes(F.col("_n"), es, holdout)
    sized = counted.withColumns({"_es": es_rows, "_ho": held})
    train = F.col("_n") - F.col("_es") - F.col("_ho")
    return (
        sized.filter(train >= min_left)
        .withColumn(
            "split",
            F.when(F.col("_at") <= train, "train").when(F.col("_at") <= train + F.col("_es"), "es").otherwise("holdout"),
        )
        .drop("_n", "_at", "_es", "_ho")
    )


def folded(series: DataFrame, folds: DataFrame) -> DataFrame:
    """Series rows up to each fold's test end, one copy per fold."""
    return series.join(folds, "category").filter(F.col("idx") < F.col("test_end"))


def train_rows(series: DataFrame, folds: DataFrame) -> DataFrame:
    return folded(series, folds).filter(F.col("idx") < F.col("train_end"))


def _in_fold():
    return W.partitionBy("category", "fold")


def fold_fits(series: DataFrame, folds: DataFrame, window: int = 30, period: int = 7) -> DataFrame:
    """Series rows with what each baseline takes from the training part of
    their fold. One window over (category, fold) serves all baselines; Catalyst
    drops what a single baseline does not use."""
    past = F.col("idx") < F.col("train_end")
    y = F.when(past, F.col("y"))
    whole = _in_fold()
    season = F.array(
        *[F.max(F.when(F.col("idx") == F.col("train_end") - period + k, F.col("y"))).over(whole) for k in range(period)]
    )
    return folded(series, folds).withColumns(
        {
            "_y": y,
            "_last": F.max_by("y", F.when(past, F.col("idx"))).over(whole),
            "_mean": F.avg(F.when(F.col("idx") >= F.col("train_end") - window, y)).over(whole),
            "_season": F.get(season, ((F.col("idx") - F.col("test_start")) % period).cast("int")),
            "_slope": F.regr_slope(y, F.col("idx")).over(whole),
            "_base": F.regr_intercept(y, F.col("idx")).over(whole),
        }
    )


def with_trend(fits: DataFrame) -> DataFrame:
    """Line plus mean weekday deviation, and the spread around it."""
    fits = fits.withColumn("_line", F.col("_base") + F.col("_slope") * F.col("idx"))
    weekday = W.partitionBy("category", "fold", F.weekday("sale_date"))
    fits = fits.withColumn(
        "_fit", F.col("_line") + F.coalesce(F.avg(F.col("_y") - F.col("_line")).over(weekday), F.lit(0.0))
    )
    return fits.withColumn("_spread", F.stddev_pop(F.col("_y") - F.col("_fit")).over(_in_fold()))


def _not_negative(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))


def _entry(model: str, z: float = 1.645) -> Column:
    """One baseline's prediction and bounds, from the fit columns."""
    none = F.lit(None).cast("double")
    predicted, lower, upper = {
        "Last_Value": lambda: (F.col("_last"), none, none),
        "Average_Demand": lambda: (F.col("_mean"), none, none),
        "Seasonal_Naive": lambda: (_not_negative(F.col("_season")), none, none),
        "Trend_Season": lambda: (
            _not_negative(F.col("_fit")),
            _not_negative(F.col("_fit") - z * F.col("_spread")),
            _not_negative(F.col("_fit") + z * F.col("_spread")),
        ),
    }[model]()
    return F.struct(
        F.lit(model).alias("model"), predicted.alias("predicted"), lower.alias("lower"), upper.alias("upper")
    )


def _predictions(fits: DataFrame, *entries: Column) -> DataFrame:
    tests = fits.filter(F.col("idx") >= F.col("test_start"))
    return tests.select(
        "category", "fold", "idx", "sale_date", F.col("y").alias("actual"), F.inline(F.array(*entries))
    ).select(*PREDICTION)


def baseline_last_value(series: DataFrame, folds: DataFrame) -> DataFrame:
    """The last training value for every test day."""
    return _predictions(fold_fits(series, folds), _entry("Last_Value"))


def baseline_average(series: DataFrame, folds: DataFrame, window: int = 30) -> DataFrame:
    """The mean of the last ``window`` training values for every test day."""
    return _predictions(fold_fits(series, folds, window=window), _entry("Average_Demand"))


def baseline_seasonal_naive(series: DataFrame, folds: DataFrame, period: int = 7) -> DataFrame:
    """The last training season repeated over the test window."""
    return _predictions(fold_fits(series, folds, period=period), _entry("Seasonal_Naive"))


def baseline_trend_season(series: DataFrame, folds: DataFrame, z: float = 1.645) -> DataFrame:
    """A linear trend plus the mean deviation of each weekday, with a band of
    ``z`` residual deviations. Stands in for a library-fitted seasonal model."""
    return _predictions(with_trend(fold_fits(series, folds)), _entry("Trend_Season", z))


def all_baselines(series: DataFrame, folds: DataFrame) -> DataFrame:
    """The four baselines from one pass over the folds."""
    models = ("Last_Value", "Average_Demand", "Seasonal_Naive", "Trend_Season")
    return _predictions(with_trend(fold_fits(series, folds)), *[_entry(m) for m in models])


def sliding_forecasts(series: DataFrame, folds: DataFrame, horizon: int = 7, period: int = 7) -> DataFrame:
    """Three baselines from every origin of the test window: (category, fold,
    idx, horizon, actual, last_value, seasonal_naive, avg_demand, anchor).

    The days after and before an origin come from one ordered window over the
    series, not from a self-join."""
    by_day = W.partitionBy("category").orderBy("idx")
    steps = F.array(
        *[
            F.struct(
                F.lit(d + 1).alias("horizon"),
                F.lead("y", d).over(by_day).alias("actual"),
                F.coalesce(F.lag("y", period - d).over(by_day) if d < period else F.lead("y", d - period).over(by_day),
                           F.lag("y", 1).over(by_day)).alias("seasonal_naive"),
            )
            for d in range(horizon)
        ]
    )
    origins = series.withColumns({"_steps": steps, "anchor": F.lag("y", 1).over(by_day)})
    rows = folded(origins, folds).withColumn(
        "avg_demand", F.avg(F.when(F.col("idx") < F.col("train_end"), F.col("y"))).over(_in_fold())
    )
    inside = F.col("idx").between(F.col("test_start"), F.col("test_end") - horizon)
    return rows.filter(inside).select(
        "category",
        "fold",
        "idx",
        F.inline("_steps"),
        F.col("anchor").alias("last_value"),
        "avg_demand",
        "anchor",
    )


def sliding_baselines(series: DataFrame, folds: DataFrame, horizon: int = 7, period: int = 7) -> DataFrame:
    """Mean fold MAPE of the three sliding baselines and the best of them."""
    methods = ("last_value", "seasonal_naive", "avg_demand")
    forecasts = sliding_forecasts(series, folds, horizon, period)
    positive = F.col("actual") > 0
    per_fold = forecasts.groupBy("category", "fold").agg(
        *[
            F.when(
                count_when(positive) >= 5,
                F.avg(F.when(positive, F.abs(F.try_divide(F.col("actual") - F.col(m), F.col("actual"))))) * 100,
            ).alias(f"{m}_mape")
            for m in methods
        ]
    )
    means = per_fold.groupBy("category").agg(*[F.avg(f"{m}_mape").alias(f"{m}_mape") for m in methods])
    best = F.least(*[F.col(f"{m}_mape") for m in methods])
    named = F.lit(None).cast("string")
    for m in reversed(methods):
        named = F.when(F.col(f"{m}_mape") == best, f"{m}_mape").otherwise(named)
    return means.withColumns({"best_baseline": best, "best_baseline_method": named})
