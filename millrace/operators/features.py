"""Daily demand series and the features a forecast is made from.

Series stay long: one row per (category, day). Every window is partitioned by
category and ordered by day, over at most one row per calendar day.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.fixed_values import FEATURES, SCALED_FEATURES
from millrace.functions.numeric import half_up, percent, ratio
from millrace.operators.demand import seasonality_lookup
from millrace.operators.global_order import number_globally

INCOMPLETE_DAYS = 10  # at the end of an order table

def by_day():
    return W.partitionBy("category").orderBy("sale_date")


def trailing(rows: int):
    return by_day().rowsBetween(-(rows - 1), W.currentRow)


# -- calendar -----------------------------------------------------------------


def dense_demand(
    daily: DataFrame,
    fill: str = "zero",
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Every category on every day from the first to the last day sold.

    ``fill='zero'`` puts 0 on a missing day. ``fill='observed'`` does so only
    on days without any sale at all and leaves NULL elsewhere."""
    first = F.lit(str(start)).cast("date") if start else daily.agg(F.min("sale_date")).scalar()
    last = F.lit(str(end)).cast("date") if end else daily.agg(F.max("sale_date")).scalar()
    calendar = (
        daily.select("category").distinct().withColumn("sale_date", F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    )
    dense = calendar.join(daily, ["category", "sale_date"], "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in daily.columns if c not in ("category", "sale_date")}
    if fill == "zero":
        return dense.withColumns(zero)
    if fill != "observed":
        raise ValueError(f"fill must be 'zero' or 'observed', not {fill!r}")
    open_days = daily.select("sale_date").distinct().withColumn("_open", F.lit(True))
    dense = dense.join(open_days, "sale_date", "left")
    return dense.withColumns({c: F.when(F.col("_open").isNull(), v).otherwise(F.col(c)) for c, v in zero.items()}).drop(
        "_open"
    )


def category_stats(dense: DataFrame, min_active: int = 60, max_zero_pct: float = 40) -> DataFrame:
    """Length, empty days and mean demand on active days per category."""
    units = F.col("units_sold")
    return (
        dense.groupBy("category")
        .agg(
            F.count("*").alias("total_days"),
            F.count_if(units == 0).alias("zero_days"),
            F.sum(F.when(units > 0, units)).alias("_sold"),
            F.count_if(units > 0).alias("_sold_days"),
        )
        .select(
            "category",
            "total_days",
            "zero_days",
            (F.col("total_days") - F.col("zero_days")).alias("active_days"),
            half_up(percent(F.col("zero_days"), F.col("total_days")), 1).alias("zero_pct"),
            F.coalesce(half_up(ratio(F.col("_sold"), F.col("_sold_days")), 2), F.lit(0.0)).alias("avg_daily_demand"),
            (percent(F.col("zero_days"), F.col("total_days")) > max_zero_pct).alias("sparse"),
            (F.col("total_days") - F.col("zero_days") >= min_active).alias("usable"),
        )
    )


def usable_series(dense: DataFrame, stats: DataFrame) -> DataFrame:
    """Series of the categories with enough active days."""
    return dense.join(stats.filter("usable").select("category"), "category", "left_semi")


def holiday_calendar(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, holidays: DataFrame | None, cap: int = 30
) -> DataFrame:
    """(sale_date, is_holiday, days_to_holiday) for each day of a span.

    A holiday marks the ``cap`` days before it; the nearest mark wins. Without
    a holiday table no day is one and the distance is the cap."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), F.expr("interval 1 day"))).alias(
            "sale_date"
        )
    )
    if holidays is None:
        return days.withColumns({"is_holiday": F.lit(0), "days_to_holiday": F.lit(cap)})
    marks = (
        holidays.select("holiday_date", F.explode(F.sequence(F.lit(0), F.lit(cap))).alias("ahead"))
        .groupBy(F.date_sub("holiday_date", F.col("ahead")).alias("sale_date"))
        .agg(
            F.count_if(F.col("ahead") == 0).alias("_today"),
            F.min(F.when(F.col("ahead") > 0, F.col("ahead"))).alias("_ahead"),
        )
    )
    return days.join(marks, "sale_date", "left").select(
        "sale_date",
        F.when(F.col("_today") > 0, 1).otherwise(0).alias("is_holiday"),
        F.coalesce("_ahead", F.lit(cap)).alias("days_to_holiday"),
    )


def calendar_demand(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """The calendar with what was sold on each of its days: (categories, units_sold), zero where nothing was."""
    sold = daily.groupBy("sale_date").agg(
        F.countDistinct("category").alias("categories"), F.sum("units_sold").cast("long").alias("units_sold")
    )
    return calendar.join(sold, "sale_date", "left").fillna(0, ["categories", "units_sold"])


# -- features -----------------------------------------------------------------


def calendar_columns(date: str = "sale_date") -> dict[str, Column]:
    month, weekday = F.month(date), F.weekday(date)
    return {
        "month_sin": F.sin(month * (2 * math.pi) / 12),
        "month_cos": F.cos(month * (2 * math.pi) / 12),
        "dow_sin": F.sin(weekday * (2 * math.pi) / 7),
        "dow_cos": F.cos(weekday * (2 * math.pi) / 7),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def demand_columns(window: int = 30) -> dict[str, Column]:
    """Lags and rolling measures, all over one sort of the series."""
    units = F.col("units_sold")
    columns = {f"lag_{k}": F.lag(units, k).over(by_day()) for k in (1, 7, 14, 30)}
    for rows in (7, window):
        name = "7" if rows == 7 else "30"
        columns[f"rolling_mean_{name}"] = F.avg(units).over(trailing(rows))
        columns[f"rolling_std_{name}"] = F.coalesce(F.stddev_samp(units).over(trailing(rows)), F.lit(0.0))
    return columns


def all_features(
    dense: DataFrame, seasonality: DataFrame, calendar: DataFrame | None, window: int = 30
) -> DataFrame:
    """The 19 features of every row, incomplete first rows included."""
    series = dense.select("sale_date", "category", F.col("units_sold").cast("double").alias("units_sold"))
    featured = series.withColumns(demand_columns(window)).withColumns(
        {
            "trend_strength": F.col("rolling_mean_7") - F.col("rolling_mean_30"),
            "acceleration": F.col("lag_1") - F.col("lag_7"),
            **calendar_columns(),
            "month_num": F.month("sale_date"),
        }
    )
    seasonal = seasonality.select("category", "month_num", F.col("seasonality_index").cast("double"))
    featured = featured.join(seasonal, ["category", "month_num"], "left").withColumn(
        "seasonality_index", F.coalesce("seasonality_index", F.lit(100.0))
    )
    if calendar is None:
        featured = featured.withColumns({"is_holiday": F.lit(0), "days_to_holiday": F.lit(30)})
    else:
        featured = featured.join(calendar, "sale_date", "left").withColumns(
            {
                "is_holiday": F.coalesce("is_holiday", F.lit(0)),
                "days_to_holiday": F.coalesce("days_to_holiday", F.lit(30)),
            }
        )
    return featured.select("sale_date", "category", *FEATURES)


def with_seasonality(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Feature rows whose seasonality comes from the days in ``known`` alone."""
    lookup = seasonality_lookup(known.select("category", "sale_date", "units_sold")).select(
        "category", F.col("month_num").alias("_month"), F.col("seasonality_index").cast("double").alias("_seasonal")
    )
    joined = rows.withColumn("_month", F.month("sale_date")).join(lookup, ["category", "_month"], "left")
    return joined.withColumn("seasonality_index", F.coalesce("_seasonal", F.lit(100.0))).drop("_month", "_seasonal")


def demand_features(
    dense: DataFrame, seasonality: DataFrame, calendar: DataFrame | None = None, window: int = 30
) -> DataFrame:
    """Model-ready rows: those with a full set of lags."""
    return all_features(dense, seasonality, calendar, window).dropna(subset=list(FEATURES))


def latest_feature_row(
    daily: DataFrame,
    seasonality: DataFrame,
    calendar: DataFrame | None = None,
    as_of: dt.date | str | None = None,
    buffer_days: int = INCOMPLETE_DAYS,
    lookback: int = 60,
) -> DataFrame:
    """The feature row of every category at one date.

    The date defaults to the last day sold less ``buffer_days``, because the
    last days of an order table are incomplete. Only ``lookback`` days are
    read. A category without sales in them gets zero demand; a row whose lags
    reach past the span carries an error instead of being scored."""
    last = daily.agg(F.max("sale_date")).scalar()
    day = F.lit(str(as_of)).cast("date") if as_of else F.date_sub(last, buffer_days)
    first = F.date_sub(day, lookback)
    categories = daily.select("category").distinct()
    recent = daily.filter(F.col("sale_date").between(first, day))
    calendar_rows = categories.withColumn("sale_date", F.explode(F.sequence(first, day, F.expr("interval 1 day"))))
    dense = calendar_rows.join(recent, ["category", "sale_date"], "left").withColumn(
        "units_sold", F.coalesce("units_sold", F.lit(0))
    )
    rows = all_features(dense, seasonality, calendar).filter(F.col("sale_date") == day)
    short = F.col("lag_30").isNull() | F.col("lag_14").isNull() | F.col("lag_7").isNull() | F.col("lag_1").isNull()
    return rows.select(
        "category",
        F.col("sale_date").alias("as_of"),
        *FEATURES,
        F.col("units_sold").alias("anchor"),
        F.when(short, "not enough history for lag_30").alias("error"),
    )


# -- scaling ------------------------------------------------------------------


def scaler_fit(df: DataFrame, columns: Sequence[str] = SCALED_FEATURES, target: str = "units_sold") -> DataFrame:
    """One row: minimum and maximum of every column, of log1p for the target."""
    ends = []
    for c in (target, *columns):
        value = F.log1p(F.col(c)) if c == target else F.col(c)
        ends += [F.min(value).alias(f"{c}_min"), F.max(value).alias(f"{c}_max")]
    return df.agg(*ends)


def _with_fit(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """The fitted ends as one struct column, read once by a scalar subquery."""
    return df.withColumn("_fit", scaler.select(F.struct(*scaler.columns)).scalar())


def scaler_apply(df: DataFrame, scaler: DataFrame, target: str = "units_sold") -> DataFrame:
    """Columns moved to [0, 1] of the fitted data; a constant column becomes 0."""
    names = [c[: -len("_min")] for c in scaler.columns if c.endswith("_min")]

    def unit(name: str) -> Column:
        value = F.log1p(F.col(name)) if name == target else F.col(name)
        low, high = F.col("_fit")[f"{name}_min"], F.col("_fit")[f"{name}_max"]
        return F.coalesce(F.try_divide(value - low, high - low), F.when(value.isNotNull(), 0.0))

    scaled = {n: unit(n) for n in names if n in df.columns}
    return _with_fit(df, scaler).withColumns(scaled).drop("_fit")


def to_raw_scale(
    df: DataFrame, scaler: DataFrame, columns: Sequence[str], clip: bool = False, target: str = "units_sold"
) -> DataFrame:
    """Scaled target columns back in units: min-max inverse, then expm1."""
    low, high = F.col("_fit")[f"{target}_min"], F.col("_fit")[f"{target}_max"]
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)

    def raw(name: str) -> Column:
        value = F.greatest(F.col(name), F.lit(0.0)) if clip else F.col(name)
        logged = value * span + low
        return F.expm1(F.greatest(logged, F.lit(0.0)) if clip else logged)

    return _with_fit(df, scaler).withColumns({c: raw(c) for c in columns}).drop("_fit")


# -- model inputs ---------------------------------------------------------------


def smooth_target(df: DataFrame, rows: int = 7, column: str = "units_sold") -> DataFrame:
    """The target replaced by its trailing mean."""
    return df.withColumn(column, F.avg(column).over(trailing(rows)))


def horizon_targets(features: DataFrame, horizon: int = 7) -> DataFrame:
    """Feature rows with their anchor, row index and the next days' demand;
    rows without a full horizon are left out."""
    rows = features.withColumns(
        {
            "anchor": F.col("units_sold"),
            "row_idx": F.row_number().over(by_day()) - 1,
            **{f"target_d{d}": F.lead("units_sold", d).over(by_day()) for d in range(1, horizon + 1)},
            "_ahead": F.lead(F.lit(1), horizon).over(by_day()),
        }
    )
    return rows.filter(F.col("_ahead").isNotNull()).drop("_ahead")


def sequence_dataset(
    features: DataFrame, lookback: int = 30, horizon: int = 7, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """(category, idx, sale_date, x, y, anchor): ``lookback`` days of features,
    the ``horizon`` days after them, and the last known value."""
    past = by_day().rowsBetween(-(lookback - 1), W.currentRow)
    ahead = by_day().rowsBetween(1, horizon)
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return (
        features.withColumn("_vector", vector)
        .select(
            "category",
            (F.row_number().over(by_day()) - 1).alias("idx"),
            "sale_date",
            F.collect_list("_vector").over(past).alias("x"),
            F.collect_list("units_sold").over(ahead).alias("y"),
            F.col("units_sold").alias("anchor"),
        )
        .filter((F.size("x") == lookback) & (F.size("y") == horizon))
    )


def sequence_sums(sequences: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Every number of x and y in a few: for each column of x, and for y, the
    sum over the days (``sum_``) and the sum of day number times value
    (``turn_``), which changes with the order of the days."""

    def added(days: Column) -> Column:
        zeros = F.array(*[F.lit(0.0)] * len(columns))
        return F.aggregate(days, zeros, lambda total, day: F.zip_with(total, day, lambda t, v: t + v))

    turned = F.transform("x", lambda day, i: F.transform(day, lambda v: v * (i + 1)))
    y = F.transform("y", lambda v: v.cast("double"))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda t, v: t + v)
    return sequences.select(
        "category", "idx", "sale_date", "anchor", added(F.col("x")).alias("_sums"), added(turned).alias("_turns"),
        total(y).alias("sum_y"), total(F.transform(y, lambda v, i: v * (i + 1))).alias("turn_y"),
    ).select(
        "category", "idx", "sale_date", "anchor",
        *[F.col("_sums")[i].alias(f"sum_{c}") for i, c in enumerate(columns)],
        *[F.col("_turns")[i].alias(f"turn_{c}") for i, c in enumerate(columns)],
        "sum_y", "turn_y",
    )


def category_index(df: DataFrame) -> DataFrame:
    """(category, id): ids follow the sorted order of the names."""
    ordered = number_globally(df.select("category").distinct(), "category", [], descending=False)
    return ordered.select("category", (F.col("row_no") - 1).cast("int").alias("id"))
