"""Every registered query: a name, and a function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from millrace.functions.numeric import half_up
from millrace.operators import (
    backtest,
    demand,
    evaluation,
    features,
    fulfilment,
    intervals,
    lines,
    models,
    planning,
    quality,
    routing,
    sentiment,
    stock,
    suppliers,
)
from millrace.plans import monthly_report
from millrace.plans.demand_series import DemandSeries, demand_series, indexed_series
from millrace.plans.forecast_run import forecast_run
from millrace.plans.roles import Shop, holidays
from millrace.session import materialize
from millrace.sources.load import catalogue, keep_first

Query = Callable[[SparkSession, str], DataFrame]

# parameters for the driver's tables
FIRST_DAY = "1995-01-01"
LAST_DAY = "2001-12-31"
MONTH = "1998-10-01"
MIN_ACTIVE_DAYS = 5


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines print the same value."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _on_shop(build: Callable[[Shop], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(build(Shop(spark, folder)))

    return run


def _month(s: Shop) -> DataFrame:
    return monthly_report.month_lines(s.orders, s.items, MONTH)


ANALYTICS: dict[str, Callable[[Shop], DataFrame]] = {
    "monthly_demand_trend": lambda s: demand.monthly_demand_trend(s.orders, s.items, s.products, FIRST_DAY, LAST_DAY),
    "rolling_demand": lambda s: demand.rolling_demand(s.orders, s.items, s.products),
    "seller_lead_time": lambda s: suppliers.seller_lead_time(s.orders, s.items, s.sellers),
    "reorder_point": lambda s: stock.reorder_point(s.orders, s.items, s.products, MIN_ACTIVE_DAYS),
    "stockout_runs": lambda s: demand.stockout_runs(s.orders, s.items, s.products),
    "seller_cohort": lambda s: suppliers.seller_cohort(s.orders, s.items),
    "revenue_at_risk": lambda s: suppliers.revenue_at_risk(s.orders, s.items, s.sellers),
    "seasonality_index": lambda s: demand.seasonality_index(s.orders, s.items, s.products),
    "abc_analysis": lambda s: stock.abc_analysis(s.items, s.products),
    "fulfillment_stages": lambda s: fulfilment.fulfilment_stages(s.orders),
    "review_early_warning": lambda s: suppliers.review_early_warning(s.orders, s.items, s.reviews),
    "report_delayed_sellers": lambda s: monthly_report.delayed_sellers(_month(s)),
    "report_cancel_alerts": lambda s: monthly_report.cancel_alerts(_month(s), s.products),
    "report_revenue_summary": lambda s: monthly_report.revenue_summary(_month(s)),
    "report_reorder_alerts": lambda s: monthly_report.reorder_alerts(_month(s), s.products),
    "supplier_risk": lambda s: suppliers.supplier_risk(s.orders, s.items, s.sellers, s.reviews),
    "top_categories": lambda s: demand.top_categories(
        s.orders, s.items, s.products.select("product_id", F.col("brand").alias("category"))
    ),
    "daily_demand": lambda s: lines.daily_demand(s.orders, s.items, s.products),
}



def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places: two engines add in different order."""
    return df.select(
        *[
            half_up(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.DecimalType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# -- load and text --------------------------------------------------------------

LEXICON = (
    ("best", 3.2), ("idiot", -2.3), ("stupid", -2.4), ("disgusting", -2.4),
    ("loser", -2.4), ("clown", -1.1), ("is", 0.2), ("that", -0.1), ("la", 0.3),
)
NEGATIONS = ("no", "un", "of")


def lexicon(spark: SparkSession) -> DataFrame:
    """A caller's word list with weights."""
    return spark.createDataFrame(list(LEXICON), "token string, weight double")


def texts(s: Shop) -> DataFrame:
    """Documents as reviews: the source is the title, the text the message."""
    return s.documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("title"),
        F.col("text").alias("message"),
        F.lit(None).cast("decimal(5,4)").alias("sentiment_score"),
    )


def earlier_scores(s: Shop) -> DataFrame:
    """Scores of an earlier run: the Spanish documents have one."""
    given = F.lit("0.2500").cast("decimal(5,4)").alias("sentiment_score")
    return s.documents.filter(F.col("lang") == "es").select(F.col("doc_id").alias("review_id"), given)


def _scores(s: Shop) -> DataFrame:
    return sentiment.sentiment_score(texts(s), lexicon(s.spark), NEGATIONS)


def _dq(s: Shop) -> DataFrame:
    tables = {
        "orders": s.orders, "order_items": s.items, "customers": s.customers,
        "sellers": s.sellers, "products": s.products, "reviews": s.reviews,
    }
    return quality.dq_report(
        tables,
        floors={"orders": 10_000, "order_items": 100_000, "sellers": 50},
        keys={"orders": ["order_id"], "order_items": ["order_id", "item_no"], "products": ["product_id"]},
        references=[
            ("orders", "customer_id", "customers", "customer_id"),
            ("order_items", "order_id", "orders", "order_id"),
            ("order_items", "product_id", "products", "product_id"),
            ("order_items", "seller_id", "sellers", "seller_id"),
            ("reviews", "order_id", "orders", "order_id"),
        ],
        not_null=[("orders", "purchase_ts"), ("orders", "delivered_ts"), ("products", "category")],
    )


def _first_items(s: Shop) -> DataFrame:
    order = ["product_id", "seller_id", "price", "freight"]
    return keep_first(s.items, ["order_id", "item_no"], order)


LOAD: dict[str, Callable[[Shop], DataFrame]] = {
    "dq_report": _dq,
    "keep_first": _first_items,
    "table_catalogue": lambda s: catalogue(
        {
            "orders": s.orders, "order_items": s.items, "products": s.products, "sellers": s.sellers,
            "reviews": s.reviews, "customers": s.customers, "documents": s.documents,
        }
    ),
    "sentiment_score": _scores,
    "sentiment_distribution": lambda s: sentiment.sentiment_distribution(_scores(s)),
    "sentiment_backfill": lambda s: sentiment.sentiment_backfill(
        texts(s), lexicon(s.spark), earlier_scores(s), NEGATIONS
    ).select("review_id", "sentiment_score"),
}

# -- series and features ----------------------------------------------------------


def series_of(s: Shop) -> DemandSeries:
    return demand_series(
        s.orders, s.items, s.products, holidays(s.spark), FIRST_DAY, LAST_DAY
    )


def _scaled(d: DemandSeries) -> DataFrame:
    return features.scaler_apply(d.features, features.scaler_fit(d.features))


def _back_to_raw(d: DemandSeries) -> DataFrame:
    scaler = features.scaler_fit(d.features)
    scaled = features.scaler_apply(d.features.select("category", "sale_date", "units_sold"), scaler)
    return features.to_raw_scale(scaled, scaler, ["units_sold"], clip=True)


def _sequences(d: DemandSeries) -> DataFrame:
    """Sequences over all features, by the values that the SQL names; ``sequence_sums`` has all of x and y."""
    rows = features.sequence_dataset(d.features)
    lag_7 = features.FEATURES.index("lag_7") + 1
    return rows.select(
        "category",
        "idx",
        "sale_date",
        "anchor",
        F.element_at(F.element_at("x", 1), 1).alias("oldest_units"),
        F.element_at(F.element_at("x", 30), lag_7).alias("newest_lag_7"),
        F.aggregate("x", F.lit(0.0), lambda total, day: total + F.element_at(day, 1)).alias("units_in_x"),
        F.element_at("y", 1).alias("y_first"),
        F.element_at("y", 7).alias("y_last"),
    )


SERIES: dict[str, Callable[[DemandSeries], DataFrame]] = {
    "dense_demand": lambda d: d.dense,
    "category_stats": lambda d: d.stats,
    "holiday_calendar": lambda d: features.calendar_demand(d.daily, d.calendar),
    "demand_features": lambda d: d.features,
    "scaler_fit": lambda d: features.scaler_fit(d.features),
    "scaler_apply": _scaled,
    "to_raw_scale": _back_to_raw,
    "latest_feature_row": lambda d: features.latest_feature_row(d.daily, d.seasonality, d.calendar),
    "horizon_targets": lambda d: features.horizon_targets(d.features).select(
        "category", "sale_date", "row_idx", "anchor", *[f"target_d{i}" for i in range(1, 8)]
    ),
    "smooth_target": lambda d: features.smooth_target(d.features).select("category", "sale_date", "units_sold"),
    "sequence_dataset": _sequences,
    # of features to six places: sums of them are multiples of a millionth, which no order of adding moves
    "sequence_sums": lambda d: features.sequence_sums(features.sequence_dataset(rounded(d.features))),
    "category_index": lambda d: features.category_index(d.daily),
    "split_report": lambda d: backtest.split_report(features.horizon_targets(d.features), holdout=0.07),
    "chronological_split": lambda d: backtest.chronological_split(
        features.horizon_targets(d.features), holdout=0.07
    ).groupBy("category", "split").agg(
        F.count("*").alias("n"), F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day")
    ),
}

# -- backtest ----------------------------------------------------------------------


class Backtest:
    """Series, folds and baseline predictions of one run."""

    def __init__(self, s: Shop, column: str = "category"):
        products = s.products.select("product_id", F.col(column).alias("category"))
        daily = materialize(lines.daily_demand(s.orders, s.items, products))
        self.dense = features.dense_demand(daily)
        self.series = materialize(indexed_series(self.dense))
        self.folds = backtest.walk_forward_folds(self.series)
        self.stats = features.category_stats(self.dense)

    def pred(self) -> DataFrame:
        return backtest.all_baselines(self.series, self.folds)

    def scale(self) -> DataFrame:
        return evaluation.naive_scale(backtest.train_rows(self.series, self.folds), ["category", "fold"])

    @cached_property
    def fold_metrics(self) -> DataFrame:
        """A few rows per category that several results start from."""
        return materialize(evaluation.forecast_metrics(self.pred(), ["model", "category", "fold"], self.scale()))

    def metrics(self) -> DataFrame:
        return evaluation.fold_average(self.fold_metrics, ["model", "category"])

    def sliding(self) -> DataFrame:
        return backtest.sliding_baselines(self.series, self.folds)

    def moves(self) -> DataFrame:
        """Sliding seasonal forecasts with their anchor, as predictions."""
        return backtest.sliding_forecasts(self.series, self.folds).withColumnRenamed("seasonal_naive", "predicted")

    def against_baseline(self) -> DataFrame:
        """The trend model next to the best sliding baseline."""
        trend = self.metrics().filter(F.col("model") == "Trend_Season")
        base = self.sliding().select("category", F.col("best_baseline").alias("baseline_mape"))
        return trend.join(base, "category").select("category", "mape", "bias", "mase", "baseline_mape")

    def threshold(self) -> DataFrame:
        return evaluation.noise_threshold(self.fold_metrics.filter(F.col("model") == "Trend_Season"))

    def labelled(self) -> DataFrame:
        return evaluation.classify_lift(self.against_baseline(), self.threshold())

    def results(self) -> DataFrame:
        """The three model families, stood in for by three baselines."""
        family = (
            F.when(F.col("model") == "Average_Demand", "baseline")
            .when(F.col("model") == "Seasonal_Naive", "lstm")
            .when(F.col("model") == "Trend_Season", "gbm")
        )
        bar = F.when(family == "gbm", self.threshold().select(F.col("threshold") / 50).scalar())
        return self.metrics().select(
            family.alias("model"),
            "category",
            "mape",
            F.when(family != "baseline", F.col("mase")).alias("mase"),
            F.when(family != "baseline", F.lit(100.0) - F.col("mape")).alias("forecast_skill_pct"),
            bar.alias("noise_threshold_pp"),
        ).filter(F.col("model").isNotNull())

    def mean_mape(self, model: str) -> Column:
        """Mean MAPE of a model over the categories, as a scalar."""
        return self.metrics().filter(F.col("model") == model).agg(F.avg("mape")).scalar()

    def forecasts(self) -> DataFrame:
        """A week ahead: the last week again, with a band from the last 30 days."""
        back = F.row_number().over(W.partitionBy("category").orderBy(F.desc("idx")))
        recent = self.series.withColumn("back", back).filter(F.col("back") <= 30)
        spread = F.stddev_pop("y").over(W.partitionBy("category")) * 1.96
        return (
            recent.withColumn("spread", spread)
            .filter(F.col("back") <= 7)
            .select(
                "category",
                (8 - F.col("back")).alias("day"),
                F.col("y").alias("forecast"),
                F.greatest(F.col("y") - F.col("spread"), F.lit(0.0)).alias("lower"),
                (F.col("y") + F.col("spread")).alias("upper"),
            )
        )

    def horizon_pred(self) -> DataFrame:
        return self.moves().select(
            "category", "fold", F.col("idx"), "horizon", "actual", F.col("predicted")
        )


def _selection(b: Backtest) -> tuple[DataFrame, DataFrame]:
    results = b.results()
    board = routing.model_leaderboard(results)
    return routing.model_selection(routing.category_leaderboard(results), board), board


def _resolve(b: Backtest) -> DataFrame:
    selection, board = _selection(b)
    asked = F.array(F.lit("auto"), F.lit(" GBM "), F.lit("prophet"), F.lit(None))
    known = b.series.select("category").distinct().select("category", F.explode(asked).alias("requested"))
    unseen = known.select(F.concat(F.col("category"), F.lit("-new")).alias("category"), "requested")
    return routing.resolve_model(known.unionByName(unseen), selection, routing.global_default(board)).drop("reason")


def _filtered(b: Backtest) -> DataFrame:
    mode = F.when(F.col("model") == "Last_Value", "per_category").otherwise("global")
    return routing.results_filter(b.metrics().withColumn("mode", mode)).select("model", "category", "mode", "mape")


def _portfolio(b: Backtest) -> DataFrame:
    return planning.portfolio(b.forecasts(), b.stats, _selection(b)[0])


def _pads(b: Backtest) -> DataFrame:
    """Bounds from the first fold, padding from the second, coverage on the third."""
    bounds = intervals.quantile_bounds(b.horizon_pred(), F.col("fold") == 1, by=["horizon"])
    return intervals.conformal_pad(bounds, F.col("fold") == 2)


EVALUATION: dict[str, Callable[[Backtest], DataFrame]] = {
    "walk_forward_folds": lambda b: b.folds,
    "fold_report": lambda b: backtest.fold_report(b.series),
    "baseline_last_value": lambda b: backtest.baseline_last_value(b.series, b.folds),
    "baseline_average": lambda b: backtest.baseline_average(b.series, b.folds),
    "baseline_seasonal_naive": lambda b: backtest.baseline_seasonal_naive(b.series, b.folds),
    "baseline_trend_season": lambda b: backtest.baseline_trend_season(b.series, b.folds),
    "sliding_baselines": Backtest.sliding,
    "forecast_metrics": lambda b: b.fold_metrics,
    "interval_coverage": lambda b: evaluation.interval_coverage(
        backtest.baseline_trend_season(b.series, b.folds), ["category"]
    ),
    "fold_average": Backtest.metrics,
    "residual_diagnostics": lambda b: evaluation.residual_diagnostics(b.pred(), ["model", "category"]),
    "paired_error_test": lambda b: evaluation.paired_error_test(b.pred(), "Average_Demand", "Trend_Season").drop("p"),
    "forecast_skill": lambda b: evaluation.forecast_skill(b.against_baseline()),
    "noise_threshold": Backtest.threshold,
    "classify_lift": Backtest.labelled,
    "directional_accuracy": lambda b: evaluation.directional_accuracy(b.moves(), ["category"]),
    "directional_lift_label": lambda b: evaluation.directional_lift_label(
        evaluation.directional_accuracy(b.moves(), ["category"]),
        evaluation.directional_accuracy(b.moves(), ["category", "fold"]),
    ),
    "level_bias": lambda b: evaluation.level_bias(b.moves()),
    "worst_category": lambda b: evaluation.worst_category(b.labelled(), b.series),
    "beat_target": lambda b: evaluation.beat_target(b.metrics()),
    "residual_intervals": lambda b: intervals.residual_intervals(b.horizon_pred()),
    "quantile_bounds": lambda b: intervals.quantile_bounds(b.horizon_pred(), F.col("fold") < 3),
    "conformal_pad": _pads,
}

# brands instead of types: 25 categories
ROUTING: dict[str, Callable[[Backtest], DataFrame]] = {
    "model_leaderboard": lambda b: routing.model_leaderboard(b.results()),
    "category_leaderboard": lambda b: routing.category_leaderboard(b.results()),
    "skill_tables": lambda b: evaluation.skill_tables(routing.category_leaderboard(b.results())),
    "model_selection": lambda b: _selection(b)[0],
    "selection_counts": lambda b: routing.selection_counts(_selection(b)[0]),
    "resolve_model": _resolve,
    "results_filter": _filtered,
    "flatten_metrics": lambda b: routing.flatten_metrics(
        b.metrics().filter(F.col("model") == "Trend_Season"), ["mape", "rmse", "bias"]
    ),
    "inventory_plan": lambda b: planning.inventory_plan(b.forecasts()),
    "business_impact": lambda b: planning.business_impact(
        planning.inventory_plan(b.forecasts()), b.mean_mape("Trend_Season"), b.mean_mape("Average_Demand")
    ),
    "abc_by_rank": lambda b: planning.abc_by_rank(b.forecasts().groupBy("category").agg(F.sum("forecast").alias("total"))),
    "portfolio": _portfolio,
    "demand_spike": lambda b: planning.demand_spike(b.forecasts()),
    "service_level_curve": lambda b: planning.service_level_curve(b.forecasts()),
    "lead_time_curve": lambda b: planning.lead_time_curve(b.forecasts()),
    "executive_summary": lambda b: planning.executive_summary(
        _portfolio(b), b.forecasts(), b.mean_mape("Trend_Season"), b.mean_mape("Average_Demand")
    ),
    "forecast_export": lambda b: planning.forecast_export(b.forecasts()),
}


# -- models: all days, folds, rounds and repeats ----------------------------------
#
# What a fit predicts has no SQL. The results are laid out so that SQL states
# the rest: which rows there are, their facts, and what must hold of each.


def _complete_day(d: DemandSeries) -> Column:
    """The day up to which demand is complete."""
    return d.daily.agg(F.date_sub(F.max("sale_date"), features.INCOMPLETE_DAYS)).scalar()


def _trained(d: DemandSeries) -> tuple[models.HorizonModels, DataFrame, DataFrame]:
    rows = materialize(d.features)
    placed = backtest.chronological_split(rows, order="sale_date")
    scaler = materialize(features.scaler_fit(placed.filter(F.col("split") == "train")))
    matrix = materialize(backtest.chronological_split(models.model_rows(rows, scaler)))
    return models.train_horizon_models(matrix), matrix, scaler


def _score(d: DemandSeries) -> DataFrame:
    fitted, _, scaler = _trained(d)
    scored = models.score_forecasts(fitted, models.scoring_rows(d.features, scaler, _complete_day(d)), scaler)
    return scored.select("category", "as_of", "horizon", (F.col("yhat") >= 0).alias("not_negative"))


def _served(d: DemandSeries) -> DataFrame:
    served = forecast_run(d.features, as_of=_complete_day(d)).served
    return served.select(
        "category", "as_of", "horizon", "level",
        ((F.col("lower") >= 0) & (F.col("lower") <= F.col("upper"))).alias("ordered"),
    )


def _importance(d: DemandSeries) -> DataFrame:
    found = models.model_importance(_trained(d)[0])
    total = found.agg(F.sum("importance")).scalar()
    return found.select("feature", (F.col("importance") >= 0).alias("not_negative"), total.alias("total"))


def _permuted(d: DemandSeries) -> DataFrame:
    fitted, matrix, scaler = _trained(d)
    found = models.permutation_importance(fitted, matrix.filter(F.col("split") == "es"), scaler)
    return found.select(
        "feature", (F.col("baseline_mape") > 0).alias("base_known"), (F.col("mape_increase_std") >= 0).alias("spread_known")
    )


def _cv(d: DemandSeries) -> DataFrame:
    forecasts = models.walk_forward_cv(materialize(d.features))
    return forecasts.select(
        "category", "fold", "idx", "sale_date", "horizon", "anchor", "actual", (F.col("predicted") >= 0).alias("not_negative")
    )


def _lookbacks(d: DemandSeries) -> DataFrame:
    by_window = {
        days: materialize(features.demand_features(d.dense, d.seasonality, d.calendar, window=days)) for days in (30, 60, 90)
    }
    return models.compare_lookbacks(by_window).select("lookback", (F.col("mape") > 0).alias("scored"))


def _tuned(d: DemandSeries) -> DataFrame:
    rows = materialize(d.features)
    placed = backtest.chronological_split(rows, 0.10, 0.10, order="sale_date")
    scaler = materialize(features.scaler_fit(placed.filter(F.col("split") != "holdout")))
    grid = [models.TreeParams(), models.TreeParams(max_depth=4), models.TreeParams(step_size=0.3)]
    found = models.tune_params(models.model_rows(rows, scaler), grid)
    return found.select("max_depth", "step_size", "max_iter", "train_rows", "held_rows", (F.col("score") > 0).alias("scored"))


MODELS: dict[str, Callable[[DemandSeries], DataFrame]] = {
    "score_forecasts": _score,
    "served_forecasts": _served,
    "walk_forward_cv": _cv,
    "model_importance": _importance,
    "permutation_importance": _permuted,
    "compare_lookbacks": _lookbacks,
    "tune_params": _tuned,
}


def registered() -> dict[str, Query]:
    queries = {name: _on_shop(build) for name, build in {**ANALYTICS, **LOAD}.items()}
    for name, build in {**SERIES, **MODELS}.items():
        queries[name] = _on_shop(lambda s, build=build: rounded(build(series_of(s))))
    for name, build in EVALUATION.items():
        queries[name] = _on_shop(lambda s, build=build: rounded(build(Backtest(s))))
    for name, build in ROUTING.items():
        queries[name] = _on_shop(lambda s, build=build: rounded(build(Backtest(s, "brand"))))
    return queries
