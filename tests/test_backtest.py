import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import backtest, evaluation, intervals

DAY0 = dt.date(2017, 1, 2)


@pytest.fixture(scope="module")
def arrays():
    rng = random.Random(3)
    return {
        "long": np.array([float(rng.randrange(0, 9)) for _ in range(210)]),
        "short": np.array([float(rng.randrange(1, 5)) for _ in range(160)]),
        "tiny": np.array([1.0] * 140),
    }


@pytest.fixture(scope="module")
def series(spark, arrays):
    rows = [(c, i, DAY0 + dt.timedelta(days=i), float(y)) for c, ys in arrays.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "category string, idx int, sale_date date, y double").cache()


def test_folds(series):
    folds = {(r["category"], r["fold"]): r["train_end"] for r in backtest.walk_forward_folds(series).collect()}
    assert folds == {("long", 1): 120, ("long", 2): 150, ("long", 3): 180, ("short", 3): 130}


def test_no_row_in_two_test_windows(series):
    pred = backtest.baseline_last_value(series, backtest.walk_forward_folds(series))
    assert pred.groupBy("category", "idx").count().filter("count > 1").count() == 0
    assert pred.count() == 4 * 30


def test_baselines_equal_brute_force(series, arrays):
    folds = backtest.walk_forward_folds(series)
    got = {(r["model"], r["category"], r["idx"]): r for r in backtest.all_baselines(series, folds).collect()}
    assert len(got) == 4 * 4 * 30
    for (model, category, idx), row in got.items():
        y = arrays[category]
        end = idx - (idx - (len(y) - 90)) % 30 if category == "long" else 130
        train = y[:end]
        if model == "Last_Value":
            assert row["predicted"] == train[-1]
        elif model == "Average_Demand":
            assert row["predicted"] == pytest.approx(train[-30:].mean())
        elif model == "Seasonal_Naive":
            assert row["predicted"] == train[-(7 - (idx - end) % 7)]
        else:
            x = np.arange(end)
            slope, base = np.polyfit(x, train, 1)
            off = train - base - slope * x
            season = np.array([off[k::7].mean() for k in range(7)])
            spread = np.std(off - season[x % 7])
            fit = base + slope * idx + season[idx % 7]
            assert row["predicted"] == pytest.approx(max(fit, 0), abs=1e-9)
            assert row["upper"] == pytest.approx(max(fit + 1.645 * spread, 0), abs=1e-9)


def test_sliding_baselines(series, arrays):
    got = {r["category"]: r for r in backtest.sliding_baselines(series, backtest.walk_forward_folds(series)).collect()}
    y, means = arrays["long"], []
    for end in (120, 150, 180):
        actual, last, season, flat = [], [], [], []
        for i in range(end, end + 30 - 6):
            actual += list(y[i:i + 7])
            last += [y[i - 1]] * 7
            season += list(y[i - 7:i])
            flat += [y[:end].mean()] * 7
        a = np.array(actual)
        ok = a > 0
        means.append([np.mean(np.abs(a[ok] - np.array(p)[ok]) / a[ok]) * 100 for p in (last, season, flat)])
    want = np.mean(means, axis=0)
    row = got["long"]
    assert [row["last_value_mape"], row["seasonal_naive_mape"], row["avg_demand_mape"]] == pytest.approx(list(want))
    assert row["best_baseline"] == pytest.approx(min(want))


def test_metrics(spark):
    rng = random.Random(5)
    rows = [("a", float(rng.randrange(0, 6)), rng.uniform(0, 6)) for _ in range(40)] + [("few", 1.0, 2.0)] * 4 + [("few", 0.0, 0.0)] * 3
    pred = spark.createDataFrame(rows, "c string, actual double, predicted double")
    train = spark.createDataFrame([("a", i, float(i * i % 7)) for i in range(30)] + [("few", i, 2.0) for i in range(5)], "c string, idx int, y double")
    got = {r["c"]: r for r in evaluation.forecast_metrics(pred, ["c"], evaluation.naive_scale(train, ["c"])).collect()}
    a = np.array([r[1] for r in rows if r[0] == "a"])
    p = np.array([r[2] for r in rows if r[0] == "a"])
    naive = np.abs(np.diff([i * i % 7 for i in range(30)])).mean()
    row = got["a"]
    assert row["mape"] == pytest.approx(np.mean(np.abs((a[a > 0] - p[a > 0]) / a[a > 0])) * 100)
    assert row["smape"] == pytest.approx(np.mean(np.abs(a - p) / ((np.abs(a) + np.abs(p)) / 2)) * 100)
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert row["mase"] == pytest.approx(np.mean(np.abs(a - p)) / naive)
    assert row["bias"] == pytest.approx(np.mean(p - a))
    assert got["few"]["mape"] is None and got["few"]["mase"] is None


@pytest.mark.parametrize("t,df,p", [(2.0, 89, 0.04855), (1.9869787, 89, 0.05), (0.5, 4, 0.643330), (3.0, 2, 0.095466), (12.706205, 1, 0.05), (2.5, 29, 0.018343)])
def test_student_p(spark, t, df, p):
    row = spark.range(1).select(evaluation.two_sided_p(F.lit(t), F.lit(df)).alias("p")).first()
    assert row["p"] == pytest.approx(p, abs=2e-5)


def test_paired_test(spark):
    rng = random.Random(2)
    rows = []
    for i in range(30):
        y = float(rng.randrange(5, 15))
        rows += [("A", "c", 1, i, y, y + rng.uniform(-2, 2)), ("B", "c", 1, i, y, y + rng.uniform(-2, 2) * 1.2)]
    pred = spark.createDataFrame(rows, "model string, category string, fold int, idx int, actual double, predicted double")
    gap = np.array([abs(a[4] - a[5]) - abs(b[4] - b[5]) for a, b in zip(rows[::2], rows[1::2])])
    row = evaluation.paired_error_test(pred, "A", "B", max_gap=50).first()
    assert row["n"] == 30 and row["t"] == pytest.approx(gap.mean() / (gap.std(ddof=1) / np.sqrt(30)))
    assert evaluation.paired_error_test(pred, "A", "B", max_gap=0.0).count() == 0


def test_noise_threshold_falls_back(spark):
    one = spark.createDataFrame([("a", 5.0)], "category string, mape double")
    assert evaluation.noise_threshold(one).first()["threshold"] == 1.5
    two = spark.createDataFrame([("a", 4.0), ("a", 8.0), ("b", 1.0), ("b", 1.0), ("c", 9.0)], "category string, mape double")
    assert evaluation.noise_threshold(two).first()["threshold"] == 1.0


def test_directional_accuracy(spark):
    rows = [("c", 10.0, 12.0, 11.0), ("c", 10.0, 8.0, 11.0), ("c", 10.0, 10.1, 10.0), ("c", 0.0, 0.0, 1.0)]
    pred = spark.createDataFrame(rows, "category string, anchor double, actual double, predicted double")
    row = evaluation.directional_accuracy(pred, ["category"]).first()
    assert row["model_directional_acc"] == 50.0 and row["persistence_directional_acc"] == 50.0 and row["n_obs"] == 4


def test_intervals_equal_numpy_and_pad_never_lowers_coverage(spark):
    rng = random.Random(9)
    rows = [("c", i, h, 5 + rng.gauss(0, h), 5.0) for h in (1, 2) for i in range(50)]
    pred = spark.createDataFrame(rows, "category string, idx int, horizon int, actual double, predicted double")
    offsets = intervals.residual_intervals(pred)
    for r in offsets.collect():
        x = [a - p for _, _, h, a, p in rows if h == r["horizon"]]
        assert r["lower_offset"] == pytest.approx(np.quantile(x, (1 - r["level"]) / 2))
        assert r["upper_offset"] == pytest.approx(np.quantile(x, 1 - (1 - r["level"]) / 2))
    bounds = intervals.apply_intervals(pred, offsets).withColumn("lower", F.col("lower") + 0.5)
    for r in intervals.conformal_pad(bounds).collect():
        assert r["padded_coverage"] >= r["raw_coverage"]
        assert r["padded_coverage"] >= r["level"] - 0.02


def test_split_keeps_order_and_drops_short(spark):
    rows = [("a", i) for i in range(30)] + [("b", i) for i in range(5)]
    got = backtest.chronological_split(spark.createDataFrame(rows, "category string, row_idx int"), holdout=0.07).collect()
    parts = {s: [r["row_idx"] for r in got if r["split"] == s] for s in ("train", "es", "holdout")}
    assert {r["category"] for r in got} == {"a"}
    assert (sorted(parts["train"]), sorted(parts["es"]), sorted(parts["holdout"])) == (list(range(25)), [25, 26, 27], [28, 29])


def test_reports_name_what_is_left_out(series):
    kept = {(r["category"], r["fold"]) for r in backtest.walk_forward_folds(series).collect()}
    report = backtest.fold_report(series).collect()
    assert len(report) == 9 and {(r["category"], r["fold"]) for r in report if r["kept"]} == kept
    split = {r["category"] for r in backtest.chronological_split(series, holdout=0.2, min_left=100, order="idx").collect()}
    report = backtest.split_report(series, holdout=0.2, min_left=100).collect()
    assert {r["category"] for r in report if r["kept"]} == split and len(report) == 3 > len(split)
