import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.numeric import half_up, null_aware_greatest
from millrace.operators import demand, features, planning, stock, suppliers
from millrace.plans import monthly_report

T = dt.datetime


def orders_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id int, order_status string, purchase_ts timestamp_ntz, delivered_ts timestamp_ntz, estimated_ts timestamp_ntz",
    )


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "order_id int, product_id int, seller_id int, price int, freight int").withColumns(
        {c: F.col(c).cast("decimal(12,2)") for c in ("price", "freight")}
    )


def test_rounding(spark):
    row = spark.range(1).select(
        half_up(F.lit(1.005), 2).alias("a"), half_up(F.lit(-2.5), 0).alias("b"),
        null_aware_greatest(0.0, F.lit(None).cast("double")).alias("c"), null_aware_greatest(0.0, F.lit(-3.0)).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (1.01, -3.0, None, 0.0)


@pytest.fixture(scope="module")
def shop(spark):
    orders = orders_frame(spark, [
        (1, "delivered", T(2018, 10, 1, 5), T(2018, 10, 11, 9), T(2018, 10, 11, 0)),   # late by hours, not by days
        (2, "delivered", T(2018, 10, 31, 0), T(2018, 11, 9), T(2018, 11, 5)),          # late
        (3, "delivered", T(2018, 10, 31, 8), T(2018, 11, 2), T(2018, 11, 5)),          # on the last day, after midnight
        (4, "canceled", T(2018, 10, 7, 1), None, T(2018, 10, 20)),
    ])
    items = items_frame(spark, [(1, 10, 7, 100, 1), (1, 10, 7, 50, 1), (2, 11, 7, 30, 0), (3, 11, 7, 20, 0), (4, 12, 7, 5, 0)])
    products = spark.createDataFrame([(10, "toys"), (11, "toys"), (12, None)], "product_id int, category string")
    sellers = spark.createDataFrame([(7, "SP"), (8, "RJ")], "seller_id int, seller_state string")
    return orders, items, products, sellers


def test_last_day_is_cut_at_midnight_by_default(shop):
    orders, items, products, _ = shop
    args = (orders, items, products, "2018-10-01", "2018-10-31")
    assert demand.monthly_demand_trend(*args).first()["total_orders"] == 3
    assert demand.monthly_demand_trend(*args, end_inclusive=True).first()["total_orders"] == 4
    assert monthly_report.month_lines(orders, items, "2018-10-15").count() == 4


def test_late_by_day_and_by_time(shop):
    orders, items, _, sellers = shop
    by_day = suppliers.seller_lead_time(orders, items, sellers, min_orders=1).first()
    assert by_day["late_deliveries"] == 1
    by_time = suppliers.revenue_at_risk(orders, items, sellers, min_orders=1).first()
    assert (by_time["total_orders"], by_time["delayed_orders"]) == (3, 3)
    assert by_time["delay_rate_pct"] == 100.0


def test_review_counts_once_per_item_and_missing_delivery_scores_100(spark, shop):
    orders, items, _, sellers = shop
    reviews = spark.createDataFrame([(1, 1, 1, -0.5), (2, 1, 5, 0.5), (3, 4, 2, 0.9), (4, 2, 4, None)], "review_id int, order_id int, review_score int, sentiment_score double")
    row = suppliers.review_early_warning(orders, items, reviews, min_reviews=1).first()
    assert row["total_reviews"] == 5 and row["bad_reviews"] == 3
    risk = {r["seller_id"]: r for r in suppliers.supplier_risk(orders, items, sellers, reviews, limit=None).collect()}
    assert risk[8]["lead_time_variability"] is None and risk[8]["supplier_risk_score"] == 0.0 and risk[8]["risk_category"] == "LOW"
    assert risk[7]["bad_review_pct"] == 60.0
    limited = suppliers.supplier_risk(orders, items, sellers, reviews, limit=2)
    assert sorted(map(tuple, limited.collect()), key=str) == sorted((tuple(r) for r in risk.values()), key=str)


def test_report_sections(shop):
    orders, items, products, _ = shop
    report = monthly_report.monthly_report(orders, items, products, "2018-10-15", "2018-11-01 00:00:00")
    assert report["header"].first()["report_period"] == "2018-10"
    assert report["cancel_alerts"].first()["category"] is None
    assert report["revenue_summary"].first()["overall_delay_pct"] == 150.0
    assert report["reorder_alerts"].count() == 3
    report["lines"].unpersist()


def test_gap_runs(spark):
    day = dt.date(2018, 1, 1)
    units = [10] * 20 + [1, 1, 1] + [10] * 5 + [1, 1] + [10] * 5
    rows = [("c", day + dt.timedelta(days=2 * i), u, u) for i, u in enumerate(units)]
    daily = spark.createDataFrame(rows, "category string, sale_date date, units_sold int, revenue int")
    got = demand.low_demand_runs(daily).collect()
    assert [(r["stockout_start"], r["consecutive_days"], r["estimated_revenue_loss"]) for r in got] == [(day + dt.timedelta(days=40), 3, 3)]


def test_abc_ties_and_null_category(spark):
    items = items_frame(spark, [(1, p, 1, 10, 0) for p in range(1, 11)] + [(1, 99, 1, 500, 0)])
    products = spark.createDataFrame([(p, "c") for p in range(1, 11)] + [(99, None)], "product_id int, category string")
    rows = stock.abc_analysis(items, products).collect()
    assert len(rows) == 10 and {r["revenue_rank"] for r in rows} == {1}
    assert [r["abc_class"] for r in rows] == ["A"] * 8 + ["B"] + ["C"]


def test_dense_demand_fills(spark):
    d = dt.date(2018, 1, 1)
    daily = spark.createDataFrame([("a", d, 1), ("a", d + dt.timedelta(days=2), 2), ("b", d, 5), ("b", d + dt.timedelta(days=3), 1)], "category string, sale_date date, units_sold int")
    zero = {(r[0], r[1]): r[2] for r in features.dense_demand(daily).collect()}
    assert len(zero) == 8 and zero["b", d + dt.timedelta(days=2)] == 0
    observed = {(r["category"], r["sale_date"]): r["units_sold"] for r in features.dense_demand(daily, "observed").collect()}
    assert observed["b", d + dt.timedelta(days=2)] is None and observed["b", d + dt.timedelta(days=1)] == 0


def test_holidays_absent(spark):
    row = features.holiday_calendar(spark, "2018-01-01", "2018-01-03", None).first()
    assert (row["is_holiday"], row["days_to_holiday"]) == (0, 30)


def test_calendar_has_what_was_sold(spark):
    d = dt.date(2018, 1, 2)
    daily = spark.createDataFrame([("a", d, 2), ("b", d, 3)], "category string, sale_date date, units_sold int")
    calendar = features.holiday_calendar(spark, "2018-01-01", "2018-01-03", None)
    got = features.calendar_demand(daily, calendar).orderBy("sale_date").collect()
    assert [(r["categories"], r["units_sold"]) for r in got] == [(0, 0), (2, 5), (0, 0)]


def test_scaler_round_trip_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 3.0), (7.0, 3.0), (0.0, 3.0)], "units_sold double, lag_1 double")
    scaler = features.scaler_fit(df, ["lag_1"])
    scaled = features.scaler_apply(df, scaler)
    assert {r["lag_1"] for r in scaled.collect()} == {0.0}
    back = features.to_raw_scale(scaled, scaler, ["units_sold"]).select("units_sold").collect()
    assert sorted(r[0] for r in back) == pytest.approx([0.0, 1.0, 7.0])


@pytest.fixture(scope="module")
def forecasts(spark):
    rows = [("wide", d, 10.0 + d, 5.0, 25.0) for d in range(1, 8)] + [("flat", d, 4.0, 4.0, 4.0) for d in range(1, 8)]
    rows += [("bare", d, 2.0, None, None) for d in range(1, 8)]
    return spark.createDataFrame(rows, "category string, day int, forecast double, lower double, upper double")


def test_inventory_plan(forecasts):
    got = {r["category"]: r for r in planning.inventory_plan(forecasts).collect()}
    std = 20 / (2 * 1.96)
    assert got["wide"]["interval_based_std"] and got["wide"]["safety_stock"] == pytest.approx(1.65 * std * 7 ** 0.5)
    assert got["wide"]["eoq"] == pytest.approx((2 * 14 * 365 * 500 / 5) ** 0.5)
    assert not got["flat"]["interval_based_std"] and got["flat"]["avg_std"] == 1.0
    assert got["bare"]["avg_std"] == 0.5
    zero = planning.inventory_plan(forecasts, holding_rate=0.0).first()
    assert zero["eoq"] == 0.0 and zero["total_annual_cost"] == 0.0


def test_nearest_z(spark):
    z = spark.range(1).select(*[planning.z_for(F.lit(x)) for x in (0.94, 0.9, 0.2, 1.0)]).first()
    assert tuple(z) == (1.65, 1.28, 0.0, 3.09)


def test_spike_and_abc(spark, forecasts):
    rows = {(r["category"], r["uplift_pct"]): r for r in planning.demand_spike(forecasts).collect()}
    assert rows["bare", 0.0]["reorder_point_delta"] == pytest.approx(0.0)
    assert rows["bare", 100.0]["safety_stock_delta"] == pytest.approx(1.65 * 0.5 * 7 ** 0.5)
    totals = spark.createDataFrame([(f"c{i}", float(i)) for i in range(10)], "category string, total double")
    classes = [r["abc"] for r in planning.abc_by_rank(totals).orderBy(F.desc("total")).collect()]
    assert classes == ["A"] * 2 + ["B"] * 3 + ["C"] * 5
