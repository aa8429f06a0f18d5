"""The registered queries once more, as plain SQL over the same tables."""

from __future__ import annotations

import re

ROLES = {
    "r_orders": """
        SELECT order_id, customer_id, order_status, purchase_ts, approved_ts,
               CASE WHEN status <> 'P' THEN carrier_at END AS carrier_ts,
               CASE WHEN status = 'F' THEN carrier_at + ((order_id * 71) % 50000) * INTERVAL '1' MINUTE END AS delivered_ts,
               estimated_ts
        FROM (SELECT *, approved_ts + ((order_id * 53) % 9000) * INTERVAL '1' MINUTE AS carrier_at
              FROM (SELECT *, purchase_ts + ((order_id * 37) % 5000) * INTERVAL '1' MINUTE AS approved_ts
                    FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
                                 CASE WHEN o_orderstatus = 'F' THEN 'delivered'
                                      WHEN o_orderstatus = 'O' THEN 'shipped'
                                      WHEN o_orderkey % 2 = 0 THEN 'canceled' ELSE 'unavailable' END AS order_status,
                                 o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR
                                             + ((o_orderkey * 7) % 60) * INTERVAL '1' MINUTE AS purchase_ts,
                                 o_orderdate + (10 + o_custkey % 20) * INTERVAL '1' DAY AS estimated_ts
                          FROM orders)))""",
    "r_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS item_no, l_partkey AS product_id, l_suppkey AS seller_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) AS freight
        FROM lineitem""",
    "r_products": """
        SELECT p_partkey AS product_id, p_type AS category, p_brand AS brand
        FROM part""",
    "r_sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "r_reviews": """
        SELECT o_orderkey AS review_id, o_orderkey AS order_id,
               CAST(1 + (o_orderkey * 3 + o_custkey) % 5 AS INT) AS review_score,
               CAST(CAST((o_orderkey * 17 + o_custkey) % 201 - 100 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS sentiment_score
        FROM orders""",
    "r_lines": """
        SELECT o.*, i.item_no, i.product_id, i.seller_id, i.price, i.freight
        FROM r_orders o JOIN r_items i ON o.order_id = i.order_id""",
    "r_daily": """
        SELECT CAST(purchase_ts AS DATE) AS sale_date, category, COUNT(*) AS units_sold, SUM(price) AS revenue
        FROM r_lines JOIN r_products USING (product_id)
        WHERE order_status = 'delivered' AND category IS NOT NULL
        GROUP BY ALL""",
    # the same by brand, where 25 categories are wanted
    "r_daily_brand": """
        SELECT CAST(purchase_ts AS DATE) AS sale_date, brand AS category, COUNT(*) AS units_sold, SUM(price) AS revenue
        FROM r_lines JOIN r_products USING (product_id)
        WHERE order_status = 'delivered' AND brand IS NOT NULL
        GROUP BY ALL""",
    "r_dense": """
        SELECT category, sale_date, COALESCE(units_sold, 0) AS units_sold, COALESCE(revenue, 0) AS revenue
        FROM (SELECT DISTINCT category FROM r_daily )
        CROSS JOIN (SELECT CAST(UNNEST(generate_series(MIN(sale_date), MAX(sale_date), INTERVAL 1 DAY)) AS DATE) AS sale_date
                    FROM r_daily )
        LEFT JOIN r_daily USING (category, sale_date)""",
    "r_holidays": """
        SELECT make_date(y, m, d) AS holiday_date
        FROM (VALUES (1995), (1996), (1997), (1998), (1999), (2000), (2001)) AS years(y)
        CROSS JOIN (VALUES (1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)) AS days(m, d)""",
    "r_calendar": """
        SELECT sale_date, CAST(sale_date IN (SELECT holiday_date FROM r_holidays ) AS INT) AS is_holiday,
               COALESCE((SELECT MIN(date_diff('day', sale_date, holiday_date)) FROM r_holidays
                         WHERE date_diff('day', sale_date, holiday_date) BETWEEN 1 AND 30), 30) AS days_to_holiday
        FROM (SELECT CAST(UNNEST(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS sale_date)""",
    "r_season": """
        SELECT category, month_num, CAST(ROUND(CAST(1e2 * units / AVG(units) OVER (PARTITION BY category) AS DECIMAL(30,10)), 1) AS DOUBLE) AS seasonality_index
        FROM (SELECT category, month(sale_date) AS month_num, CAST(SUM(units_sold) AS DOUBLE) AS units FROM r_daily GROUP BY 1, 2)""",
    "r_all_features": """
        SELECT *, rolling_mean_7 - rolling_mean_30 AS trend_strength, lag_1 - lag_7 AS acceleration FROM (
        SELECT sale_date, r_dense.category, CAST(units_sold AS DOUBLE) AS units_sold,
               CAST(LAG(units_sold, 1) OVER w AS DOUBLE) AS lag_1, CAST(LAG(units_sold, 7) OVER w AS DOUBLE) AS lag_7,
               CAST(LAG(units_sold, 14) OVER w AS DOUBLE) AS lag_14, CAST(LAG(units_sold, 30) OVER w AS DOUBLE) AS lag_30,
               AVG(units_sold) OVER w7 AS rolling_mean_7, AVG(units_sold) OVER w30 AS rolling_mean_30,
               COALESCE(STDDEV_SAMP(units_sold) OVER w7, 0) AS rolling_std_7,
               COALESCE(STDDEV_SAMP(units_sold) OVER w30, 0) AS rolling_std_30,
               COALESCE(seasonality_index, 100) AS seasonality_index,
               SIN(2 * PI() * month(sale_date) / 12) AS month_sin, COS(2 * PI() * month(sale_date) / 12) AS month_cos,
               SIN(2 * PI() * (isodow(sale_date) - 1) / 7) AS dow_sin, COS(2 * PI() * (isodow(sale_date) - 1) / 7) AS dow_cos,
               CAST(isodow(sale_date) >= 6 AS INT) AS is_weekend, is_holiday, days_to_holiday
        FROM r_dense
        LEFT JOIN r_calendar USING (sale_date)
        LEFT JOIN r_season ON r_season.category = r_dense.category AND month_num = month(sale_date)
        WINDOW w AS (PARTITION BY r_dense.category ORDER BY sale_date),
               w7 AS (PARTITION BY r_dense.category ORDER BY sale_date ROWS 6 PRECEDING),
               w30 AS (PARTITION BY r_dense.category ORDER BY sale_date ROWS 29 PRECEDING))""",
    "r_features": """
        SELECT * FROM r_all_features WHERE lag_30 IS NOT NULL AND category IN (
            SELECT category FROM r_dense GROUP BY 1 HAVING COUNT(*) FILTER (WHERE units_sold > 0) >= 60)""",
    "r_targets": """
        SELECT * FROM (
        SELECT category, sale_date, units_sold AS anchor, ROW_NUMBER() OVER w - 1 AS row_idx,
               LEAD(units_sold, 1) OVER w AS target_d1, LEAD(units_sold, 2) OVER w AS target_d2,
               LEAD(units_sold, 3) OVER w AS target_d3, LEAD(units_sold, 4) OVER w AS target_d4,
               LEAD(units_sold, 5) OVER w AS target_d5, LEAD(units_sold, 6) OVER w AS target_d6,
               LEAD(units_sold, 7) OVER w AS target_d7
        FROM r_features WINDOW w AS (PARTITION BY category ORDER BY sale_date)) WHERE target_d7 IS NOT NULL""",
    "r_series": """
        SELECT category, ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date) - 1 AS idx, sale_date,
               CAST(units_sold AS DOUBLE) AS y
        FROM r_dense""",
    "r_folds": """
        SELECT category, fold, n - (3 - fold) * 30 - 30 AS train_end, n - (3 - fold) * 30 - 30 AS test_start,
               n - (3 - fold) * 30 AS test_end
        FROM (SELECT category, COUNT(*) AS n FROM r_series GROUP BY 1) CROSS JOIN (VALUES (1), (2), (3)) AS f(fold)
        WHERE n - (3 - fold) * 30 - 30 >= 120""",
    "r_folded": """
        SELECT s.*, fold, train_end, test_start, test_end
        FROM r_series s JOIN r_folds f ON s.category = f.category AND s.idx < f.test_end""",
    "r_test": """
        SELECT category, fold, idx, sale_date, y AS actual, train_end, test_start FROM r_folded WHERE idx >= test_start""",
    "r_last": """
        SELECT 'Last_Value' AS model, t.category, fold, t.idx, t.sale_date, actual, s.y AS predicted,
               CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
        FROM r_test t JOIN r_series s ON s.category = t.category AND s.idx = train_end - 1""",
    "r_average": """
        SELECT 'Average_Demand' AS model, category, fold, idx, sale_date, actual, m AS predicted,
               CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
        FROM r_test JOIN (SELECT category, fold, AVG(y) AS m FROM r_folded
                          WHERE idx < train_end AND idx >= train_end - 30 GROUP BY 1, 2) USING (category, fold)""",
    "r_seasonal": """
        SELECT 'Seasonal_Naive' AS model, t.category, fold, t.idx, t.sale_date, actual, GREATEST(s.y, 0) AS predicted,
               CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
        FROM r_test t JOIN r_series s ON s.category = t.category AND s.idx = train_end - 7 + (t.idx - test_start) % 7""",
    "r_line": """
        SELECT category, fold, regr_slope(y, idx) AS slope, regr_intercept(y, idx) AS base
        FROM r_folded WHERE idx < train_end GROUP BY 1, 2""",
    "r_week": """
        SELECT category, fold, isodow(sale_date) AS wd, AVG(y - base - slope * idx) AS season
        FROM r_folded JOIN r_line USING (category, fold) WHERE idx < train_end GROUP BY 1, 2, 3""",
    "r_spread": """
        SELECT f.category, f.fold, STDDEV_POP(y - base - slope * idx - season) AS spread
        FROM r_folded f JOIN r_line l ON f.category = l.category AND f.fold = l.fold
        JOIN r_week w ON f.category = w.category AND f.fold = w.fold AND wd = isodow(sale_date)
        WHERE idx < train_end GROUP BY 1, 2""",
    "r_trend": """
        SELECT 'Trend_Season' AS model, category, fold, idx, sale_date, actual, GREATEST(fit, 0) AS predicted,
               GREATEST(fit - 1.645 * spread, 0) AS lower, GREATEST(fit + 1.645 * spread, 0) AS upper
        FROM (SELECT t.*, base + slope * idx + season AS fit, spread
              FROM r_test t JOIN r_line l ON t.category = l.category AND t.fold = l.fold
              JOIN r_week w ON t.category = w.category AND t.fold = w.fold AND wd = isodow(sale_date)
              JOIN r_spread d ON t.category = d.category AND t.fold = d.fold)""",
    "r_pred": """
        SELECT * FROM r_last UNION ALL SELECT * FROM r_average UNION ALL SELECT * FROM r_seasonal
        UNION ALL SELECT * FROM r_trend""",
    "r_fold_metrics": """
        SELECT model, category, fold,
               CASE WHEN COUNT(*) FILTER (WHERE actual > 0) >= 5
                    THEN AVG(ABS((actual - predicted) / NULLIF(actual, 0))) FILTER (WHERE actual > 0) * 100 END AS mape,
               CASE WHEN COUNT(*) FILTER (WHERE ABS(actual) + ABS(predicted) > 0) >= 5
                    THEN AVG(ABS(actual - predicted) / NULLIF((ABS(actual) + ABS(predicted)) / 2, 0)) * 100 END AS smape,
               SQRT(AVG((actual - predicted) * (actual - predicted))) AS rmse, AVG(ABS(actual - predicted)) AS mae,
               AVG(predicted - actual) AS bias, AVG(ABS(actual - predicted)) / ANY_VALUE(naive) AS mase
        FROM r_pred JOIN (
            SELECT category, fold, NULLIF(AVG(step), 0) AS naive FROM (
                SELECT category, fold, ABS(y - LAG(y) OVER (PARTITION BY category, fold ORDER BY idx)) AS step
                FROM r_folded WHERE idx < train_end) GROUP BY 1, 2) USING (category, fold)
        GROUP BY 1, 2, 3""",
    "r_metrics": """
        SELECT model, category, AVG(mape) AS mape, AVG(smape) AS smape, AVG(rmse) AS rmse, AVG(mae) AS mae,
               AVG(bias) AS bias, AVG(mase) AS mase, COUNT(*) AS n_folds
        FROM r_fold_metrics GROUP BY 1, 2""",
    "r_moves": """
        SELECT o.category, o.fold, o.idx, h AS horizon, a.y AS actual, l.y AS last_value, s.y AS predicted, avg_demand, l.y AS anchor
        FROM (SELECT category, fold, idx, h, test_start, test_end FROM r_folded
              CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6), (7)) AS steps(h)
              WHERE idx BETWEEN test_start AND test_end - 7) o
        JOIN r_series a ON a.category = o.category AND a.idx = o.idx + h - 1
        JOIN r_series l ON l.category = o.category AND l.idx = o.idx - 1
        JOIN r_series s ON s.category = o.category AND s.idx = o.idx + h - 8
        JOIN (SELECT category, fold, AVG(y) AS avg_demand FROM r_folded WHERE idx < train_end GROUP BY 1, 2) m
          ON m.category = o.category AND m.fold = o.fold""",
    "r_sliding": """
        SELECT *, LEAST(last_value_mape, seasonal_naive_mape, avg_demand_mape) AS best_baseline,
               CASE LEAST(last_value_mape, seasonal_naive_mape, avg_demand_mape)
                    WHEN last_value_mape THEN 'last_value_mape' WHEN seasonal_naive_mape THEN 'seasonal_naive_mape'
                    ELSE 'avg_demand_mape' END AS best_baseline_method
        FROM (SELECT category, AVG(a) AS last_value_mape, AVG(b) AS seasonal_naive_mape, AVG(c) AS avg_demand_mape FROM (
            SELECT category, fold, AVG(ABS(actual - last_value) / actual) * 100 AS a, AVG(ABS(actual - predicted) / actual) * 100 AS b,
                   AVG(ABS(actual - avg_demand) / actual) * 100 AS c
            FROM r_moves WHERE actual > 0 GROUP BY 1, 2 HAVING COUNT(*) >= 5) GROUP BY 1)""",
    "r_against": """
        SELECT category, mape, bias, mase, best_baseline AS baseline_mape
        FROM r_metrics JOIN r_sliding USING (category) WHERE model = 'Trend_Season'""",
    "r_threshold": """
        SELECT COALESCE(AVG(sd), 1.5) AS threshold FROM (
            SELECT STDDEV_POP(mape) AS sd FROM r_fold_metrics WHERE model = 'Trend_Season'
            GROUP BY category HAVING COUNT(mape) >= 2)""",
    "r_labelled": """
        SELECT r_against.*, CASE WHEN baseline_mape - mape IS NULL THEN 'unknown' WHEN baseline_mape - mape > threshold THEN 'genuine_beat'
                      WHEN baseline_mape - mape < -threshold THEN 'loses' ELSE 'no_signal' END AS lift_label
        FROM r_against CROSS JOIN r_threshold""",
    "r_offsets": """
        SELECT horizon, UNNEST([0.8e0, 0.95e0]) AS level, UNNEST([q[2], q[1]]) AS lower_offset, UNNEST([q[3], q[4]]) AS upper_offset
        FROM (SELECT horizon, quantile_cont(actual - predicted, [0.025, 0.1, 0.9, 0.975]) AS q FROM r_moves GROUP BY 1)""",
    "r_results": """
        SELECT * FROM (
        SELECT CASE model WHEN 'Average_Demand' THEN 'baseline' WHEN 'Seasonal_Naive' THEN 'lstm' WHEN 'Trend_Season' THEN 'gbm' END AS model,
               category, mape, CASE WHEN model <> 'Average_Demand' THEN mase END AS mase,
               CASE WHEN model <> 'Average_Demand' THEN 100 - mape END AS forecast_skill_pct,
               CASE WHEN model = 'Trend_Season' THEN threshold / 50 END AS noise_threshold_pp
        FROM r_metrics CROSS JOIN r_threshold)
        WHERE model IS NOT NULL""",
    "r_leaders": """
        SELECT ROW_NUMBER() OVER (ORDER BY avg_mape, model) AS rank, * FROM (
            SELECT model, AVG(mape) AS avg_mape, MEDIAN(mape) AS median_mape, COUNT(mape) AS n_categories, AVG(mase) AS avg_mase,
                   AVG(forecast_skill_pct) AS avg_forecast_skill_pct
            FROM r_results GROUP BY 1)""",
    "r_board": """
        SELECT category, baseline_mape, lstm_mape, gbm_mape,
               CASE WHEN n = 0 THEN 'insufficient_data' WHEN genuine OR n = 1 THEN best ELSE 'no_clear_winner' END AS best_model,
               margin_pp, margin_pct, noise_threshold_pp, threshold_source, genuine AS margin_is_genuine
        FROM (SELECT *, COALESCE(margin_pp > noise_threshold_pp AND margin_pct >= 5, FALSE) AS genuine FROM (
            SELECT *, second - first AS margin_pp, (second - first) / second * 100 AS margin_pct,
                   CASE WHEN n > 0 THEN COALESCE(bar, 1.5) END AS noise_threshold_pp,
                   CASE WHEN n > 0 THEN CASE WHEN bar IS NULL THEN 'flat_floor' ELSE 'gbm_cv' END END AS threshold_source
            FROM (SELECT category, MAX(mape) FILTER (WHERE model = 'baseline') AS baseline_mape,
                         MAX(mape) FILTER (WHERE model = 'lstm') AS lstm_mape, MAX(mape) FILTER (WHERE model = 'gbm') AS gbm_mape,
                         MAX(noise_threshold_pp) FILTER (WHERE model = 'gbm') AS bar, COUNT(mape) AS n,
                         arg_min(model, mape) AS best, MIN(mape) AS first, list_sort(list(mape))[2] AS second
                  FROM r_results GROUP BY 1)))""",
    "r_selection": """
        SELECT category,
               CASE WHEN best_model <> 'no_clear_winner' THEN best_model
                    WHEN CASE leader WHEN 'baseline' THEN baseline_mape WHEN 'lstm' THEN lstm_mape ELSE gbm_mape END IS NOT NULL THEN leader
                    WHEN baseline_mape <= LEAST(lstm_mape, gbm_mape) THEN 'baseline'
                    WHEN lstm_mape <= LEAST(baseline_mape, gbm_mape) THEN 'lstm' ELSE 'gbm' END AS selected_model,
               CASE WHEN margin_is_genuine THEN 'high' ELSE 'low' END AS confidence,
               CASE WHEN best_model = 'insufficient_data' THEN 'no model has a result here'
                    WHEN best_model = 'no_clear_winner' AND CASE leader WHEN 'baseline' THEN baseline_mape WHEN 'lstm' THEN lstm_mape ELSE gbm_mape END IS NOT NULL
                      THEN 'margin (' || margin || ') is under the bar (' || bars || '); global best served'
                    WHEN best_model = 'no_clear_winner' THEN 'margin is under the bar and the global best has no result here; lowest MAPE served'
                    WHEN margin IS NULL THEN 'only model with a result here'
                    ELSE 'lowest MAPE, ahead by ' || margin || '; bar ' || bars END AS reason,
               baseline_mape, lstm_mape, gbm_mape
        FROM (SELECT *, printf('%.2f', CAST(ROUND(CAST(margin_pp AS DECIMAL(30,10)), 2) AS DOUBLE)) || ' points, '
                        || printf('%.1f', CAST(ROUND(CAST(margin_pct AS DECIMAL(30,10)), 1) AS DOUBLE)) || '% relative' AS margin,
                     printf('%.2f', CAST(ROUND(CAST(noise_threshold_pp AS DECIMAL(30,10)), 2) AS DOUBLE)) || ' points and 5% relative' AS bars
              FROM r_board CROSS JOIN (SELECT model AS leader FROM r_leaders WHERE rank = 1))""",
    "r_forecasts": """
        SELECT category, 8 - back AS day, y AS forecast,
               GREATEST(y - spread, 0) AS lower, y + spread AS upper
        FROM (SELECT category, y, back, STDDEV_POP(y) OVER (PARTITION BY category) * 1.96 AS spread
              FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY idx DESC) AS back FROM r_series) WHERE back <= 30)
        WHERE back <= 7""",
    "r_profile": """
        SELECT category, avg_daily_demand, CASE WHEN widest > 0 THEN width / (2 * 1.96) ELSE avg_daily_demand * 0.25 END AS avg_std,
               COALESCE(widest > 0, FALSE) AS interval_based_std
        FROM (SELECT category, AVG(forecast) AS avg_daily_demand, AVG(upper - lower) AS width, MAX(upper - lower) AS widest
              FROM r_forecasts GROUP BY 1)""",
    "r_portfolio": """
        SELECT category, COALESCE(UPPER(selected_model), 'ERROR') AS model, CAST(ROUND(CAST(mean AS DECIMAL(30,10)), 3) AS DOUBLE) AS avg_daily_forecast,
               total AS total_7d, historical_avg, confidence,
               CASE WHEN place / n <= 0.20 THEN 'A' WHEN place / n <= 0.50 THEN 'B' ELSE 'C' END AS abc,
               COALESCE(mean > 0 AND historical_avg > 0 AND NOT (mean3 / historical_avg > 0.3 AND mean3 / historical_avg < 3.0), FALSE) AS scaling_flag
        FROM (SELECT *, CAST(ROUND(CAST(mean AS DECIMAL(30,10)), 3) AS DOUBLE) AS mean3,
                     CAST(ROW_NUMBER() OVER (ORDER BY total DESC, category) AS DOUBLE) AS place, COUNT(*) OVER () AS n
              FROM (SELECT category, AVG(forecast) AS mean, CAST(ROUND(CAST(SUM(forecast) AS DECIMAL(30,10)), 1) AS DOUBLE) AS total FROM r_forecasts GROUP BY 1))
        LEFT JOIN (SELECT category, CAST(ROUND(CAST(AVG(y) FILTER (WHERE y > 0) AS DECIMAL(30,10)), 2) AS DOUBLE) AS historical_avg FROM r_series GROUP BY 1) USING (category)
        LEFT JOIN r_selection USING (category)""",
}


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(30,10))"


def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND({dec(x)}, {digits}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def pct(top: str, bottom: str) -> str:
    return f"(1e2 * {dbl(top)} / NULLIF({dbl(bottom)}, 0))"


def div(top: str, bottom: str) -> str:
    return f"({dbl(top)} / NULLIF({dbl(bottom)}, 0))"


def with_roles(body: str, *names: str, extra: str = "") -> str:
    needed = []

    def add(name: str) -> None:
        for other in ROLES:
            if other != name and re.search(rf"\b{other}\b", ROLES[name]):
                add(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    ctes = [f"{n} AS ({ROLES[n]})" for n in needed]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


LATE = "delivered_ts > estimated_ts"
ON_TIME = "delivered_ts <= estimated_ts"


def _days(a: str, b: str) -> str:
    return f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"


LEAD = _days("purchase_ts", "delivered_ts")
DELAY = _days("estimated_ts", "delivered_ts")
MONTH_SPAN = "purchase_ts >= TIMESTAMP '1998-10-01' AND purchase_ts <= TIMESTAMP '1998-10-31'"


def analytics() -> dict[str, str]:
    q: dict[str, str] = {}
    q["monthly_demand_trend"] = with_roles(
        f"""SELECT strftime(purchase_ts, '%Y-%m') AS order_month, category, COUNT(*) AS total_orders,
                   {dbl('SUM(price)')} AS total_revenue, {rnd(div('SUM(price)', 'COUNT(*)'), 2)} AS avg_order_value
            FROM r_lines JOIN r_products USING (product_id)
            WHERE order_status = 'delivered' AND category IS NOT NULL
              AND purchase_ts BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-12-31'
            GROUP BY 1, 2""",
        "r_lines", "r_products",
    )
    q["daily_demand"] = with_roles(
        f"SELECT sale_date, category, units_sold, {dbl('revenue')} AS revenue FROM r_daily", "r_daily"
    )
    q["rolling_demand"] = with_roles(
        f"""SELECT sale_date AS order_date, category, units_sold AS daily_orders, {dbl('revenue')} AS daily_revenue,
                   {rnd(div('SUM(units_sold) OVER w', 'COUNT(*) OVER w'), 2)} AS rolling_avg_orders,
                   {rnd(div('SUM(revenue) OVER w', 'COUNT(*) OVER w'), 2)} AS rolling_avg_revenue
            FROM r_daily
            WINDOW w AS (PARTITION BY category ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "r_daily",
    )
    q["seller_lead_time"] = with_roles(
        f"""SELECT seller_id, seller_state, total_orders, {rnd('lead', 1)} AS avg_lead_days,
                   {rnd('promised', 1)} AS avg_promised_days, {rnd('spread', 2)} AS lead_time_stddev,
                   {rnd('delay', 1)} AS avg_delay_days, late_deliveries,
                   {rnd(pct('late_deliveries', 'total_orders'), 1)} AS late_pct,
                   {rnd(pct('kept', 'total_orders'), 1)} AS on_time_pct,
                   CASE WHEN spread > 10 AND delay > 5 THEN 'HIGH' WHEN spread > 5 OR delay > 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
                   CASE WHEN spread > 10 AND delay > 5 THEN 'High Risk' WHEN spread > 5 OR delay > 3 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category,
                   {rnd('score', 1)} AS reliability_score,
                   DENSE_RANK() OVER (ORDER BY score DESC) AS seller_rank
            FROM (SELECT *, {dec('GREATEST(0e0, 1e2 - CAST(delay AS DOUBLE) * 5 - CAST(spread AS DOUBLE) * 2)')} AS score FROM timed)""",
        "r_lines", "r_sellers",
        extra=f"""timed AS (
            SELECT seller_id, seller_state, COUNT(*) AS total_orders, AVG({LEAD}) AS lead,
                   AVG({_days('purchase_ts', 'estimated_ts')}) AS promised, {dec(f'STDDEV_POP({LEAD})')} AS spread,
                   {dec(f'AVG({DELAY})')} AS delay, COUNT(*) FILTER (WHERE {DELAY} > 0) AS late_deliveries,
                   COUNT(*) FILTER (WHERE {DELAY} <= 0) AS kept
            FROM r_lines JOIN r_sellers USING (seller_id) WHERE delivered_ts IS NOT NULL
            GROUP BY 1, 2 HAVING COUNT(*) >= 10)""",
    )
    q["reorder_point"] = with_roles(
        f"""SELECT product_id, category, avg_daily_sales, avg_lead_days, sales_stddev,
                   {rnd('1.65e0 * sales_stddev * SQRT(avg_lead_days)', 0)} AS safety_stock,
                   {rnd('avg_daily_sales * avg_lead_days + 1.65e0 * sales_stddev * SQRT(avg_lead_days)', 0)} AS reorder_point,
                   CASE WHEN avg_daily_sales > 5 THEN 'FAST_MOVER' WHEN avg_daily_sales > 1 THEN 'REGULAR' ELSE 'SLOW_MOVER' END AS velocity_class
            FROM (SELECT s.*, COALESCE(lead, 7e0) AS avg_lead_days FROM sales s LEFT JOIN leads USING (product_id))
            JOIN r_products USING (product_id)""",
        "r_lines", "r_products",
        extra=f"""sales AS (
            SELECT product_id, {rnd('AVG(units)', 2)} AS avg_daily_sales, {rnd('STDDEV_POP(units)', 2)} AS sales_stddev
            FROM (SELECT product_id, CAST(purchase_ts AS DATE) AS d, COUNT(*) AS units FROM r_lines
                  WHERE order_status = 'delivered' GROUP BY ALL)
            GROUP BY 1 HAVING COUNT(*) >= 5),
        leads AS (SELECT product_id, {rnd(f'AVG({LEAD})', 1)} AS lead FROM r_lines
                  WHERE delivered_ts IS NOT NULL GROUP BY 1)""",
    )
    q["stockout_runs"] = with_roles(
        f"""SELECT category, MIN(sale_date) AS stockout_start, MAX(sale_date) AS stockout_end, COUNT(*) AS consecutive_days,
                   {dbl('SUM(revenue)')} AS estimated_revenue_loss,
                   {rnd(div(f"SUM({dec('expected')})", 'COUNT(*)'), 1)} AS expected_daily_demand,
                   {rnd('AVG(units_sold)', 1)} AS actual_daily_demand
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date)
                          - ROW_NUMBER() OVER (PARTITION BY category, low ORDER BY sale_date) AS island FROM flagged)
            WHERE low GROUP BY category, island HAVING COUNT(*) >= 3""",
        "r_daily",
        extra="""flagged AS (
            SELECT *, units_sold < expected * 0.5e0 AS low FROM (
                SELECT *, AVG(units_sold) OVER (PARTITION BY category ORDER BY sale_date ROWS 29 PRECEDING) AS expected FROM r_daily))""",
    )
    q["seller_cohort"] = with_roles(
        f"""SELECT strftime(cohort, '%Y-%m') AS cohort_month, strftime(activity, '%Y-%m') AS activity_month,
                   date_diff('month', cohort, activity) AS months_since_join, COUNT(DISTINCT seller_id) AS active_sellers,
                   COUNT(*) AS total_orders, {rnd(pct(f'COUNT(*) FILTER (WHERE {ON_TIME})', 'COUNT(*)'), 1)} AS on_time_pct
            FROM (SELECT seller_id, date_trunc('month', purchase_ts) AS activity, delivered_ts, estimated_ts FROM r_lines
                  WHERE delivered_ts IS NOT NULL)
            JOIN (SELECT seller_id, date_trunc('month', MIN(purchase_ts)) AS cohort FROM r_lines GROUP BY 1) USING (seller_id)
            GROUP BY cohort, activity""",
        "r_lines",
    )
    q["revenue_at_risk"] = with_roles(
        f"""SELECT seller_id, seller_state, total_orders, delayed_orders,
                   {rnd(pct('delayed_orders', 'total_orders'), 1)} AS delay_rate_pct,
                   {dbl('ROUND(revenue, 2)')} AS total_revenue, {dbl('ROUND(late_revenue, 2)')} AS revenue_at_risk,
                   {rnd(pct('late_revenue', 'revenue'), 2)} AS revenue_risk_pct, {rnd('late_days', 1)} AS avg_days_late,
                   max_days_late,
                   CASE WHEN {dec('late_days')} > 10 THEN 'SEVERE' WHEN {dec('late_days')} > 5 THEN 'MODERATE' ELSE 'MINOR' END AS delay_severity,
                   {rnd(pct('delayed_orders', 'total_orders') + ' * 0.6e0 + late_days * 0.4e0', 2)} AS supplier_risk_score
            FROM (SELECT seller_id, seller_state, COUNT(DISTINCT order_id) AS total_orders,
                         COUNT(*) FILTER (WHERE {LATE}) AS delayed_orders, SUM(price + freight) AS revenue,
                         SUM(CASE WHEN {LATE} THEN price + freight ELSE 0 END) AS late_revenue,
                         AVG({DELAY}) FILTER (WHERE {LATE}) AS late_days,
                         MAX(CASE WHEN {LATE} THEN {DELAY} ELSE 0 END) AS max_days_late
                  FROM r_lines JOIN r_sellers USING (seller_id)
                  WHERE delivered_ts IS NOT NULL AND estimated_ts IS NOT NULL GROUP BY 1, 2)
            WHERE total_orders >= 10 AND delayed_orders > 0
            ORDER BY supplier_risk_score DESC, revenue_at_risk DESC, seller_id LIMIT 50""",
        "r_lines", "r_sellers",
    )
    q["seasonality_index"] = with_roles(
        f"""SELECT month_num, strftime(make_date(2000, CAST(month_num AS INT), 1), '%b') AS month_name, category, monthly_orders,
                   {rnd('mean_orders', 1)} AS annual_avg_orders, {rnd('raw', 1)} AS seasonality_index,
                   CASE WHEN raw > 130 THEN 'HIGH_SEASON' WHEN raw < 70 THEN 'LOW_SEASON' ELSE 'NORMAL' END AS season_label
            FROM (SELECT *, {dec(pct('monthly_orders', 'mean_orders'))} AS raw FROM
                  (SELECT *, AVG(monthly_orders) OVER (PARTITION BY category) AS mean_orders FROM
                   (SELECT month(sale_date) AS month_num, category, CAST(SUM(units_sold) AS BIGINT) AS monthly_orders FROM r_daily GROUP BY 1, 2)))""",
        "r_daily",
    )
    q["abc_analysis"] = with_roles(
        f"""SELECT product_id, category, DENSE_RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank, total_units,
                   {dbl('total_revenue')} AS total_revenue,
                   {rnd(pct('total_revenue', 'SUM(total_revenue) OVER ()'), 3)} AS revenue_share_pct, cumulative_pct,
                   {rnd('PERCENT_RANK() OVER (ORDER BY total_revenue DESC) * 100', 2)} AS revenue_percentile_pct,
                   CASE WHEN cumulative_pct <= 80 THEN 'A' WHEN cumulative_pct <= 95 THEN 'B' ELSE 'C' END AS abc_class,
                   CASE WHEN cumulative_pct <= 80 THEN 'Maintain high safety stock - weekly monitoring'
                        WHEN cumulative_pct <= 95 THEN 'Moderate inventory - monthly review'
                        ELSE 'Minimal stock - reorder on demand' END AS inventory_policy,
                   CASE WHEN cumulative_pct <= 80 THEN 100 WHEN cumulative_pct <= 95 THEN 60 ELSE 20 END AS inventory_priority_score,
                   {rnd(div('SUM(total_revenue) OVER (PARTITION BY category)', 'COUNT(*) OVER (PARTITION BY category)'), 2)} AS avg_category_revenue
            FROM (SELECT *, {rnd(pct('SUM(total_revenue) OVER (ORDER BY total_revenue DESC, product_id ROWS UNBOUNDED PRECEDING)', 'SUM(total_revenue) OVER ()'), 1)} AS cumulative_pct
                  FROM (SELECT product_id, category, COUNT(*) AS total_units, SUM(price) AS total_revenue
                        FROM r_items JOIN r_products USING (product_id) WHERE category IS NOT NULL GROUP BY 1, 2))""",
        "r_items", "r_products",
    )
    stages = [
        ("Purchase → Approval", "purchase_ts", "approved_ts"),
        ("Approval → Carrier Pickup", "approved_ts", "carrier_ts"),
        ("Carrier → Customer Delivery", "carrier_ts", "delivered_ts"),
    ]
    union = " UNION ALL ".join(
        f"""SELECT '{label}' AS stage, {rnd('AVG(h)', 1)} AS avg_hours, {dbl('MAX(h)')} AS max_hours,
                   {rnd('STDDEV_POP(h)', 1)} AS stddev_hours, COUNT(h) AS order_count
            FROM (SELECT date_sub('hour', {a}, {b}) AS h FROM complete) WHERE h BETWEEN 0 AND 720"""
        for label, a, b in stages
    )
    q["fulfillment_stages"] = with_roles(
        f"""SELECT stage, avg_hours, {rnd(dec('avg_hours') + ' / 24', 1)} AS avg_days, max_hours, stddev_hours, order_count,
                   CASE WHEN avg_hours = MAX(avg_hours) OVER () THEN '⚠ BOTTLENECK' ELSE '' END AS bottleneck_flag
            FROM ({union})""",
        "r_orders",
        extra="""complete AS (SELECT * FROM r_orders WHERE delivered_ts IS NOT NULL AND approved_ts IS NOT NULL
                                                      AND carrier_ts IS NOT NULL)""",
    )
    q["review_early_warning"] = with_roles(
        f"""SELECT seller_id, review_month, total_reviews, {rnd('stars', 2)} AS avg_star_rating,
                   {rnd('mood', 3)} AS avg_sentiment_score, bad_reviews, bad_review_pct,
                   COALESCE(on_time_pct, 0e0) AS on_time_delivery_pct,
                   {rnd('1e2 - COALESCE(on_time_pct, 0e0)', 1)} AS delivery_failure_pct,
                   CASE WHEN mood < -0.30 THEN 'Strong Negative' WHEN mood < 0 THEN 'Negative'
                        WHEN mood < 0.20 THEN 'Neutral' ELSE 'Positive' END AS sentiment_trend,
                   {rnd('score', 2)} AS supply_risk_score,
                   CASE WHEN score >= 40 THEN 'CRITICAL' WHEN score >= 25 THEN 'WARNING' ELSE 'NORMAL' END AS early_warning_level,
                   DENSE_RANK() OVER (ORDER BY score DESC) AS seller_risk_rank
            FROM (SELECT *, {dec('bad_review_pct * 0.5e0 + (1e2 - COALESCE(on_time_pct, 1e2)) * 0.3e0 + ABS(CAST(mood AS DOUBLE)) * 100 * 0.2e0')} AS score
                  FROM told LEFT JOIN perf USING (seller_id, review_month))""",
        "r_lines", "r_reviews",
        extra=f"""told AS (
            SELECT seller_id, strftime(purchase_ts, '%Y-%m') AS review_month, COUNT(*) AS total_reviews, AVG(review_score) AS stars,
                   {dec(div('SUM(sentiment_score)', 'COUNT(*)'))} AS mood, COUNT(*) FILTER (WHERE review_score <= 2) AS bad_reviews,
                   {rnd(pct('COUNT(*) FILTER (WHERE review_score <= 2)', 'COUNT(*)'), 1)} AS bad_review_pct
            FROM r_lines JOIN r_reviews USING (order_id)
            WHERE review_score IS NOT NULL AND sentiment_score IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= 5),
        perf AS (
            SELECT seller_id, strftime(purchase_ts, '%Y-%m') AS review_month,
                   {rnd(pct(f'COUNT(*) FILTER (WHERE {ON_TIME})', 'COUNT(*)'), 1)} AS on_time_pct
            FROM r_lines WHERE delivered_ts IS NOT NULL GROUP BY 1, 2)""",
    )
    q["report_delayed_sellers"] = with_roles(
        f"""SELECT 'TOP 5 DELAYED SELLERS' AS section, seller_id, COUNT(*) AS total_orders,
                   COUNT(*) FILTER (WHERE {LATE}) AS delayed_orders,
                   {rnd(pct(f'COUNT(*) FILTER (WHERE {LATE})', 'COUNT(*)'), 1)} AS delay_pct,
                   {dbl(f'ROUND(SUM(CASE WHEN {LATE} THEN price ELSE 0 END), 2)')} AS revenue_at_risk
            FROM r_lines WHERE {MONTH_SPAN} AND delivered_ts IS NOT NULL
            GROUP BY seller_id HAVING COUNT(*) >= 5 ORDER BY delay_pct DESC, seller_id LIMIT 5""",
        "r_lines",
    )
    q["report_cancel_alerts"] = with_roles(
        f"""SELECT 'STOCKOUT ALERTS' AS section, category, COUNT(DISTINCT product_id) AS products_at_risk,
                   {dbl('SUM(price)')} AS total_category_revenue, MIN(purchase_ts) AS first_signal_date
            FROM r_lines JOIN r_products USING (product_id)
            WHERE {MONTH_SPAN} AND order_status IN ('canceled', 'unavailable')
            GROUP BY category ORDER BY products_at_risk DESC, category NULLS FIRST LIMIT 10""",
        "r_lines", "r_products",
    )
    q["report_revenue_summary"] = with_roles(
        f"""SELECT 'REVENUE AT RISK SUMMARY' AS section, COUNT(DISTINCT order_id) AS total_orders_this_month,
                   {dbl('SUM(price + freight)')} AS total_revenue,
                   {dbl(f'SUM(CASE WHEN {LATE} THEN price + freight ELSE 0 END)')} AS revenue_at_risk,
                   {rnd(pct(f'COUNT(*) FILTER (WHERE {LATE})', 'COUNT(DISTINCT order_id)'), 1)} AS overall_delay_pct
            FROM r_lines WHERE {MONTH_SPAN} AND delivered_ts IS NOT NULL""",
        "r_lines",
    )
    q["report_reorder_alerts"] = with_roles(
        f"""SELECT 'REORDER ALERTS' AS section, category, product_id, COUNT(*) AS units_sold_this_month,
                   CASE WHEN COUNT(*) < 5 THEN 'CRITICAL — Reorder now' ELSE 'LOW STOCK — Review needed' END AS reorder_status
            FROM r_lines JOIN r_products USING (product_id) WHERE {MONTH_SPAN}
            GROUP BY category, product_id HAVING COUNT(*) < 15 ORDER BY COUNT(*), product_id LIMIT 20""",
        "r_lines", "r_products",
    )
    q["supplier_risk"] = with_roles(
        f"""SELECT seller_id, seller_state, lead_time_variability, delay_pct, {dbl('revenue_at_risk')} AS revenue_at_risk, avg_sentiment,
                   bad_review_pct, {rnd('score', 2)} AS supplier_risk_score,
                   CASE WHEN score >= 50 THEN 'CRITICAL' WHEN score >= 30 THEN 'HIGH' WHEN score >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
                   supplier_rank
            FROM (SELECT *, DENSE_RANK() OVER (ORDER BY score DESC) AS supplier_rank FROM (
                SELECT *, {dec('COALESCE(delay_pct, 0e0) * 0.35e0 + COALESCE(lead_time_variability, 0e0) * 1.5e0 + COALESCE(bad_review_pct, 0e0) * 0.25e0 + ABS(COALESCE(avg_sentiment, 0e0)) * 100 * 0.15e0')} AS score
                FROM r_sellers LEFT JOIN timing USING (seller_id) LEFT JOIN money USING (seller_id) LEFT JOIN told USING (seller_id)))
            ORDER BY score DESC, seller_id LIMIT 100""",
        "r_lines", "r_sellers", "r_reviews",
        extra=f"""timing AS (
            SELECT seller_id, {rnd(f'STDDEV_POP({LEAD})', 2)} AS lead_time_variability,
                   {rnd(pct(f'COUNT(*) FILTER (WHERE {LATE})', 'COUNT(*)'), 2)} AS delay_pct
            FROM r_lines WHERE delivered_ts IS NOT NULL GROUP BY 1),
        money AS (
            SELECT seller_id, ROUND(SUM(CASE WHEN {LATE} THEN price + freight ELSE 0 END), 2) AS revenue_at_risk FROM r_lines GROUP BY 1),
        told AS (
            SELECT seller_id, {rnd(div('SUM(sentiment_score)', 'COUNT(*)'), 3)} AS avg_sentiment,
                   {rnd(pct('COUNT(*) FILTER (WHERE review_score <= 2)', 'COUNT(*)'), 2)} AS bad_review_pct
            FROM r_reviews JOIN r_lines USING (order_id) WHERE sentiment_score IS NOT NULL GROUP BY 1)""",
    )
    q["top_categories"] = with_roles(
        """SELECT brand AS category, COUNT(*) AS total_orders FROM r_lines JOIN r_products USING (product_id)
           WHERE order_status = 'delivered' AND brand IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "r_lines", "r_products",
    )
    return q



def rounded(name: str, columns: str, tail: str = "", source: str | None = None, by_brand: bool = False) -> str:
    """Columns of a role, the ones marked ~ rounded to six places."""
    out = []
    for item in re.split(r",\s*(?![^()]*\))", columns):  # commas outside parentheses
        expression, _, alias = item.lstrip("~").partition(" AS ")
        alias = (alias or expression).strip()
        out.append(f"{rnd(expression, 6)} AS {alias}" if item.startswith("~") else f"{expression} AS {alias}")
    sql = with_roles(f"SELECT {', '.join(out)} FROM {source or name} {tail}", *name.split())
    return re.sub(r"\br_daily\b(?! AS)", "r_daily_brand", _brand(sql)) if by_brand else sql


def _brand(sql: str) -> str:
    """Drop the by-type daily role; the others then read the by-brand one."""
    return sql.replace(f"r_daily AS ({ROLES['r_daily']})", f"r_daily_brand AS ({ROLES['r_daily_brand']})")


def load() -> dict[str, str]:
    def keys(table: str, name: str, key: str) -> str:
        return f"""SELECT '{name}' AS "table", 'unique_key' AS "check", '{key}' AS "column", COUNT(*) AS value, COUNT(*) = 0 AS passed
                   FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"""

    def floor(table: str, name: str, n: int) -> str:
        return f"""SELECT '{name}' AS "table", 'row_floor' AS "check", '' AS "column", COUNT(*) AS value, COUNT(*) >= {n} AS passed FROM {table}"""

    def nulls(table: str, name: str, column: str) -> str:
        return f"""SELECT '{name}' AS "table", 'not_null' AS "check", '{column}' AS "column", COUNT(*) AS value, COUNT(*) = 0 AS passed
                   FROM {table} WHERE {column} IS NULL"""

    def orphans(table: str, name: str, column: str, parent: str) -> str:
        return f"""SELECT '{name}' AS "table", 'foreign_key' AS "check", '{column}' AS "column", COUNT(*) AS value, COUNT(*) = 0 AS passed
                   FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"""

    q: dict[str, str] = {}
    q["dq_report"] = with_roles(
        " UNION ALL ".join([
            floor("r_orders", "orders", 10_000), floor("r_items", "order_items", 100_000), floor("r_sellers", "sellers", 50),
            nulls("r_orders", "orders", "purchase_ts"), nulls("r_orders", "orders", "delivered_ts"),
            nulls("r_products", "products", "category"),
            keys("r_orders", "orders", "order_id"), keys("r_items", "order_items", "order_id,item_no"),
            keys("r_products", "products", "product_id"),
            orphans("r_orders", "orders", "customer_id", "r_customers"), orphans("r_items", "order_items", "order_id", "r_orders"),
            orphans("r_items", "order_items", "product_id", "r_products"), orphans("r_items", "order_items", "seller_id", "r_sellers"),
            orphans("r_reviews", "reviews", "order_id", "r_orders"),
        ]),
        "r_orders", "r_items", "r_products", "r_sellers", "r_reviews",
        extra="r_customers AS (SELECT c_custkey AS customer_id FROM customer)",
    )
    q["keep_first"] = with_roles(
        f"""SELECT order_id, item_no, product_id, seller_id, {dbl('price')} AS price, {dbl('freight')} AS freight FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, item_no ORDER BY product_id, seller_id, price, freight) AS place FROM r_items)
            WHERE place = 1""",
        "r_items",
    )
    q["table_catalogue"] = with_roles(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS table_rows FROM {table}"
            for name, table in [("orders", "r_orders"), ("order_items", "r_items"), ("products", "r_products"), ("sellers", "r_sellers"),
                                ("reviews", "r_reviews"), ("customers", "customer"), ("documents", "documents")]
        ),
        "r_orders", "r_items", "r_products", "r_sellers", "r_reviews",
    )
    scored = r"""texts AS (
            SELECT doc_id AS review_id, CASE WHEN lang = 'es' THEN CAST(0.25 AS DECIMAL(5,4)) END AS given,
                   regexp_extract_all(lower(trim(COALESCE(source, '') || ' ' || COALESCE(text, ''))), '[\p{L}'']+') AS words
            FROM documents),
        tokens AS (SELECT review_id, UNNEST(words) AS token, generate_subscripts(words, 1) AS place FROM texts),
        marked AS (
            SELECT *, COALESCE(LAG(token, 1) OVER w IN ('no', 'un', 'of'), FALSE) OR COALESCE(LAG(token, 2) OVER w IN ('no', 'un', 'of'), FALSE)
                      OR COALESCE(LAG(token, 3) OVER w IN ('no', 'un', 'of'), FALSE) AS negated
            FROM tokens WINDOW w AS (PARTITION BY review_id ORDER BY place)),
        totals AS (
            SELECT review_id, SUM(CAST(weight AS DOUBLE) * CASE WHEN negated THEN -0.74e0 ELSE 1 END) AS total
            FROM marked JOIN (VALUES ('best', 3.2), ('idiot', -2.3), ('stupid', -2.4), ('disgusting', -2.4), ('loser', -2.4),
                                     ('clown', -1.1), ('is', 0.2), ('that', -0.1), ('la', 0.3)) AS lex(token, weight) USING (token)
            GROUP BY 1),
        scores AS (
            SELECT review_id, given, CAST(ROUND(CAST(COALESCE(total / SQRT(total * total + 15), 0) AS DECIMAL(30,10)), 4) AS DOUBLE) AS sentiment_score
            FROM texts LEFT JOIN totals USING (review_id))"""
    q["sentiment_score"] = f"WITH {scored} SELECT review_id, sentiment_score FROM scores"
    q["sentiment_distribution"] = f"""WITH {scored}
        SELECT COUNT(*) FILTER (WHERE sentiment_score > 0.05) AS positive,
               COUNT(*) FILTER (WHERE sentiment_score BETWEEN -0.05 AND 0.05) AS neutral,
               COUNT(*) FILTER (WHERE sentiment_score < -0.05) AS negative, {rnd('AVG(sentiment_score)', 3)} AS mean FROM scores"""
    q["sentiment_backfill"] = f"WITH {scored} SELECT review_id, COALESCE(CAST(given AS DOUBLE), sentiment_score) AS sentiment_score FROM scores"
    return q


FEATURE_LIST = (
    "~units_sold, ~lag_1, ~lag_7, ~lag_14, ~lag_30, ~rolling_mean_7, ~rolling_mean_30, ~rolling_std_7, ~rolling_std_30, "
    "~seasonality_index, ~month_sin, ~month_cos, ~dow_sin, ~dow_cos, is_weekend, is_holiday, days_to_holiday, "
    "~trend_strength, ~acceleration"
)
SCALED = ("lag_1 lag_7 lag_14 lag_30 rolling_mean_7 rolling_mean_30 rolling_std_7 rolling_std_30 "
          "seasonality_index trend_strength acceleration").split()


def series() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dense_demand"] = rounded("r_dense", "category, sale_date, units_sold, ~revenue")
    q["category_stats"] = with_roles(
        f"""SELECT category, COUNT(*) AS total_days, COUNT(*) FILTER (WHERE units_sold = 0) AS zero_days,
                   COUNT(*) FILTER (WHERE units_sold > 0) AS active_days,
                   {rnd(pct('COUNT(*) FILTER (WHERE units_sold = 0)', 'COUNT(*)'), 1)} AS zero_pct,
                   COALESCE({rnd('AVG(units_sold) FILTER (WHERE units_sold > 0)', 2)}, 0) AS avg_daily_demand,
                   {pct('COUNT(*) FILTER (WHERE units_sold = 0)', 'COUNT(*)')} > 40 AS sparse,
                   COUNT(*) FILTER (WHERE units_sold > 0) >= 60 AS usable
            FROM r_dense GROUP BY 1""",
        "r_dense",
    )
    q["holiday_calendar"] = with_roles(
        """SELECT sale_date, is_holiday, days_to_holiday, COALESCE(categories, 0) AS categories,
                  CAST(COALESCE(units, 0) AS BIGINT) AS units_sold
           FROM r_calendar LEFT JOIN (
               SELECT sale_date, COUNT(DISTINCT category) AS categories, SUM(units_sold) AS units FROM r_daily GROUP BY 1
           ) USING (sale_date)""",
        "r_calendar", "r_daily",
    )
    q["demand_features"] = rounded("r_features", f"sale_date, category, {FEATURE_LIST}")
    ends = ", ".join(
        ["~MIN(LN(1 + units_sold)) AS units_sold_min, ~MAX(LN(1 + units_sold)) AS units_sold_max"]
        + [f"~MIN({c}) AS {c}_min, ~MAX({c}) AS {c}_max" for c in SCALED]
    )
    q["scaler_fit"] = rounded("r_features", ends)
    moved = FEATURE_LIST.replace("~units_sold", "~(LN(1 + units_sold) - lo) / (hi - lo) AS units_sold")
    for c in SCALED:
        unit = f"~COALESCE(({c} - MIN({c}) OVER ()) / NULLIF(MAX({c}) OVER () - MIN({c}) OVER (), 0), 0) AS {c}"
        moved = re.sub(rf"~{c}\b", unit, moved)
    q["scaler_apply"] = rounded(
        "r_features", f"sale_date, category, {moved}",
        source="r_features CROSS JOIN (SELECT MIN(LN(1 + units_sold)) AS lo, MAX(LN(1 + units_sold)) AS hi FROM r_features)",
    )
    q["to_raw_scale"] = rounded("r_features", "category, sale_date, ~units_sold")
    q["latest_feature_row"] = with_roles(
        "SELECT category, sale_date AS as_of, " + ", ".join(
            (f"{rnd(c[1:], 6)} AS {c[1:]}" if c.startswith("~") else c) for c in (x.strip() for x in FEATURE_LIST.split(","))
        ) + f""", {rnd('units_sold', 6)} AS anchor, CASE WHEN lag_30 IS NULL THEN 'not enough history for lag_30' END AS error
            FROM r_all_features WHERE sale_date = (SELECT MAX(sale_date) - 10 FROM r_daily)""",
        "r_all_features", "r_daily",
    )
    targets = ", ".join(f"~target_d{i}" for i in range(1, 8))
    q["horizon_targets"] = rounded("r_targets", f"category, sale_date, row_idx, ~anchor, {targets}")
    q["smooth_target"] = with_roles(
        f"""SELECT category, sale_date, {rnd('AVG(units_sold) OVER (PARTITION BY category ORDER BY sale_date ROWS 6 PRECEDING)', 6)} AS units_sold
            FROM r_features""",
        "r_features",
    )
    q["sequence_dataset"] = with_roles(
        f"""SELECT category, idx, sale_date, {dbl('units_sold')} AS anchor, {dbl('old')} AS oldest_units, {dbl('lag_7')} AS newest_lag_7,
                   {dbl('units')} AS units_in_x, {dbl('y1')} AS y_first, {dbl('y7')} AS y_last
            FROM (SELECT *, ROW_NUMBER() OVER w - 1 AS idx, LAG(units_sold, 29) OVER w AS old,
                         SUM(units_sold) OVER (PARTITION BY category ORDER BY sale_date ROWS 29 PRECEDING) AS units,
                         LEAD(units_sold, 1) OVER w AS y1, LEAD(units_sold, 7) OVER w AS y7
                  FROM r_features WINDOW w AS (PARTITION BY category ORDER BY sale_date))
            WHERE old IS NOT NULL AND y7 IS NOT NULL""",
        "r_features",
    )
    names = [c.strip().lstrip("~") for c in FEATURE_LIST.split(",")]
    back = ", ".join(f"SUM({c}) OVER b AS sum_{c}, SUM({c} * idx) OVER b AS by_idx_{c}" for c in names)
    sums = ", ".join(f"{rnd(f'sum_{c}', 6)} AS sum_{c}, {rnd(f'by_idx_{c} - (idx - 30) * sum_{c}', 6)} AS turn_{c}" for c in names)
    ahead = ", ".join(f"LEAD(units_sold, {i}) OVER w AS y{i}" for i in range(1, 8))
    q["sequence_sums"] = with_roles(
        f"""SELECT category, idx - 1 AS idx, sale_date, {dbl('units_sold')} AS anchor, {sums},
                   {dbl(' + '.join(f'y{i}' for i in range(1, 8)))} AS sum_y, {dbl(' + '.join(f'{i} * y{i}' for i in range(1, 8)))} AS turn_y
            FROM (SELECT *, {back}, {ahead} FROM (SELECT category, sale_date, {', '.join(f'{rnd(c, 6)} AS {c}' for c in names)},
                             ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date) AS idx FROM r_features)
                  WINDOW w AS (PARTITION BY category ORDER BY sale_date),
                         b AS (PARTITION BY category ORDER BY sale_date ROWS 29 PRECEDING))
            WHERE idx >= 30 AND y7 IS NOT NULL""",
        "r_features",
    )
    q["category_index"] = with_roles(
        "SELECT category, CAST(ROW_NUMBER() OVER (ORDER BY category) - 1 AS INT) AS id FROM (SELECT DISTINCT category FROM r_daily)", "r_daily"
    )
    q["split_report"] = with_roles(
        """SELECT category, n, CAST(n - GREATEST(1, FLOOR(n * 0.1e0)) - GREATEST(1, FLOOR(n * 0.07e0)) AS BIGINT) AS train,
                  n - GREATEST(1, FLOOR(n * 0.1e0)) - GREATEST(1, FLOOR(n * 0.07e0)) >= 5 AS kept
           FROM (SELECT category, COUNT(*) AS n FROM r_targets GROUP BY 1)""",
        "r_targets",
    )
    q["chronological_split"] = with_roles(
        """SELECT category, split, COUNT(*) AS n, MIN(sale_date) AS first_day, MAX(sale_date) AS last_day FROM (
            SELECT category, sale_date, CASE WHEN place <= n - es - ho THEN 'train' WHEN place <= n - ho THEN 'es' ELSE 'holdout' END AS split
            FROM (SELECT *, GREATEST(1, FLOOR(n * 0.1e0)) AS es, GREATEST(1, FLOOR(n * 0.07e0)) AS ho FROM (
                SELECT *, row_idx + 1 AS place, COUNT(*) OVER (PARTITION BY category) AS n FROM r_targets))
            WHERE n - es - ho >= 5) GROUP BY 1, 2""",
        "r_targets",
    )
    return q


def evaluation() -> dict[str, str]:
    q: dict[str, str] = {}
    prediction = "model, category, fold, idx, sale_date, ~actual, ~predicted, ~lower, ~upper"
    q["walk_forward_folds"] = rounded("r_folds", "category, fold, train_end, test_start, test_end")
    q["fold_report"] = with_roles(
        """SELECT category, CAST(fold AS INT) AS fold, n AS days, CAST(120 + 30 * (4 - fold) AS BIGINT) AS needed,
                  n >= 120 + 30 * (4 - fold) AS kept
           FROM (SELECT category, COUNT(*) AS n FROM r_series GROUP BY 1) CROSS JOIN (VALUES (1), (2), (3)) AS f(fold)""",
        "r_series",
    )
    q["baseline_last_value"] = rounded("r_last", prediction)
    q["baseline_average"] = rounded("r_average", prediction)
    q["baseline_seasonal_naive"] = rounded("r_seasonal", prediction)
    q["baseline_trend_season"] = rounded("r_trend", prediction)
    q["sliding_baselines"] = rounded(
        "r_sliding",
        "category, ~last_value_mape, ~seasonal_naive_mape, ~avg_demand_mape, ~best_baseline, best_baseline_method",
    )
    metrics = "~mape, ~smape, ~rmse, ~mae, ~bias, ~mase"
    q["forecast_metrics"] = rounded("r_fold_metrics", f"model, category, fold, {metrics}")
    q["interval_coverage"] = with_roles(
        f"""SELECT category, {rnd('c', 6)} AS coverage, CASE WHEN c < 80 THEN 'OVERCONFIDENT — intervals too narrow'
                   WHEN c > 95 THEN 'CONSERVATIVE — intervals too wide' ELSE 'WELL-CALIBRATED' END AS coverage_quality
            FROM (SELECT category, AVG(CAST(actual BETWEEN lower AND upper AS DOUBLE)) * 100 AS c FROM r_trend GROUP BY 1)""",
        "r_trend",
    )
    q["fold_average"] = rounded("r_metrics", f"model, category, {metrics}, n_folds")
    q["residual_diagnostics"] = with_roles(
        f"""SELECT model, category, {rnd('AVG(r)', 6)} AS mean_residual, {rnd('STDDEV_POP(r)', 6)} AS std_residual,
                   {rnd('MAX(r)', 6)} AS max_overforecast, {rnd('MIN(r)', 6)} AS max_underforecast,
                   COUNT(*) FILTER (WHERE actual = 0) AS zero_day_count,
                   {rnd('AVG(CAST(ABS(r / (actual + 1e-6)) < 0.2 AS DOUBLE)) * 100', 6)} AS pct_within_20pct,
                   {rnd('AVG(r) FILTER (WHERE isodow(sale_date) >= 6) - AVG(r) FILTER (WHERE isodow(sale_date) < 6)', 6)} AS weekend_bias,
                   ABS(AVG(r) FILTER (WHERE isodow(sale_date) >= 6) - AVG(r) FILTER (WHERE isodow(sale_date) < 6)) > 1 AS has_weekend_bias
            FROM (SELECT *, actual - predicted AS r FROM r_pred) GROUP BY 1, 2""",
        "r_pred",
    )
    # with 90 pairs the 5 % point of Student's t lies at 1.9869787
    q["paired_error_test"] = with_roles(
        f"""SELECT category, 'Average_Demand' AS model_a, 'Trend_Season' AS model_b, n, {rnd('t', 6)} AS t, ABS(t) > 1.9869787 AS significant,
                   CASE WHEN ABS(t) > 1.9869787 THEN CASE WHEN t < 0 THEN 'Average_Demand' ELSE 'Trend_Season' END END AS better
            FROM (SELECT category, COUNT(*) AS n, AVG(gap) / (STDDEV_SAMP(gap) / SQRT(COUNT(*))) AS t FROM (
                SELECT a.category, ABS(a.actual - a.predicted) - ABS(b.actual - b.predicted) AS gap
                FROM r_average a JOIN r_trend b ON a.category = b.category AND a.fold = b.fold AND a.idx = b.idx) GROUP BY 1)
            WHERE category IN (SELECT category FROM r_metrics GROUP BY 1 HAVING
                ABS(MAX(mape) FILTER (WHERE model = 'Average_Demand') - MAX(mape) FILTER (WHERE model = 'Trend_Season')) < 5)""",
        "r_average", "r_trend", "r_metrics",
    )
    q["forecast_skill"] = rounded(
        "r_against", "category, ~mape, ~bias, ~mase, ~baseline_mape, ~(baseline_mape - mape) / baseline_mape * 100 AS skill_pct"
    )
    q["noise_threshold"] = rounded("r_threshold", "~threshold")
    q["classify_lift"] = rounded("r_labelled", "category, ~mape, ~bias, ~mase, ~baseline_mape, lift_label")
    directed = """moved AS (
            SELECT *, CASE WHEN ABS((actual - anchor) / GREATEST(ABS(anchor), 1e-6)) < 0.02 THEN 0 ELSE SIGN(actual - anchor) END AS da,
                   CASE WHEN ABS((predicted - anchor) / GREATEST(ABS(anchor), 1e-6)) < 0.02 THEN 0 ELSE SIGN(predicted - anchor) END AS dp
            FROM r_moves),
        accuracy AS (SELECT category, AVG(CAST(da = dp AS DOUBLE)) * 100 AS m, AVG(CAST(da = 0 AS DOUBLE)) * 100 AS p, COUNT(*) AS n FROM moved GROUP BY 1),
        bar AS (SELECT COALESCE(AVG(sd), 5) AS bar FROM (
            SELECT STDDEV_POP(m) AS sd FROM (SELECT category, fold, AVG(CAST(da = dp AS DOUBLE)) * 100 AS m FROM moved GROUP BY 1, 2)
            GROUP BY category HAVING COUNT(*) >= 2))"""
    measures = f"""category, {rnd('m', 6)} AS model_directional_acc, {rnd('p', 6)} AS persistence_directional_acc, n AS n_obs,
                   {rnd('1e2 / 3', 6)} AS random_guess_directional_acc, {rnd('m - p', 6)} AS directional_lift_pp,
                   {rnd('m - 1e2 / 3', 6)} AS directional_lift_vs_random_pp, {rnd('p', 6)} AS flat_share"""
    q["directional_accuracy"] = with_roles(f"SELECT {measures} FROM accuracy", "r_moves", extra=directed)

    def label(x: str) -> str:
        return f"CASE WHEN {x} > bar THEN 'genuine_beat' WHEN {x} < -bar THEN 'loses' ELSE 'no_signal' END"

    q["directional_lift_label"] = with_roles(
        f"""SELECT {measures}, {rnd('bar', 6)} AS directional_noise_threshold_pp, {label('m - p')} AS directional_lift_label,
                   {label('m - 1e2 / 3')} AS directional_lift_vs_random_label FROM accuracy CROSS JOIN bar""",
        "r_moves", extra=directed,
    )
    q["level_bias"] = with_roles(
        f"""SELECT category, {rnd('a', 6)} AS mean_actual, {rnd('p', 6)} AS mean_predicted, CASE WHEN p < a THEN 'UNDER' ELSE 'OVER' END AS direction,
                   {rnd('ABS(p - a)', 6)} AS gap FROM (SELECT category, AVG(actual) AS a, AVG(predicted) AS p FROM r_moves GROUP BY 1)""",
        "r_moves",
    )
    q["worst_category"] = with_roles(
        f"""SELECT category, {rnd('mape', 6)} AS mape, {rnd('baseline_mape', 6)} AS baseline_mape, {rnd('skill', 6)} AS skill_pct, {rnd('bias', 6)} AS bias,
                   CASE WHEN bias > 0 THEN 'over-forecasting' ELSE 'under-forecasting' END AS direction, {rnd('lo', 6)} AS recent_min,
                   {rnd('hi', 6)} AS recent_max, {rnd('mean', 6)} AS recent_mean, {rnd('sd', 6)} AS recent_std, {rnd('sd / GREATEST(mean, 1e-6)', 6)} AS recent_cv
            FROM (SELECT *, (baseline_mape - mape) / baseline_mape * 100 AS skill FROM r_labelled WHERE lift_label = 'loses' ORDER BY skill, category LIMIT 1)
            LEFT JOIN (SELECT category, MIN(y) AS lo, MAX(y) AS hi, AVG(y) AS mean, STDDEV_POP(y) AS sd FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY idx DESC) AS back FROM r_series) WHERE back <= 60 GROUP BY 1) USING (category)""",
        "r_labelled", "r_series",
    )
    q["beat_target"] = with_roles(
        f"""SELECT category, model AS best_model, {rnd('mape', 6)} AS best_baseline, {rnd('mape * 0.85', 6)} AS target_mape, mase < 1 AS beats_naive
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY mape, model) AS place FROM r_metrics WHERE mape IS NOT NULL) WHERE place = 1""",
        "r_metrics",
    )
    q["residual_intervals"] = rounded("r_offsets", "horizon, ~level, ~lower_offset, ~upper_offset")
    bounds = """offsets AS (
            SELECT horizon, UNNEST([0.8e0, 0.95e0]) AS level, UNNEST([q[2], q[1]]) AS lower_offset, UNNEST([q[3], q[4]]) AS upper_offset
            FROM (SELECT horizon, quantile_cont(actual - predicted, [0.025, 0.1, 0.9, 0.975]) AS q FROM r_moves WHERE fold = 1 GROUP BY 1)),
        bounds AS (
            SELECT r_moves.*, level, GREATEST(predicted + lower_offset, 0) AS lower, GREATEST(predicted + upper_offset, 0) AS upper
            FROM r_moves JOIN offsets USING (horizon) WHERE fold > 1)"""
    own = """offsets AS (
            SELECT horizon, category, UNNEST([0.8e0, 0.95e0]) AS level, UNNEST([q[2], q[1]]) AS lo, UNNEST([q[3], q[4]]) AS hi
            FROM (SELECT horizon, category, quantile_cont(actual - predicted, [0.025, 0.1, 0.9, 0.975]) AS q
                  FROM r_moves WHERE fold < 3 GROUP BY 1, 2))"""
    q["quantile_bounds"] = with_roles(
        f"""SELECT category, fold, idx, horizon, {rnd('actual', 6)} AS actual, {rnd('predicted', 6)} AS predicted, {rnd('level', 6)} AS level,
                   {rnd('GREATEST(predicted + lo, 0)', 6)} AS lower, {rnd('GREATEST(predicted + hi, 0)', 6)} AS upper
            FROM r_moves JOIN offsets USING (horizon, category) WHERE fold = 3""",
        "r_moves", extra=own,
    )
    q["conformal_pad"] = with_roles(
        f"""SELECT horizon, {rnd('level', 6)} AS level, {rnd('pad', 6)} AS conformal_pad, {rnd('raw', 6)} AS raw_coverage, {rnd('cal', 6)} AS padded_coverage,
                   {rnd('width', 6)} AS raw_width, {rnd('width + 2 * pad', 6)} AS padded_width,
                   ABS(raw - level) < 0.07 AS well_calibrated_raw, ABS(cal - level) < 0.07 AS well_calibrated
            FROM (SELECT horizon, level, ANY_VALUE(pad) AS pad, AVG(CAST(actual BETWEEN lower AND upper AS DOUBLE)) AS raw,
                         AVG(CAST(actual BETWEEN lower - pad AND upper + pad AS DOUBLE)) AS cal, AVG(upper - lower) AS width
                  FROM bounds JOIN (SELECT horizon, level, CASE level WHEN 0.8e0 THEN q[1] ELSE q[2] END AS pad FROM (
                      SELECT horizon, level, quantile_cont(GREATEST(lower - actual, actual - upper, 0), [0.8, 0.95]) AS q
                      FROM bounds WHERE fold = 2 GROUP BY 1, 2)) USING (horizon, level) WHERE fold = 3 GROUP BY 1, 2)""",
        "r_moves", extra=bounds,
    )
    return q


# the served model against the plain average, as measured over all folds
GAINED = """(SELECT AVG(mape) FILTER (WHERE model = 'Average_Demand') - AVG(mape) FILTER (WHERE model = 'Trend_Season') AS gained
             FROM r_metrics)"""


def routing() -> dict[str, str]:
    def by_brand(name: str, columns: str, tail: str = "", source: str | None = None) -> str:
        return rounded(name, columns, tail, source, by_brand=True)

    def text(body: str, *names: str, extra: str = "") -> str:
        return re.sub(r"\br_daily\b(?! AS)", "r_daily_brand", _brand(with_roles(body, *names, extra=extra)))

    q: dict[str, str] = {}
    q["model_leaderboard"] = by_brand(
        "r_leaders", "rank, model, ~avg_mape, ~median_mape, n_categories, ~avg_mase, ~avg_forecast_skill_pct"
    )
    board = "category, ~baseline_mape, ~lstm_mape, ~gbm_mape"
    q["category_leaderboard"] = by_brand(
        "r_board", f"{board}, best_model, ~margin_pp, ~margin_pct, ~noise_threshold_pp, threshold_source, margin_is_genuine"
    )
    q["skill_tables"] = text(
        " UNION ALL ".join(
            f"SELECT '{a}_vs_{b}' AS comparison, category, {rnd(f'({b}_mape - {a}_mape) / {b}_mape * 100', 6)} AS skill_pct FROM r_board"
            for a, b in [("gbm", "baseline"), ("lstm", "baseline"), ("gbm", "lstm")]
        ),
        "r_board",
    )
    q["model_selection"] = by_brand(
        "r_selection", "category, selected_model, confidence, reason, ~baseline_mape, ~lstm_mape, ~gbm_mape"
    )
    q["selection_counts"] = by_brand("r_selection", "selected_model, COUNT(*) AS categories", "GROUP BY 1")
    q["resolve_model"] = text(
        """SELECT category, CASE WHEN ask = 'gbm' THEN 'gbm' WHEN ask = 'auto' THEN COALESCE(selected_model, leader) END AS model,
                  CASE WHEN ask = 'gbm' THEN 'unknown' WHEN ask = 'auto' THEN COALESCE(confidence, 'low') END AS confidence,
                  ask AS requested, CASE WHEN ask <> 'prophet' THEN ask = 'auto' END AS was_auto, selected_model IS NOT NULL AS known,
                  CASE WHEN ask = 'prophet' THEN 'unknown model prophet' END AS error
           FROM (SELECT DISTINCT category || ending AS category, i, CASE i WHEN 1 THEN 'gbm' WHEN 2 THEN 'prophet' ELSE 'auto' END AS ask
                 FROM r_daily CROSS JOIN (VALUES (0), (1), (2), (3)) AS asks(i) CROSS JOIN (VALUES (''), ('-new')) AS ends(ending))
           LEFT JOIN r_selection USING (category) CROSS JOIN (SELECT model AS leader FROM r_leaders WHERE rank = 1)""",
        "r_selection", "r_leaders", "r_daily",
    )
    q["results_filter"] = by_brand(
        "r_metrics", "model, category, 'global' AS mode, ~mape", "WHERE model <> 'Last_Value'"
    )
    q["flatten_metrics"] = text(
        " UNION ALL ".join(
            f"SELECT category || '__{m}' AS name, {rnd(m, 6)} AS value FROM r_metrics WHERE model = 'Trend_Season'"
            for m in ("mape", "rmse", "bias")
        ),
        "r_metrics",
    )
    q["inventory_plan"] = text(
        f"""SELECT category, {rnd('d', 6)} AS avg_daily_demand, {rnd('avg_std', 6)} AS avg_std, interval_based_std, {rnd('d * 7', 6)} AS lead_time_demand,
                   {rnd('1.65 * avg_std * SQRT(7)', 6)} AS safety_stock, {rnd('d * 7 + 1.65 * avg_std * SQRT(7)', 6)} AS reorder_point,
                   {rnd('d * 365', 6)} AS annual_demand, {rnd('1 - 0.95e0', 6)} AS stockout_prob, {rnd('5e1', 6)} AS stockout_cost_per_unit,
                   {rnd('eoq', 6)} AS eoq, {rnd('COALESCE(d * 365 / NULLIF(eoq, 0), 0)', 6)} AS orders_per_year,
                   {rnd('eoq / 2 * 5', 6)} AS annual_holding_cost, {rnd('(1 - 0.95e0) * d * 7 * 50', 6)} AS expected_stockout_cost,
                   {rnd('COALESCE(d * 365 / NULLIF(eoq, 0), 0) * 500', 6)} AS annual_ordering_cost,
                   {rnd('COALESCE(d * 365 / NULLIF(eoq, 0), 0) * 500 + eoq / 2 * 5', 6)} AS total_annual_cost
            FROM (SELECT *, avg_daily_demand AS d, SQRT(2 * avg_daily_demand * 365 * 500 / 5) AS eoq FROM r_profile)""",
        "r_profile",
    )
    q["business_impact"] = text(
        f"""SELECT category, {rnd('gained', 6)} AS mape_improvement_pct, {rnd('u', 6)} AS units_better_estimated, {rnd('u * 25 * 0.2', 6)} AS excess_holding_savings,
                   {rnd('u * 25', 6)} AS stockout_savings, {rnd('u * 25 * 0.2 + u * 25', 6)} AS total_annual_savings,
                   CASE WHEN gained > 0 THEN {rnd('(u * 25 * 0.2 + u * 25) / gained', 6)} ELSE 0 END AS cost_per_mape_pct
            FROM (SELECT category, gained, avg_daily_demand * 365 * (gained / 100) AS u FROM r_profile CROSS JOIN {GAINED})""",
        "r_profile", "r_metrics",
    )
    q["abc_by_rank"] = text(
        f"""SELECT category, {rnd('total', 6)} AS total, CASE WHEN place <= 0.2 * n THEN 'A' WHEN place <= 0.5 * n THEN 'B' ELSE 'C' END AS abc
            FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY total DESC, category) AS place, COUNT(*) OVER () AS n
                  FROM (SELECT category, SUM(forecast) AS total FROM r_forecasts GROUP BY 1))""",
        "r_forecasts",
    )
    portfolio = "category, model, ~avg_daily_forecast, ~total_7d, ~historical_avg, confidence, abc, scaling_flag"
    q["portfolio"] = by_brand("r_portfolio", portfolio)
    q["demand_spike"] = text(
        f"""SELECT category, uplift_pct, {rnd('f * rop', 6)} AS reorder_point, {rnd('f * ss', 6)} AS safety_stock, {rnd('SQRT(f) * cost', 6)} AS total_annual_cost,
                   {rnd('SQRT(f) * eoq', 6)} AS eoq, {rnd('(f - 1) * rop', 6)} AS reorder_point_delta, {rnd('(f - 1) * ss', 6)} AS safety_stock_delta,
                   {rnd('(SQRT(f) - 1) * cost', 6)} AS cost_delta
            FROM (SELECT category, avg_daily_demand * 7 + 1.65 * avg_std * SQRT(7) AS rop, 1.65 * avg_std * SQRT(7) AS ss,
                         SQRT(2 * avg_daily_demand * 365 * 500 / 5) AS eoq, SQRT(2 * avg_daily_demand * 365 * 500 * 5) AS cost FROM r_profile)
            CROSS JOIN (SELECT u AS uplift_pct, 1 + u / 100 AS f FROM (VALUES (0e0), (5e1), (1e2), (2e2)) AS v(u))""",
        "r_profile",
    )
    q["service_level_curve"] = text(
        f"""SELECT category, {rnd('level', 6)} AS service_level, {rnd('z * avg_std * SQRT(7)', 6)} AS safety_stock FROM r_profile
            CROSS JOIN (VALUES (0.8e0, 0.84), (0.85e0, 1.04), (0.9e0, 1.28), (0.95e0, 1.65), (0.975e0, 1.96), (0.99e0, 2.33)) AS v(level, z)""",
        "r_profile",
    )
    q["lead_time_curve"] = text(
        f"""SELECT category, {dbl('lead')} AS lead_time_days, {rnd('avg_daily_demand * lead + 1.65 * avg_std * SQRT(lead)', 6)} AS reorder_point
            FROM r_profile CROSS JOIN (SELECT UNNEST(range(1, 22, 2)) AS lead)""",
        "r_profile",
    )
    q["executive_summary"] = text(
        f"""SELECT total_categories, {rnd('t', 6)} AS total_7d_demand, {rnd('t / 7', 6)} AS avg_daily_total, {rnd('t / 7 * 7 * 25', 6)} AS inventory_value,
                   {rnd('t / 7 * 365 * (gained / 100) * 25 * 1.2', 6)} AS est_annual_savings, {rnd('gained', 6)} AS mape_points_gained,
                   gbm_routed, total_categories - gbm_routed AS other_routed
            FROM (SELECT COUNT(*) AS total_categories, COUNT(*) FILTER (WHERE model = 'GBM') AS gbm_routed FROM r_portfolio)
            CROSS JOIN (SELECT SUM(forecast) AS t FROM r_forecasts) CROSS JOIN {GAINED}""",
        "r_portfolio", "r_forecasts", "r_metrics",
    )
    q["forecast_export"] = by_brand(
        "r_forecasts", "category, day, ~forecast AS forecast_units, ~lower AS lower_95, ~upper AS upper_95"
    )
    return q


def models() -> dict[str, str]:
    """The rows that the model queries must have, and what holds of each."""
    q: dict[str, str] = {}
    days = "(VALUES (1), (2), (3), (4), (5), (6), (7)) AS days(horizon)"
    served = "(SELECT MAX(sale_date) - 10 AS as_of FROM r_daily)"
    q["score_forecasts"] = with_roles(
        f"""SELECT category, as_of, CAST(horizon AS INT) AS horizon, TRUE AS not_negative
            FROM r_features JOIN {served} ON sale_date = as_of CROSS JOIN {days}""",
        "r_features", "r_daily",
    )
    q["served_forecasts"] = with_roles(
        f"""SELECT category, as_of, CAST(horizon AS INT) AS horizon, level, TRUE AS ordered
            FROM r_features JOIN {served} ON sale_date = as_of CROSS JOIN {days} CROSS JOIN (VALUES (0.8e0), (0.95e0)) AS l(level)""",
        "r_features", "r_daily",
    )
    smooth = f"""smooth AS (
            SELECT category, sale_date, ROW_NUMBER() OVER (PARTITION BY category ORDER BY sale_date) - 1 AS idx,
                   COUNT(*) OVER (PARTITION BY category) AS n,
                   AVG(LN(1 + units_sold)) OVER (PARTITION BY category ORDER BY sale_date ROWS 6 PRECEDING) AS s
            FROM r_features)"""
    q["walk_forward_cv"] = with_roles(
        f"""SELECT a.category, fold, a.idx, a.sale_date, CAST(horizon AS INT) AS horizon, {rnd('EXP(a.s) - 1', 6)} AS anchor,
                   {rnd('EXP(b.s) - 1', 6)} AS actual, TRUE AS not_negative
            FROM smooth a CROSS JOIN (VALUES (1), (2), (3)) AS f(fold) CROSS JOIN {days}
            JOIN smooth b ON b.category = a.category AND b.idx = a.idx + horizon
            WHERE a.n - (4 - fold) * 30 >= 120 AND a.idx >= a.n - (4 - fold) * 30 AND a.idx < a.n - (3 - fold) * 30 AND a.idx + 7 < a.n""",
        "r_features", extra=smooth,
    )
    names = [c.strip().lstrip("~") for c in FEATURE_LIST.split(",")]
    inputs = ", ".join(f"('{c}')" for c in ["category_mean", "category_spread", *names, "anchor"])
    q["model_importance"] = f"SELECT feature, TRUE AS not_negative, 1e0 AS total FROM (VALUES {inputs}) AS f(feature)"
    swapped = ", ".join(f"('{c}')" for c in names)
    q["permutation_importance"] = f"SELECT feature, TRUE AS base_known, TRUE AS spread_known FROM (VALUES {swapped}) AS f(feature)"
    q["compare_lookbacks"] = "SELECT CAST(lookback AS INT) AS lookback, TRUE AS scored FROM (VALUES (30), (60), (90)) AS l(lookback)"
    q["tune_params"] = with_roles(
        f"""SELECT CAST(max_depth AS INT) AS max_depth, step_size, CAST(50 AS INT) AS max_iter, train_rows, held_rows, TRUE AS scored
            FROM (SELECT SUM(n - ho - 7)::BIGINT AS train_rows, SUM(ho)::BIGINT AS held_rows
                  FROM (SELECT COUNT(*) AS n, GREATEST(1, FLOOR(COUNT(*) * 0.1e0)) AS ho FROM r_targets GROUP BY category)
                  WHERE n - 2 * ho >= 5)
            CROSS JOIN (VALUES (5, 0.1e0), (4, 0.1e0), (5, 0.3e0)) AS grid(max_depth, step_size)""",
        "r_targets",
    )
    return q


def registered() -> dict[str, str]:
    return {**analytics(), **load(), **series(), **evaluation(), **routing(), **models()}
