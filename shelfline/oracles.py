"""The same questions as plain SQL, for checking results with another engine."""

from __future__ import annotations

from shelfline.schemas import FEATURE_COLUMNS, ID_COLUMNS

# -- shared table expressions ------------------------------------------------------

_SPAN = """
span AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS first_day,
         date_diff('day', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))) + 1 AS n_days
  FROM lineitem)"""

_DEMAND = """
demand AS (
  SELECT item_id, store_id, cal_date, sales,
         CAST(date_diff('day', (SELECT first_day FROM span), cal_date) + 1 AS INTEGER) AS day_num
  FROM (
    SELECT p_type || '_' || substring(p_brand, 7) AS item_id, r_name AS store_id,
           CAST(l_shipdate AS DATE) AS cal_date, CAST(sum(l_quantity) AS INTEGER) AS sales
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3))"""

_CALENDAR = """
calendar AS (
  SELECT 'd_' || day_num AS d, day_num, cal_date,
         CAST((dayofweek(cal_date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(cal_date) AS INTEGER) AS month, CAST(year(cal_date) AS INTEGER) AS year,
         CASE strftime(cal_date, '%m-%d') WHEN '01-01' THEN 'NewYear' WHEN '07-04' THEN 'IndependenceDay'
              WHEN '10-31' THEN 'Halloween' WHEN '12-25' THEN 'Christmas' END AS event_name_1,
         CASE strftime(cal_date, '%m-%d') WHEN '01-01' THEN 'National' WHEN '07-04' THEN 'National'
              WHEN '10-31' THEN 'Cultural' WHEN '12-25' THEN 'National' END AS event_type_1
  FROM (SELECT CAST(k + 1 AS INTEGER) AS day_num, CAST(first_day + CAST(k AS INTEGER) AS DATE) AS cal_date
        FROM (SELECT first_day, unnest(range(n_days)) AS k FROM span)))"""

_CELLS = """
cells AS (
  SELECT s.item_id || '_' || s.store_id AS id, s.item_id, split_part(s.item_id, '_', 1) AS dept_id,
         s.store_id, split_part(s.item_id, '_', 1) AS cat_id, s.store_id AS state_id,
         c.d, x.sales, c.day_num, c.cal_date, c.wday, c.month, c.year, c.event_name_1, c.event_type_1
  FROM (SELECT DISTINCT item_id, store_id FROM demand) s
  CROSS JOIN calendar c
  LEFT JOIN demand x ON x.item_id = s.item_id AND x.store_id = s.store_id AND x.day_num = c.day_num)"""

_FACT = """
fact AS (SELECT * REPLACE (coalesce(sales, 0) AS sales) FROM cells)"""

_FEATURES = """
features AS (
  SELECT *,
    CASE WHEN wday IN (1, 2) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS has_event,
    lag(sales, 7) OVER s AS sales_lag_7,
    lag(sales, 14) OVER s AS sales_lag_14,
    lag(sales, 28) OVER s AS sales_lag_28,
    CASE WHEN count(sales) OVER w7 = 7 THEN round(avg(sales) OVER w7, 6) END AS sales_rolling_mean_7,
    CASE WHEN count(sales) OVER w28 = 28 THEN round(avg(sales) OVER w28, 6) END AS sales_rolling_mean_28,
    CASE WHEN count(sales) OVER w7 = 7 THEN round(stddev_samp(sales) OVER w7, 6) END AS sales_rolling_std_7,
    CASE WHEN count(sales) OVER w28 = 28 THEN round(stddev_samp(sales) OVER w28, 6) END AS sales_rolling_std_28
  FROM fact
  WINDOW s AS (PARTITION BY store_id, item_id ORDER BY day_num),
    w7 AS (PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    w28 AS (PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))"""

_SPLIT = f"""
complete AS (
  SELECT * FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_COLUMNS)}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY day_num DESC) AS age,
         count(*) OVER (PARTITION BY store_id, item_id) AS n_rows
  FROM complete),
split AS (SELECT *, age <= 28 AS is_val FROM placed WHERE n_rows > 28)"""

_BACKTEST = """
aged AS (
  SELECT store_id, item_id, day_num, cal_date, sales,
         row_number() OVER (PARTITION BY store_id, item_id ORDER BY day_num DESC) AS r,
         count(*) OVER (PARTITION BY store_id, item_id) AS n
  FROM fact),
levels AS (
  SELECT store_id, item_id,
         avg(sales) FILTER (WHERE r BETWEEN 29 AND 56) AS recent,
         avg(sales) FILTER (WHERE r > 28 AND r - 28 > least(56, n - 28) - 28
                                  AND r - 28 <= least(56, n - 28)) AS earlier,
         avg(sales) FILTER (WHERE r > 28) AS weight,
         count(*) FILTER (WHERE r > 28) AS n_train
  FROM aged WHERE n > 28 GROUP BY 1, 2),
backtest AS (
  SELECT a.store_id, a.item_id, a.day_num, a.cal_date, a.sales, l.weight, l.n_train,
         greatest(0.0, l.recent + (l.recent - l.earlier) / 28.0 * (28 - a.r)) AS predicted,
         greatest(0.0, l.recent) AS level_only
  FROM aged a JOIN levels l ON a.store_id = l.store_id AND a.item_id = l.item_id
  WHERE a.r <= 28)"""

_STORE = """
forecasts AS (
  SELECT item_id, store_id, cal_date AS forecast_date, level_only AS predicted_sales, 'v1.0' AS model_version
  FROM backtest
  UNION ALL
  SELECT item_id, store_id, cal_date, predicted, 'v2.0' FROM backtest),
history AS (
  SELECT item_id, store_id, cal_date AS sale_date, CAST(sales AS DOUBLE) AS actual_sales, v AS model_version
  FROM backtest, (VALUES ('v1.0'), ('v2.0')) AS versions(v)),
scores AS (
  SELECT v AS model_version, store_id, item_id, weight,
         avg(abs(sales - p)) AS mae, sqrt(avg((sales - p) * (sales - p))) AS rmse
  FROM (SELECT *, 'v1.0' AS v, level_only AS p FROM backtest
        UNION ALL SELECT *, 'v2.0' AS v, predicted AS p FROM backtest)
  GROUP BY 1, 2, 3, 4),
runs AS (
  SELECT CAST(CASE model_version WHEN 'v1.0' THEN 1 ELSE 2 END AS BIGINT) AS run_id, model_version,
         CASE model_version WHEN 'v1.0' THEN '2001-11-05 00:00:00' ELSE '2001-12-05 00:00:00' END AS trained_at,
         round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse,
         round(sum(mae * weight) / sum(weight), 6) AS weighted_mae,
         CAST(28 AS INTEGER) AS horizon_days, CAST(count(DISTINCT item_id) AS INTEGER) AS num_items,
         'ALL' AS store_id,
         CASE model_version WHEN 'v1.0' THEN '{"recent_days": 28}'
              ELSE '{"recent_days": 28, "trend_days": 56}' END AS parameters,
         model_version = 'v1.0' AS is_active
  FROM scores GROUP BY model_version),
active AS (SELECT model_version FROM runs WHERE is_active ORDER BY trained_at DESC LIMIT 1),
latest AS (SELECT model_version FROM runs ORDER BY trained_at DESC LIMIT 1),
active_forecasts AS (SELECT * FROM forecasts WHERE model_version = (SELECT model_version FROM active)),
active_history AS (SELECT * FROM history WHERE model_version = (SELECT model_version FROM active)),
latest_forecasts AS (SELECT * FROM forecasts WHERE model_version = (SELECT model_version FROM latest))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_TO_CALENDAR = _with(_SPAN, _CALENDAR)
_TO_DEMAND = _with(_SPAN, _DEMAND)
_TO_FACT = _with(_SPAN, _DEMAND, _CALENDAR, _CELLS, _FACT)
_TO_FEATURES = _with(_SPAN, _DEMAND, _CALENDAR, _CELLS, _FACT, _FEATURES)
_TO_SPLIT = _with(_SPAN, _DEMAND, _CALENDAR, _CELLS, _FACT, _FEATURES, _SPLIT)
_TO_BACKTEST = _with(_SPAN, _DEMAND, _CALENDAR, _CELLS, _FACT, _BACKTEST)
_TO_STORE = _with(_SPAN, _DEMAND, _CALENDAR, _CELLS, _FACT, _BACKTEST, _STORE)

_CALENDAR_LIST = "d, cal_date, wday, month, year, event_name_1, event_type_1"
_IDS = ", ".join(ID_COLUMNS)
_FEATURE_LIST = ", ".join(FEATURE_COLUMNS)

_REAL_FEATURE_LIST = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c.startswith("sales_lag_") else c for c in FEATURE_COLUMNS
)

_PROFILED = [
    *ID_COLUMNS,
    *"d sales day_num cal_date wday month year event_name_1 event_type_1".split(),
]
_PROFILE = "\nUNION ALL\n".join(
    f"""SELECT count(*) AS row_count, '{c}' AS column_name, count(*) - count({c}) AS null_count,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
       count(DISTINCT {c}) AS distinct_count
FROM fact"""
    for c in _PROFILED
)

_SERIES_SCORES = """
series AS (
  SELECT store_id, item_id, avg(abs(sales - predicted)) AS mae,
         sqrt(avg((sales - predicted) * (sales - predicted))) AS rmse,
         max(weight) AS weight, max(n_train) AS n_train, count(*) AS n_val
  FROM backtest GROUP BY store_id, item_id)"""

_SCORED_DAYS = f"""{_TO_SPLIT}
    SELECT store_id, item_id, day_num, cal_date, CAST(sales AS DOUBLE) AS sales, n_rows - 28 AS n_train,
           round(avg(sales) FILTER (WHERE NOT is_val) OVER (PARTITION BY store_id, item_id), 6) AS weight,
           true AS scored
    FROM split QUALIFY is_val"""




def _linear_models() -> str:
    """Ridge regression of every series by elimination on its standardised sums of products."""
    k = len(FEATURE_COLUMNS)
    origin = {"day_num": 1000, "year": 2000}
    shifted = [f"(CAST({c} AS DOUBLE) - {origin.get(c, 0)})" for c in FEATURE_COLUMNS]
    terms = ["CAST(1 AS DOUBLE)", *shifted, "CAST(sales AS DOUBLE)"]
    sums = ", ".join(
        f"sum({terms[i]} * {terms[j]}) AS m_{i}_{j}" for i in range(k + 2) for j in range(i, k + 2)
    )
    at = lambda i, j: f"m_{min(i, j)}_{max(i, j)}"
    centred = lambda i, j: f"({at(i, j)} - m_0_{i} * m_0_{j} / m_0_0)"
    numbers = range(1, k + 1)
    moving = ", ".join(f"{centred(i, i)} > 1e-12 * {at(i, i)} AS v_{i}" for i in numbers)

    def entry(i: int, j: int) -> str:
        known = f"{centred(i, j)} / sqrt({centred(i, i)} * {centred(j, j)})"
        if i == j:
            return f"CASE WHEN v_{i} THEN 1.0001::DOUBLE ELSE 1 END"
        return f"CASE WHEN v_{i} AND v_{j} THEN {known} ELSE 0 END"

    def label(i: int) -> str:
        return f"CASE WHEN v_{i} THEN {centred(i, k + 1)} / sqrt({centred(i, i)}) ELSE 0 END"

    matrix = ", ".join("[" + ", ".join([*[entry(i, j) for j in numbers], label(i)]) + "]" for i in numbers)
    scale = ", ".join(f"CASE WHEN v_{i} THEN sqrt({centred(i, i)}) ELSE 1 END" for i in numbers)
    means = ", ".join(f"m_0_{i} / m_0_0" for i in numbers)
    predicted = " + ".join(
        f"a[{i}][{k + 1}] / scale[{i}] * ({shifted[i - 1]} - means[{i}])" for i in numbers
    )
    return f"""
moments AS (
  SELECT store_id, item_id, {sums} FROM split WHERE NOT is_val GROUP BY store_id, item_id),
marked AS (SELECT *, {moving} FROM moments),
elimination(store_id, item_id, level, means, scale, step, a) AS (
  SELECT store_id, item_id, m_0_{k + 1} / m_0_0, [{means}], [{scale}], 1, [{matrix}] FROM marked
  UNION ALL
  SELECT store_id, item_id, level, means, scale, step + 1,
         list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 2}), lambda j:
           CASE WHEN i = step THEN a[step][j] / a[step][step]
                ELSE a[i][j] - a[i][step] * a[step][j] / a[step][step] END))
  FROM elimination WHERE step <= {k}),
backtest AS (
  SELECT s.store_id, s.item_id, day_num, cal_date, CAST(sales AS DOUBLE) AS sales, n_rows - 28 AS n_train,
         train_mean AS weight, level + {predicted} AS predicted
  FROM (SELECT *, avg(sales) FILTER (WHERE NOT is_val) OVER (PARTITION BY store_id, item_id) AS train_mean
        FROM split) s
  JOIN elimination e ON s.store_id = e.store_id AND s.item_id = e.item_id AND step = {k + 1}
  WHERE is_val)"""


_TO_LINEAR = _TO_SPLIT.replace("WITH ", "WITH RECURSIVE ", 1) + "," + _linear_models()
_LINEAR_SERIES = f"""{_TO_LINEAR}, {_SERIES_SCORES}
            SELECT store_id, item_id, round(mae, 3) AS mae, round(rmse, 3) AS rmse,
                   round(weight, 6) AS weight, n_train, n_val FROM series"""
_LINEAR_DAYS = f"""{_TO_LINEAR}
            SELECT store_id, item_id, day_num, cal_date, sales, n_train, round(weight, 6) AS weight,
                   true AS scored, round(predicted, 3) + 0.0::DOUBLE AS predicted FROM backtest"""


def all_oracles() -> dict[str, str]:
    return {
        "calendar_read": f"{_TO_CALENDAR} SELECT {_CALENDAR_LIST} FROM calendar",
        "filter_store": f"""{_TO_DEMAND}
            SELECT item_id, store_id, cal_date, sales, day_num FROM demand WHERE store_id = 'ASIA'""",
        "wide_to_long": f"{_TO_FACT} SELECT {_IDS}, d, sales FROM fact",
        "day_number": f"{_TO_FACT} SELECT id, d, day_num FROM fact",
        "join_calendar": f"""{_with(_SPAN, _DEMAND, _CALENDAR)}
            SELECT x.store_id, x.item_id, c.d, x.sales, c.cal_date, c.wday, c.month, c.year,
                   c.event_name_1, c.event_type_1
            FROM demand x LEFT JOIN calendar c ON x.day_num = c.day_num""",
        "etl_pipeline": f"""{_TO_FACT}
            SELECT {_IDS}, d, sales, day_num, cal_date, wday, month, year, event_name_1, event_type_1
            FROM fact""",
        "first_days_sample": f"""{_TO_DEMAND}
            SELECT item_id || '_' || store_id AS id, item_id, split_part(item_id, '_', 1) AS dept_id,
                   store_id, split_part(item_id, '_', 1) AS cat_id, store_id AS state_id,
                   {', '.join(f'CAST(coalesce(sum(sales) FILTER (WHERE day_num = {k}), 0) AS INTEGER) AS d_{k}'
                              for k in range(1, 8))}
            FROM demand GROUP BY item_id, store_id""",
        "item_slice": f"""{_TO_FACT}
            SELECT day_num, sales FROM fact
            WHERE item_id = 'ECONOMY_17' AND store_id = 'ASIA' ORDER BY day_num""",
        "fact_columns": f"""{_TO_FACT}
            SELECT id, store_id, item_id, d, day_num, sales FROM fact ORDER BY id, day_num LIMIT 5""",
        "table_profile": f"{_TO_FACT} {_PROFILE}",
        "cast_losses": f"""{_TO_FACT},
            extra AS (SELECT count(DISTINCT (store_id, item_id)) AS n FROM fact),
            sales AS (
              SELECT count(*) AS days, count(*) FILTER (WHERE d = 'd_11' AND store_id = 'EUROPE') AS empty,
                     count(*) FILTER (WHERE d = 'd_5' AND dept_id = 'ECONOMY')
                     + count(*) FILTER (WHERE d = 'd_9' AND store_id = 'ASIA') AS bad FROM fact)
            SELECT 'sales' AS source, 'sales' AS column_name, days - empty + n AS raw_values, bad AS lost_values
            FROM sales, extra
            UNION ALL SELECT 'sales', 'day_num', days + n, n FROM sales, extra
            UNION ALL SELECT 'calendar', 'cal_date', count(*), count(*) FILTER (WHERE month = 2) FROM calendar
            UNION ALL SELECT 'calendar', 'wday', count(*), count(*) FILTER (WHERE wday = 1) FROM calendar
            UNION ALL SELECT 'calendar', 'month', count(*), 0 FROM calendar
            UNION ALL SELECT 'calendar', 'year', count(*) FILTER (WHERE month != 3), 0 FROM calendar""",
        "unique_violations": """
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "null_violations": _TO_FEATURES
        + "\nUNION ALL\n".join(
            f" SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM features"
            for c in FEATURE_COLUMNS
        ),
        "lag_features": f"""{_TO_DEMAND}
            SELECT store_id, item_id, day_num, sales,
                   CAST(lag(sales, 7) OVER s AS DOUBLE) AS sales_lag_7,
                   CAST(lag(sales, 14) OVER s AS DOUBLE) AS sales_lag_14,
                   CAST(lag(sales, 28) OVER s AS DOUBLE) AS sales_lag_28
            FROM demand WINDOW s AS (PARTITION BY store_id, item_id ORDER BY day_num)""",
        "rolling_features": f"""{_TO_DEMAND}
            SELECT store_id, item_id, day_num, sales,
              CASE WHEN count(sales) OVER w7 = 7 THEN round(avg(sales) OVER w7, 6) END AS sales_rolling_mean_7,
              CASE WHEN count(sales) OVER w28 = 28 THEN round(avg(sales) OVER w28, 6) END AS sales_rolling_mean_28,
              CASE WHEN count(sales) OVER w7 = 7 THEN round(stddev_samp(sales) OVER w7, 6) END AS sales_rolling_std_7,
              CASE WHEN count(sales) OVER w28 = 28 THEN round(stddev_samp(sales) OVER w28, 6) END AS sales_rolling_std_28
            FROM demand
            WINDOW w7 AS (PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
              w28 AS (PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
        "calendar_flags": f"""{_TO_FACT}
            SELECT id, d, wday, event_name_1, CASE WHEN wday IN (1, 2) THEN 1 ELSE 0 END AS is_weekend,
                   CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS has_event FROM fact""",
        "build_features": f"""{_TO_FEATURES}
            SELECT store_id, item_id, sales, {_REAL_FEATURE_LIST} FROM features""",
        "train_val_split": f"""{_TO_SPLIT}
            SELECT store_id, item_id, count(*) FILTER (WHERE NOT is_val) AS n_train,
                   count(*) FILTER (WHERE is_val) AS n_val,
                   min(day_num) FILTER (WHERE NOT is_val) AS train_first_day,
                   max(day_num) FILTER (WHERE NOT is_val) AS train_last_day,
                   min(day_num) FILTER (WHERE is_val) AS val_first_day,
                   max(day_num) FILTER (WHERE is_val) AS val_last_day,
                   round(avg(sales) FILTER (WHERE NOT is_val), 6) AS train_mean
            FROM split GROUP BY store_id, item_id""",
        "holdout_rows": f"""{_TO_SPLIT}
            SELECT store_id, item_id, cal_date, sales, {_FEATURE_LIST} FROM split WHERE is_val""",
        "per_series_backtest": _LINEAR_SERIES,
        "per_series_backtest_days": _LINEAR_DAYS,
        "moments_backtest": _LINEAR_SERIES,
        "moments_backtest_days": _LINEAR_DAYS,
        "gbt_backtest_days": _SCORED_DAYS,
        "tail_days": f"""{_TO_FACT}
            SELECT store_id, item_id, day_num, cal_date, sales FROM fact
            QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY day_num DESC) <= 180""",
        "baseline_forecast": f"""{_TO_BACKTEST}
            SELECT store_id, item_id, day_num, cal_date, sales, round(predicted, 6) AS predicted
            FROM backtest""",
        "baseline_error": f"""{_TO_BACKTEST}
            SELECT store_id, item_id, day_num AS "Day", sales AS "Actual",
                   round(predicted, 6) AS "Predicted", round(predicted - sales, 6) AS "Error"
            FROM backtest""",
        "series_metrics": f"""{_TO_BACKTEST}, {_SERIES_SCORES}
            SELECT store_id, item_id, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
                   round(weight, 6) AS weight, n_train, n_val FROM series""",
        "overall_metrics": f"""{_TO_BACKTEST}, {_SERIES_SCORES}
            SELECT round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse,
                   round(CASE WHEN sum(weight) > 0 THEN sum(mae * weight) / sum(weight)
                              ELSE avg(mae) END, 6) AS weighted_mae FROM series""",
        "run_summary": f"""{_TO_BACKTEST}
            SELECT count(DISTINCT item_id) AS num_items, count(*) AS num_rows FROM backtest""",
        "latest_run": f"{_TO_STORE} SELECT * FROM runs ORDER BY trained_at DESC, run_id DESC LIMIT 1",
        "active_run": f"""{_TO_STORE}
            SELECT model_version, trained_at, mae, rmse, weighted_mae, horizon_days, num_items, store_id
            FROM runs WHERE is_active ORDER BY trained_at DESC, run_id DESC LIMIT 1""",
        "runs_by_mae": f"""{_TO_STORE}
            SELECT run_id, model_version, trained_at, mae, rmse, horizon_days, num_items
            FROM runs ORDER BY mae NULLS FIRST, model_version""",
        "run_parameters": f"""{_TO_STORE}
            SELECT model_version, key AS parameter, json_extract_string(parameters, '$.' || key) AS value
            FROM (SELECT model_version, parameters, unnest(json_keys(parameters)) AS key FROM runs)""",
        "item_forecasts": f"""{_TO_STORE}
            SELECT item_id, store_id, forecast_date, round(predicted_sales, 6) AS predicted_sales, model_version
            FROM forecasts WHERE item_id = 'ECONOMY_17' AND store_id = 'ASIA'
            ORDER BY forecast_date, model_version""",
        "forecast_latest_per_date": f"""{_TO_STORE}
            , copies AS (
              SELECT *, 1 AS copy FROM forecasts WHERE model_version = 'v1.0'
              UNION ALL
              SELECT item_id, store_id, forecast_date, predicted_sales, 'v1.0', 2
              FROM forecasts WHERE model_version = 'v2.0')
            SELECT item_id, store_id, strftime(forecast_date, '%Y-%m-%d') AS date,
                   round(predicted_sales, 6) AS predicted_sales, model_version
            FROM copies WHERE model_version = (SELECT model_version FROM active)
            QUALIFY row_number() OVER (PARTITION BY item_id, store_id, forecast_date ORDER BY copy DESC) = 1""",
        "history_latest_per_date": f"""{_TO_STORE}
            , copies AS (
              SELECT *, 1 AS copy FROM history WHERE model_version = 'v1.0'
              UNION ALL
              SELECT item_id, store_id, sale_date, actual_sales + 1, 'v1.0', 2
              FROM history WHERE model_version = 'v2.0')
            SELECT item_id, store_id, strftime(sale_date, '%Y-%m-%d') AS date, actual_sales
            FROM copies WHERE model_version = (SELECT model_version FROM active)
            QUALIFY row_number() OVER (PARTITION BY item_id, store_id, sale_date ORDER BY copy DESC) = 1""",
        "forecast_summary": f"""{_TO_STORE}
            SELECT item_id, store_id, count(*) AS forecast_days,
                   round(avg(predicted_sales), 6) AS avg_predicted_sales,
                   min(forecast_date) AS first_date, max(forecast_date) AS last_date
            FROM latest_forecasts GROUP BY item_id, store_id ORDER BY item_id, store_id""",
        "version_compare": f"""{_TO_STORE}
            SELECT f.item_id, f.store_id, f.model_version, m.mae AS model_mae, m.rmse AS model_rmse,
                   round(avg(f.predicted_sales), 6) AS avg_prediction, count(*) AS num_forecasts
            FROM forecasts f JOIN runs m ON f.model_version = m.model_version
            GROUP BY f.item_id, f.store_id, f.model_version, m.mae, m.rmse, m.trained_at""",
        "top_items": f"""{_TO_STORE}
            SELECT item_id, round(sum(predicted_sales), 6) AS total_predicted_sales
            FROM latest_forecasts GROUP BY item_id
            ORDER BY sum(predicted_sales) DESC, item_id LIMIT 10""",
        "dept_rollup": f"""{_TO_STORE}
            SELECT f.store_id, split_part(f.item_id, '_', 1) AS dept,
                   count(DISTINCT f.item_id) AS item_count,
                   round(avg(f.predicted_sales), 6) AS avg_daily_forecast,
                   round(avg(abs(f.predicted_sales - h.actual_sales)), 6) AS dept_mae
            FROM active_forecasts f LEFT JOIN active_history h
              ON f.item_id = h.item_id AND f.store_id = h.store_id AND f.forecast_date = h.sale_date
            GROUP BY 1, 2""",
        "fact_dept_summary": f"""{_TO_FACT}
            SELECT split_part(item_id, '_', 1) AS dept, round(avg(sales), 6) AS avg_daily_forecast,
                   count(DISTINCT item_id) AS item_count FROM fact GROUP BY 1""",
        "items_by_name": f"""{_TO_STORE}
            SELECT DISTINCT store_id, item_id FROM active_forecasts ORDER BY store_id, item_id""",
        "items_by_volume": f"""{_TO_STORE}
            SELECT f.store_id, f.item_id, round(coalesce(h.avg_sales, 0), 6) AS avg_sales
            FROM (SELECT DISTINCT store_id, item_id FROM active_forecasts) f
            LEFT JOIN (SELECT store_id, item_id, avg(actual_sales) AS avg_sales
                       FROM active_history GROUP BY 1, 2) h
              ON f.store_id = h.store_id AND f.item_id = h.item_id""",
        "dept_items_by_volume": f"""{_TO_STORE}
            SELECT f.store_id, f.item_id, round(coalesce(h.avg_sales, 0), 6) AS avg_sales
            FROM (SELECT DISTINCT store_id, item_id FROM active_forecasts) f
            LEFT JOIN (SELECT store_id, item_id, avg(actual_sales) AS avg_sales
                       FROM active_history GROUP BY 1, 2) h
              ON f.store_id = h.store_id AND f.item_id = h.item_id
            WHERE f.store_id = 'ASIA' AND split_part(f.item_id, '_', 1) = 'ECONOMY'""",
        "avg_sales_by_item": f"""{_TO_STORE}
            SELECT store_id, item_id, round(avg(actual_sales), 6) AS avg_sales
            FROM active_history GROUP BY store_id, item_id""",
        "actual_vs_predicted": f"""{_TO_STORE}
            SELECT h.item_id, h.store_id, strftime(h.sale_date, '%Y-%m-%d') AS date, h.actual_sales,
                   round(f.predicted_sales, 6) AS predicted_sales
            FROM active_history h JOIN active_forecasts f
              ON f.item_id = h.item_id AND f.store_id = h.store_id AND f.forecast_date = h.sale_date""",
        "item_tiles": f"""{_TO_STORE}
            SELECT h.item_id, h.store_id, round(avg(abs(h.actual_sales - f.predicted_sales)), 6) AS mae,
                   round(sqrt(avg((h.actual_sales - f.predicted_sales)
                                  * (h.actual_sales - f.predicted_sales))), 6) AS rmse,
                   round(avg(h.actual_sales), 6) AS avg_actual_sales
            FROM active_history h LEFT JOIN active_forecasts f
              ON f.item_id = h.item_id AND f.store_id = h.store_id AND f.forecast_date = h.sale_date
            GROUP BY h.item_id, h.store_id""",
        "forecast_tiles": f"""{_TO_STORE}
            SELECT item_id, store_id, round(avg(predicted_sales), 6) AS avg_predicted_sales,
                   count(*) AS forecast_days FROM active_forecasts GROUP BY item_id, store_id""",
        "daily_tiles": f"""{_TO_BACKTEST}, {_SERIES_SCORES}
            SELECT f.store_id, f.item_id, round(avg(f.sales), 6) AS avg_daily_sales,
                   count(*) AS total_days, round(max(s.mae), 6) AS mae, round(max(s.rmse), 6) AS rmse
            FROM fact f LEFT JOIN series s ON f.store_id = s.store_id AND f.item_id = s.item_id
            GROUP BY f.store_id, f.item_id""",
        "delete_version": f"""{_TO_STORE}
            SELECT item_id, store_id, forecast_date, round(predicted_sales, 6) AS predicted_sales,
                   model_version FROM forecasts WHERE model_version IS DISTINCT FROM 'v1.0'""",
        "promote_version": f"""{_TO_STORE}
            SELECT run_id, model_version, model_version = 'v2.0' AS is_active FROM runs""",
        "append_run": f"""{_TO_STORE}
            SELECT run_id, model_version, horizon_days, num_items, store_id, parameters, is_active FROM runs
            UNION ALL
            SELECT CAST(3 AS BIGINT),
                   (SELECT 'v' || strftime(max(CAST(trained_at AS TIMESTAMP)) + INTERVAL 1 MONTH, '%Y-%m-%d') FROM runs),
                   CAST(28 AS INTEGER),
                   (SELECT CAST(count(DISTINCT item_id) AS INTEGER) FROM active_forecasts), 'ALL',
                   '{{"maxDepth": 5}}', false""",
        "store_replace_version": f"""{_TO_STORE}
            SELECT r.model_version, r.horizon_days, r.num_items, r.is_active,
                   f.n AS forecast_rows, f.n AS forecast_ids, h.n AS history_rows, h.n AS history_ids
            FROM runs r
            JOIN (SELECT model_version, count(*) AS n FROM forecasts GROUP BY 1) f
              ON r.model_version = f.model_version
            JOIN (SELECT model_version, count(*) AS n FROM history GROUP BY 1) h
              ON r.model_version = h.model_version""",
        "checkpoint_roundtrip": f"""{_TO_STORE}
            SELECT mae, rmse, weighted_mae,
                   (SELECT count(*) FROM latest_forecasts) AS forecast_rows,
                   (SELECT count(*) FROM history WHERE model_version = 'v2.0') AS history_rows,
                   (SELECT round(sum(predicted_sales), 6) FROM latest_forecasts) AS total_predicted,
                   (SELECT round(sum(actual_sales), 6) FROM history
                    WHERE model_version = 'v2.0') AS total_actual
            FROM runs WHERE model_version = 'v2.0'""",
    }
