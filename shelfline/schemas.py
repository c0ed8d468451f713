"""Column lists and table schemas shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the data model -------------------------------
ID_COLUMNS = ["id", "item_id", "dept_id", "store_id", "cat_id", "state_id"]
DAY_PREFIX = "d_"
CALENDAR_COLUMNS = ["d", "cal_date", "wday", "month", "year", "event_name_1", "event_type_1"]
FEATURE_COLUMNS = [
    "day_num",
    "wday",
    "month",
    "year",
    "is_weekend",
    "has_event",
    "sales_lag_7",
    "sales_lag_14",
    "sales_lag_28",
    "sales_rolling_mean_7",
    "sales_rolling_mean_28",
    "sales_rolling_std_7",
    "sales_rolling_std_28",
]
MODEL_INPUT_COLUMNS = ["item_id", "store_id", "day_num", "sales"]
DEFAULT_LAGS = (7, 14, 28)
DEFAULT_WINDOWS = (7, 28)
DEFAULT_HORIZON = 28
WEEKEND_WDAYS = (1, 2)
# -------------------------------------------------------------------------------

# A series is one item in one store. Store first: it is also the partition column
# of the fact, and every window and grouping below uses this order.
SERIES = ["store_id", "item_id"]

CALENDAR = T.StructType(
    [
        T.StructField("d", T.StringType()),
        T.StructField("cal_date", T.DateType()),
        T.StructField("wday", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
    ]
)

DAILY_SALES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ID_COLUMNS]
    + [
        T.StructField("d", T.StringType()),
        T.StructField("sales", T.IntegerType()),
        T.StructField("day_num", T.IntegerType()),
    ]
    + [f for f in CALENDAR.fields if f.name != "d"]
)

FORECASTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("forecast_date", T.DateType()),
        T.StructField("predicted_sales", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

SALES_HISTORY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("actual_sales", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

MODEL_RUNS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("trained_at", T.TimestampType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("weighted_mae", T.DoubleType()),
        T.StructField("horizon_days", T.IntegerType()),
        T.StructField("num_items", T.IntegerType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("parameters", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("weighted_mae", T.DoubleType()),
    ]
)

# Natural keys and required columns of the store tables.
UNIQUE_KEYS = {
    "forecasts": ["item_id", "store_id", "forecast_date", "model_version"],
    "sales_history": ["item_id", "store_id", "sale_date", "model_version"],
    "model_runs": ["model_version"],
}
NOT_NULL = {
    "forecasts": ["item_id", "store_id", "forecast_date", "predicted_sales", "model_version"],
    "sales_history": ["item_id", "store_id", "sale_date", "actual_sales", "model_version"],
    "model_runs": ["model_version", "horizon_days", "is_active"],
}
