"""Moving-average baseline with optional trend, backtested on the holdout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import non_negative
from shelfline.operators.split import check_horizon
from shelfline.schemas import DEFAULT_HORIZON, SERIES

# Length of the recent mean and of the span the trend looks back on.
RECENT_DAYS = 28
TREND_DAYS = 56


def baseline_backtest(
    fact: DataFrame, horizon: int = DEFAULT_HORIZON, trend: bool = True
) -> DataFrame:
    """Predict the last ``horizon`` rows of every series from the rows before them.

    ``max(0, recent + slope * i)`` for holdout step ``i`` = 0, 1, ...: ``recent``
    is the mean of the last 28 training rows, ``slope`` its daily change against
    the first 28 of the last 56. Only ``horizon + 56`` rows per series can matter,
    so a rank filter (planned as a map-side group limit) drops the rest before
    the shuffle; the means are then window aggregates over the same partitioning
    and need no join back.
    """
    check_horizon(horizon)
    newest_first = Window.partitionBy(*SERIES).orderBy(F.col("day_num").desc())
    series = Window.partitionBy(*SERIES)
    kept = (
        fact.select(*SERIES, "day_num", "cal_date", "sales")
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= horizon + TREND_DAYS)
        .withColumn("_train_kept", F.count(F.lit(1)).over(series) - horizon)
        .where(F.col("_train_kept") > 0)
    )
    age = F.col("_rank") - horizon  # 1 = newest training row
    in_recent = age.between(1, RECENT_DAYS)
    span = F.col("_train_kept")  # min(56, training rows)
    in_earlier = (age >= 1) & (age > span - RECENT_DAYS) & (age <= span)
    levels = kept.withColumns(
        {
            "_recent": F.avg(F.when(in_recent, F.col("sales"))).over(series),
            "_earlier": F.avg(F.when(in_earlier, F.col("sales"))).over(series),
        }
    )
    step = F.lit(horizon) - F.col("_rank")
    slope = (F.col("_recent") - F.col("_earlier")) / F.lit(float(RECENT_DAYS))
    value = F.col("_recent") + slope * step if trend else F.col("_recent")
    return levels.where(F.col("_rank") <= horizon).select(
        *SERIES, "day_num", "cal_date", "sales", non_negative(value).alias("predicted")
    )


def forecast_errors(backtest: DataFrame) -> DataFrame:
    """Presentation form: day, actual, predicted and signed error."""
    return (
        backtest.withColumn("Error", F.col("predicted") - F.col("sales"))
        .withColumnsRenamed({"day_num": "Day", "sales": "Actual", "predicted": "Predicted"})
        .select(*SERIES, "Day", "Actual", "Predicted", "Error")
    )


def to_forecasts(backtest: DataFrame) -> DataFrame:
    """Holdout predictions in the forecast table's column names."""
    return backtest.select(
        "item_id",
        "store_id",
        F.col("cal_date").alias("forecast_date"),
        F.col("predicted").cast("double").alias("predicted_sales"),
    )


def to_history(backtest: DataFrame) -> DataFrame:
    """Holdout actuals in the history table's column names."""
    return backtest.select(
        "item_id",
        "store_id",
        F.col("cal_date").alias("sale_date"),
        F.col("sales").cast("double").alias("actual_sales"),
    )
