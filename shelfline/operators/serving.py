"""Questions asked of the prediction store.

Every operator takes the store's DataFrames and returns one. ``item_id``,
``store_id`` and ``dept`` are optional lookups; without them the answer covers
all items. A missing item or run yields an empty frame with the full schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import (
    department,
    mean_absolute_error,
    root_mean_squared_error,
)
from shelfline.schemas import SERIES

# -- model runs -------------------------------------------------------------------


def latest_run(runs: DataFrame) -> DataFrame:
    """Most recently trained run (ties: the later run id)."""
    return runs.orderBy(F.desc("trained_at"), F.desc("run_id")).limit(1)


def active_run(runs: DataFrame) -> DataFrame:
    """Most recently trained run among the active ones."""
    return latest_run(runs.where("is_active"))


def model_status(runs: DataFrame) -> DataFrame:
    return active_run(runs).select(
        "model_version",
        "trained_at",
        "mae",
        "rmse",
        "weighted_mae",
        "horizon_days",
        "num_items",
        "store_id",
    )


def runs_by_mae(runs: DataFrame) -> DataFrame:
    """All runs, best first; runs without a score lead."""
    return runs.select(
        "run_id", "model_version", "trained_at", "mae", "rmse", "horizon_days", "num_items"
    ).orderBy(F.asc_nulls_first("mae"), "model_version")


def run_parameters(runs: DataFrame) -> DataFrame:
    """Logged hyperparameters, one row per run and parameter."""
    as_map = F.from_json("parameters", T.MapType(T.StringType(), T.StringType()))
    return runs.select("model_version", F.explode(as_map).alias("parameter", "value"))


def _of_run(rows: DataFrame, run: DataFrame) -> DataFrame:
    """Rows of one run's version.

    ``run`` is one row by its own ``limit(1)``, which is what bounds this
    broadcast; the join then prunes the version partitions at run time.
    """
    return rows.join(F.broadcast(run.select("model_version")), "model_version")


def _lookup(
    rows: DataFrame,
    item_id: str | None = None,
    store_id: str | None = None,
    dept: str | None = None,
) -> DataFrame:
    if item_id is not None:
        rows = rows.where(F.col("item_id") == item_id)
    if store_id is not None:
        rows = rows.where(F.col("store_id") == store_id)
    if dept is not None:
        rows = rows.where(department("item_id") == dept)
    return rows


# -- forecasts and history ----------------------------------------------------------


def item_forecasts(forecasts: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """Forecasts of one series under every version, by date."""
    return (
        _lookup(forecasts, item_id, store_id)
        .select("item_id", "store_id", "forecast_date", "predicted_sales", "model_version")
        .orderBy("forecast_date", "model_version")
    )


def _latest_by_date(rows: DataFrame, run: DataFrame, day: str, value: str) -> DataFrame:
    """``value`` of the highest id per series and date under one run.

    The rank filter is planned as a group limit of 1 on both sides of the
    exchange, so repeated copies of a key are dropped before the shuffle. The
    date stays a date: joins on (item, store, date) reuse the partitioning.
    """
    newest = Window.partitionBy("item_id", "store_id", "date").orderBy(F.desc("id"))
    return (
        _of_run(rows.withColumnRenamed(day, "date"), run)
        .withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .select("item_id", "store_id", "date", value, "model_version")
    )


def _date_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def latest_forecasts(
    forecasts: DataFrame,
    runs: DataFrame,
    item_id: str | None = None,
    store_id: str | None = None,
) -> DataFrame:
    """Active version's forecast per series and date; the last written copy wins."""
    rows = _lookup(forecasts, item_id, store_id)
    return _date_text(
        _latest_by_date(rows, active_run(runs), "forecast_date", "predicted_sales")
    )


def latest_history(
    history: DataFrame,
    runs: DataFrame,
    item_id: str | None = None,
    store_id: str | None = None,
) -> DataFrame:
    """Active version's actuals per series and date; the last written copy wins."""
    rows = _lookup(history, item_id, store_id)
    return _date_text(
        _latest_by_date(rows, active_run(runs), "sale_date", "actual_sales")
    ).drop("model_version")


def _matched(
    forecasts: DataFrame, history: DataFrame, runs: DataFrame, how: str
) -> DataFrame:
    active = active_run(runs)
    predicted = _latest_by_date(forecasts, active, "forecast_date", "predicted_sales")
    actual = _latest_by_date(history, active, "sale_date", "actual_sales")
    return actual.drop("model_version").join(
        predicted.drop("model_version"), ["item_id", "store_id", "date"], how
    )


def forecast_summary(forecasts: DataFrame, runs: DataFrame) -> DataFrame:
    """Per series under the latest run: forecast days, mean prediction, date range."""
    return (
        _of_run(forecasts, latest_run(runs))
        .groupBy("item_id", "store_id")
        .agg(
            F.count(F.lit(1)).alias("forecast_days"),
            F.avg("predicted_sales").alias("avg_predicted_sales"),
            F.min("forecast_date").alias("first_date"),
            F.max("forecast_date").alias("last_date"),
        )
        .orderBy("item_id", "store_id")
    )


def version_compare(
    forecasts: DataFrame,
    runs: DataFrame,
    item_id: str | None = None,
    store_id: str | None = None,
) -> DataFrame:
    """Mean prediction of each version beside its run scores, newest run first.

    Forecasts are aggregated before the join, so it sees one row per series and
    version.
    """
    by_version = (
        _lookup(forecasts, item_id, store_id)
        .groupBy("item_id", "store_id", "model_version")
        .agg(
            F.avg("predicted_sales").alias("avg_prediction"),
            F.count(F.lit(1)).alias("num_forecasts"),
        )
    )
    scores = runs.select(
        "model_version",
        F.col("mae").alias("model_mae"),
        F.col("rmse").alias("model_rmse"),
        "trained_at",
    )
    return (
        by_version.join(scores, "model_version")
        .orderBy("item_id", "store_id", F.desc("trained_at"))
        .select(
            "item_id",
            "store_id",
            "model_version",
            "model_mae",
            "model_rmse",
            "avg_prediction",
            "num_forecasts",
        )
    )


def top_items(forecasts: DataFrame, runs: DataFrame, n: int = 10) -> DataFrame:
    """Items with the highest total predicted demand under the latest run."""
    return (
        _of_run(forecasts, latest_run(runs))
        .groupBy("item_id")
        .agg(F.sum("predicted_sales").alias("total_predicted_sales"))
        .orderBy(F.desc("total_predicted_sales"), "item_id")
        .limit(n)
    )


def dept_rollup(
    forecasts: DataFrame, history: DataFrame, runs: DataFrame, store_id: str | None = None
) -> DataFrame:
    """Per store and department: items, mean daily forecast and MAE of the active run.

    Days without an actual count in the mean forecast but not in the MAE.
    """
    active = active_run(runs)
    predicted = _of_run(_lookup(forecasts, store_id=store_id), active).withColumnRenamed(
        "forecast_date", "date"
    )
    actual = _of_run(_lookup(history, store_id=store_id), active).select(
        "item_id", "store_id", F.col("sale_date").alias("date"), "actual_sales"
    )
    return (
        predicted.join(actual, ["item_id", "store_id", "date"], "left")
        .groupBy("store_id", department("item_id").alias("dept"))
        .agg(
            F.countDistinct("item_id").alias("item_count"),
            F.avg("predicted_sales").alias("avg_daily_forecast"),
            mean_absolute_error("actual_sales", "predicted_sales").alias("dept_mae"),
        )
        .orderBy("store_id", F.desc("avg_daily_forecast"), "dept")
    )


# -- item lists ----------------------------------------------------------------------


def _items(
    forecasts: DataFrame, runs: DataFrame, store_id: str | None, dept: str | None
) -> DataFrame:
    rows = _lookup(forecasts, store_id=store_id, dept=dept)
    return _of_run(rows, active_run(runs)).select(*SERIES).distinct()


def items_by_name(
    forecasts: DataFrame,
    runs: DataFrame,
    store_id: str | None = None,
    dept: str | None = None,
) -> DataFrame:
    return _items(forecasts, runs, store_id, dept).orderBy("store_id", "item_id")


def avg_sales_by_item(
    history: DataFrame,
    runs: DataFrame,
    store_id: str | None = None,
    dept: str | None = None,
) -> DataFrame:
    rows = _lookup(history, store_id=store_id, dept=dept)
    return (
        _of_run(rows, active_run(runs))
        .groupBy(*SERIES)
        .agg(F.avg("actual_sales").alias("avg_sales"))
    )


def items_by_volume(
    forecasts: DataFrame,
    history: DataFrame,
    runs: DataFrame,
    store_id: str | None = None,
    dept: str | None = None,
) -> DataFrame:
    """Items of the active run by mean actual sales; items without actuals count as 0."""
    volume = avg_sales_by_item(history, runs, store_id, dept)
    return (
        _items(forecasts, runs, store_id, dept)
        .join(volume, SERIES, "left")
        .select(*SERIES, F.coalesce("avg_sales", F.lit(0.0)).alias("avg_sales"))
        .orderBy("store_id", F.desc("avg_sales"), "item_id")
    )


# -- dashboard aggregates ------------------------------------------------------------


def actual_vs_predicted(forecasts: DataFrame, history: DataFrame, runs: DataFrame) -> DataFrame:
    """Matched days of every series in the active run."""
    return _date_text(_matched(forecasts, history, runs, "inner"))


def item_tiles(forecasts: DataFrame, history: DataFrame, runs: DataFrame) -> DataFrame:
    """MAE and RMSE over matched days, mean actual sales over all of them.

    One left join serves all three: unmatched days have no error to average.
    """
    return (
        _matched(forecasts, history, runs, "left")
        .groupBy("item_id", "store_id")
        .agg(
            mean_absolute_error("actual_sales", "predicted_sales").alias("mae"),
            root_mean_squared_error("actual_sales", "predicted_sales").alias("rmse"),
            F.avg("actual_sales").alias("avg_actual_sales"),
        )
    )


def forecast_tiles(forecasts: DataFrame, runs: DataFrame) -> DataFrame:
    """Mean prediction and number of forecast days of every series."""
    return (
        latest_forecasts(forecasts, runs)
        .groupBy("item_id", "store_id")
        .agg(
            F.avg("predicted_sales").alias("avg_predicted_sales"),
            F.count(F.lit(1)).alias("forecast_days"),
        )
    )


def fact_dept_summary(fact: DataFrame) -> DataFrame:
    """Mean daily sales and number of items per department."""
    return (
        fact.groupBy(department("item_id").alias("dept"))
        .agg(
            F.avg("sales").alias("avg_daily_forecast"),
            F.countDistinct("item_id").alias("item_count"),
        )
        .orderBy(F.desc("avg_daily_forecast"), "dept")
    )


def daily_tiles(fact: DataFrame, backtest: DataFrame) -> DataFrame:
    """Mean daily sales and days of every series with its baseline MAE and RMSE.

    Series too short for a backtest have NULL scores.
    """
    volume = fact.groupBy(*SERIES).agg(
        F.avg("sales").alias("avg_daily_sales"), F.count(F.lit(1)).alias("total_days")
    )
    errors = backtest.groupBy(*SERIES).agg(
        mean_absolute_error("sales", "predicted").alias("mae"),
        root_mean_squared_error("sales", "predicted").alias("rmse"),
    )
    return volume.join(errors, SERIES, "left")
