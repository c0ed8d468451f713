"""Named queries over a directory of star-schema tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Averages are rounded to
six decimals so that results do not depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import version_tag
from shelfline.operators import features, forecast, metrics, quality, reshape, serving, split
from shelfline.plans.backtest import (
    checkpoint_backtest,
    read_forecast_checkpoint,
    read_history_checkpoint,
)
from shelfline.plans.dataset import ALL_STORES, FORECASTERS, V1, V2, DemandDataset, dataset
from shelfline.plans.etl import transform_sales_to_long
from shelfline.schemas import CALENDAR_COLUMNS, FEATURE_COLUMNS, ID_COLUMNS, SERIES
from shelfline.session import new_dir
from shelfline.sources.files import (
    read_calendar,
    read_daily_sales,
    read_metrics,
    read_sales_wide,
    write_parquet,
)
from shelfline.store import ForecastStore, append_run, delete_version, promote_version
from shelfline.store.tables import run_row

# The values asked for by the lookups of one item, store or department.
ITEM, STORE, DEPT = "ECONOMY_17", "ASIA", "ECONOMY"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def _register(build: Callable[[DemandDataset], DataFrame]) -> Callable[[DemandDataset], DataFrame]:
    """Add a query under its function's name; a trailing underscore is dropped."""
    name = build.__name__.rstrip("_")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(dataset(spark, sf_dir))

    run.__name__ = name
    run.__doc__ = build.__doc__
    _queries[name] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _real_lags(df: DataFrame) -> DataFrame:
    """Lags as doubles, like the other features with missing values."""
    lags = [c for c in df.columns if c.startswith("sales_lag_")]
    return df.withColumns({c: F.col(c).cast("double") for c in lags})


def _stamped(runs: DataFrame) -> DataFrame:
    """Training time as text, independent of the client's time zone."""
    return runs.withColumn("trained_at", F.date_format("trained_at", "yyyy-MM-dd HH:mm:ss"))


# -- sources and reshaping ---------------------------------------------------------


@_register
def calendar_read(d: DemandDataset) -> DataFrame:
    return read_calendar(d.spark, d.calendar_path)


@_register
def filter_store(d: DemandDataset) -> DataFrame:
    return reshape.filter_by_store(d.demand, STORE)


@_register
def wide_to_long(d: DemandDataset) -> DataFrame:
    return reshape.wide_to_long(read_sales_wide(d.spark, d.raw_path))


@_register
def day_number(d: DemandDataset) -> DataFrame:
    long = reshape.wide_to_long(read_sales_wide(d.spark, d.raw_path))
    return reshape.add_day_number(long).select("id", "d", "day_num")


@_register
def join_calendar(d: DemandDataset) -> DataFrame:
    long = d.demand.select(*SERIES, F.concat(F.lit("d_"), "day_num").alias("d"), "sales")
    return reshape.join_calendar(long, read_calendar(d.spark, d.calendar_path))


@_register
def etl_pipeline(d: DemandDataset) -> DataFrame:
    """CSV in, curated Parquet out, read back from its partitions."""
    path = new_dir(d.spark, "curated")
    long = transform_sales_to_long(
        d.spark, d.raw_path, calendar_path=d.calendar_path, file_rows=reshape.FILE_ROWS
    )
    write_parquet(long, path, ["store_id"], rebalance=False)
    return read_daily_sales(d.spark, path)


@_register
def first_days_sample(d: DemandDataset) -> DataFrame:
    path = new_dir(d.spark, "sales_small")
    write_parquet(reshape.first_days(read_sales_wide(d.spark, d.raw_path)), path)
    return d.spark.read.parquet(path)


@_register
def item_slice(d: DemandDataset) -> DataFrame:
    return reshape.item_slice(d.fact, ITEM, STORE)


@_register
def fact_columns(d: DemandDataset) -> DataFrame:
    return reshape.peek(d.fact)


# -- quality -----------------------------------------------------------------------


@_register
def table_profile(d: DemandDataset) -> DataFrame:
    columns = [*ID_COLUMNS, "d", "sales", "day_num", *[c for c in CALENDAR_COLUMNS if c != "d"]]
    return quality.table_profile(d.fact, columns, distinct=columns)


@_register
def cast_losses(d: DemandDataset) -> DataFrame:
    """Values that the ETL's casts lose from files with damaged cells, counted as it writes."""
    losses = quality.CastLosses()
    long = transform_sales_to_long(
        d.spark, d.damaged_path, calendar_path=d.damaged_path, file_rows=reshape.FILE_ROWS, losses=losses
    )
    write_parquet(long, new_dir(d.spark, "curated"), ["store_id"], rebalance=False)
    return losses.report(d.spark)


@_register
def unique_violations(d: DemandDataset) -> DataFrame:
    lines = d.spark.read.parquet(f"{d.sf_dir}/lineitem.parquet")
    return quality.unique_violations(lines, ["l_orderkey", "l_linenumber"])


@_register
def null_violations(d: DemandDataset) -> DataFrame:
    return quality.null_violations(features.build_features(d.fact), FEATURE_COLUMNS)


# -- features ----------------------------------------------------------------------


@_register
def lag_features(d: DemandDataset) -> DataFrame:
    """Lags count rows, here days with sales."""
    return _real_lags(features.add_lag_features(d.demand.select(*SERIES, "day_num", "sales")))


@_register
def rolling_features(d: DemandDataset) -> DataFrame:
    out = features.add_rolling_features(d.demand.select(*SERIES, "day_num", "sales"))
    return _rounded(out, *[c for c in FEATURE_COLUMNS if "rolling" in c])


@_register
def calendar_flags(d: DemandDataset) -> DataFrame:
    flagged = features.add_calendar_features(d.fact)
    return flagged.select("id", "d", "wday", "event_name_1", "is_weekend", "has_event")


@_register
def build_features(d: DemandDataset) -> DataFrame:
    out = features.build_features(d.fact).select(*SERIES, "sales", *FEATURE_COLUMNS)
    return _real_lags(_rounded(out, *[c for c in FEATURE_COLUMNS if "rolling" in c]))


def _split(d: DemandDataset) -> DataFrame:
    return split.holdout_split(features.build_features(d.fact))


@_register
def train_val_split(d: DemandDataset) -> DataFrame:
    """Extent of both sides of every series' split."""
    day, held = F.col("day_num"), F.col("is_val")
    return (
        _split(d)
        .groupBy(*SERIES)
        .agg(
            F.count_if(~held).alias("n_train"),
            F.count_if(held).alias("n_val"),
            F.min(F.when(~held, day)).alias("train_first_day"),
            F.max(F.when(~held, day)).alias("train_last_day"),
            F.min(F.when(held, day)).alias("val_first_day"),
            F.max(F.when(held, day)).alias("val_last_day"),
            F.round(F.max("train_mean"), 6).alias("train_mean"),
        )
    )


@_register
def holdout_rows(d: DemandDataset) -> DataFrame:
    held = _split(d).where("is_val").select(*SERIES, "cal_date", "sales", *FEATURE_COLUMNS)
    return _rounded(held, *[c for c in FEATURE_COLUMNS if "rolling" in c])


@_register
def tail_days(d: DemandDataset) -> DataFrame:
    return split.tail_days(d.fact.select(*SERIES, "day_num", "cal_date", "sales"))


# -- baseline forecast and metrics ---------------------------------------------------


@_register
def baseline_forecast(d: DemandDataset) -> DataFrame:
    return _rounded(forecast.baseline_backtest(d.fact), "predicted")


@_register
def baseline_error(d: DemandDataset) -> DataFrame:
    errors = forecast.forecast_errors(forecast.baseline_backtest(d.fact))
    return _rounded(errors, "Predicted", "Error")


def _baseline_scores(d: DemandDataset) -> DataFrame:
    return metrics.baseline_metrics(forecast.baseline_backtest(d.fact), d.fact)


@_register
def series_metrics(d: DemandDataset) -> DataFrame:
    return _rounded(_baseline_scores(d), "mae", "rmse", "weight")


@_register
def overall_metrics(d: DemandDataset) -> DataFrame:
    return _rounded(
        metrics.overall_metrics(_baseline_scores(d)), "mae", "rmse", "weighted_mae"
    )


@_register
def run_summary(d: DemandDataset) -> DataFrame:
    return metrics.run_summary(forecast.to_forecasts(forecast.baseline_backtest(d.fact)))


# -- model runs ----------------------------------------------------------------------


@_register
def latest_run(d: DemandDataset) -> DataFrame:
    run = _stamped(serving.latest_run(d.store.model_runs()))
    return _rounded(run, "mae", "rmse", "weighted_mae")


@_register
def active_run(d: DemandDataset) -> DataFrame:
    run = _stamped(serving.model_status(d.store.model_runs()))
    return _rounded(run, "mae", "rmse", "weighted_mae")


@_register
def runs_by_mae(d: DemandDataset) -> DataFrame:
    return _rounded(_stamped(serving.runs_by_mae(d.store.model_runs())), "mae", "rmse")


@_register
def run_parameters(d: DemandDataset) -> DataFrame:
    return serving.run_parameters(d.store.model_runs())


# -- serving -------------------------------------------------------------------------


@_register
def item_forecasts(d: DemandDataset) -> DataFrame:
    rows = serving.item_forecasts(d.store.forecasts(), ITEM, STORE)
    return _rounded(rows, "predicted_sales")


def _with_rerun(first: DataFrame, second: DataFrame, version: str) -> DataFrame:
    """``first`` followed by a later copy of the same keys under the same version."""
    offset = first.agg(F.max("id")).scalar()
    again = second.withColumns(
        {"id": F.col("id") + offset + 1, "model_version": F.lit(version)}
    )
    return first.unionByName(again)


@_register
def forecast_latest_per_date(d: DemandDataset) -> DataFrame:
    """Two copies per key: the first run of v1.0 and its re-run with the trend."""
    forecasts = d.store.forecasts()
    copies = _with_rerun(
        forecasts.where(F.col("model_version") == V1),
        forecasts.where(F.col("model_version") == V2),
        V1,
    )
    return _rounded(serving.latest_forecasts(copies, d.store.model_runs()), "predicted_sales")


@_register
def history_latest_per_date(d: DemandDataset) -> DataFrame:
    """Two copies per key: the actuals of v1.0 and their correction by one unit."""
    history = d.store.sales_history()
    corrected = history.where(F.col("model_version") == V2).withColumn(
        "actual_sales", F.col("actual_sales") + 1
    )
    copies = _with_rerun(history.where(F.col("model_version") == V1), corrected, V1)
    return serving.latest_history(copies, d.store.model_runs())


@_register
def forecast_summary(d: DemandDataset) -> DataFrame:
    summary = serving.forecast_summary(d.store.forecasts(), d.store.model_runs())
    return _rounded(summary, "avg_predicted_sales")


@_register
def version_compare(d: DemandDataset) -> DataFrame:
    rows = serving.version_compare(d.store.forecasts(), d.store.model_runs())
    return _rounded(rows, "model_mae", "model_rmse", "avg_prediction")


@_register
def top_items(d: DemandDataset) -> DataFrame:
    rows = serving.top_items(d.store.forecasts(), d.store.model_runs())
    return _rounded(rows, "total_predicted_sales")


@_register
def dept_rollup(d: DemandDataset) -> DataFrame:
    rows = serving.dept_rollup(
        d.store.forecasts(), d.store.sales_history(), d.store.model_runs()
    )
    return _rounded(rows, "avg_daily_forecast", "dept_mae")


@_register
def fact_dept_summary(d: DemandDataset) -> DataFrame:
    return _rounded(serving.fact_dept_summary(d.fact), "avg_daily_forecast")


@_register
def items_by_name(d: DemandDataset) -> DataFrame:
    return serving.items_by_name(d.store.forecasts(), d.store.model_runs())


@_register
def items_by_volume(d: DemandDataset) -> DataFrame:
    rows = serving.items_by_volume(
        d.store.forecasts(), d.store.sales_history(), d.store.model_runs()
    )
    return _rounded(rows, "avg_sales")


@_register
def dept_items_by_volume(d: DemandDataset) -> DataFrame:
    rows = serving.items_by_volume(
        d.store.forecasts(), d.store.sales_history(), d.store.model_runs(), STORE, DEPT
    )
    return _rounded(rows, "avg_sales")


@_register
def avg_sales_by_item(d: DemandDataset) -> DataFrame:
    rows = serving.avg_sales_by_item(d.store.sales_history(), d.store.model_runs())
    return _rounded(rows, "avg_sales")


@_register
def actual_vs_predicted(d: DemandDataset) -> DataFrame:
    rows = serving.actual_vs_predicted(
        d.store.forecasts(), d.store.sales_history(), d.store.model_runs()
    )
    return _rounded(rows, "predicted_sales")


@_register
def item_tiles(d: DemandDataset) -> DataFrame:
    rows = serving.item_tiles(
        d.store.forecasts(), d.store.sales_history(), d.store.model_runs()
    )
    return _rounded(rows, "mae", "rmse", "avg_actual_sales")


@_register
def forecast_tiles(d: DemandDataset) -> DataFrame:
    rows = serving.forecast_tiles(d.store.forecasts(), d.store.model_runs())
    return _rounded(rows, "avg_predicted_sales")


@_register
def daily_tiles(d: DemandDataset) -> DataFrame:
    rows = serving.daily_tiles(d.fact, forecast.baseline_backtest(d.fact))
    return _rounded(rows, "avg_daily_sales", "mae", "rmse")


# -- store maintenance -----------------------------------------------------------------


@_register
def delete_version_(d: DemandDataset) -> DataFrame:
    left = delete_version(d.store.forecasts(), V1)
    return _rounded(left.drop("id", "created_at"), "predicted_sales")


@_register
def promote_version_(d: DemandDataset) -> DataFrame:
    runs = promote_version(d.store.model_runs(), V2)
    return runs.select("run_id", "model_version", "is_active")


@_register
def append_run_(d: DemandDataset) -> DataFrame:
    """The store's runs plus one logged from a summary of its latest forecasts.

    The new run is a scheduled one: its version is named after the day it was triggered,
    here a month after the newest run.
    """
    runs = d.store.model_runs()
    items = serving.items_by_name(d.store.forecasts(), runs).select("item_id").distinct().count()
    trigger = runs.agg(F.add_months(F.max("trained_at"), 1).cast("timestamp").alias("at"))
    version = trigger.select(version_tag("at")).first()[0]
    new = run_row(d.spark, version, None, None, None, 28, items, ALL_STORES, {"maxDepth": 5})
    return append_run(runs, new).drop("trained_at", "mae", "rmse", "weighted_mae")


@_register
def store_replace_version(d: DemandDataset) -> DataFrame:
    """Publish both versions to a fresh store, the first one twice."""
    store = ForecastStore(d.spark, new_dir(d.spark, "store"))
    for version in (V1, V2, V1):
        d.publish(store, version)
    by_version = [
        table.groupBy("model_version").agg(
            F.count(F.lit(1)).alias(f"{name}_rows"),
            F.countDistinct("id").alias(f"{name}_ids"),
        )
        for name, table in (
            ("forecast", store.forecasts()),
            ("history", store.sales_history()),
        )
    ]
    runs = store.model_runs().select("model_version", "horizon_days", "num_items", "is_active")
    return runs.join(by_version[0], "model_version").join(by_version[1], "model_version")


@_register
def checkpoint_roundtrip(d: DemandDataset) -> DataFrame:
    """Scores and totals as read back from one version's checkpoints."""
    root = new_dir(d.spark, "checkpoints")
    paths = checkpoint_backtest(d.spark, d.fact, FORECASTERS[V2], V2, root)
    predicted = read_forecast_checkpoint(d.spark, paths.forecasts)
    actual = read_history_checkpoint(d.spark, paths.history)
    scores = read_metrics(d.spark, paths.metrics).withColumns(
        {
            "forecast_rows": predicted.agg(F.count(F.lit(1))).scalar(),
            "history_rows": actual.agg(F.count(F.lit(1))).scalar(),
            "total_predicted": predicted.agg(F.sum("predicted_sales")).scalar(),
            "total_actual": actual.agg(F.sum("actual_sales")).scalar(),
        }
    )
    return _rounded(scores, "mae", "rmse", "weighted_mae", "total_predicted", "total_actual")


# -- learned models ----------------------------------------------------------------------


def _scored_days(rows: DataFrame) -> DataFrame:
    """What follows from the split alone: days, actuals, counts, weights."""
    scored = F.col("predicted").isNotNull().alias("scored")
    weight = F.round("train_mean", 6).alias("weight")
    return rows.select(*SERIES, "day_num", "cal_date", "sales", "n_train", weight, scored)


def _to_thousandths(df: DataFrame, *columns: str) -> DataFrame:
    """Results of solvers, which agree to about nine digits; adding 0 turns -0 into 0."""
    return df.withColumns({c: F.round(c, 3) + F.lit(0.0) for c in columns})


def _series_scores(rows: DataFrame) -> DataFrame:
    return _rounded(_to_thousandths(metrics.series_metrics(rows), "mae", "rmse"), "weight")


def _predicted_days(rows: DataFrame) -> DataFrame:
    weight = F.round("train_mean", 6).alias("weight")
    days = _to_thousandths(rows, "predicted")
    scored = F.col("predicted").isNotNull().alias("scored")
    return days.select(*SERIES, "day_num", "cal_date", "sales", "n_train", weight, scored, "predicted")


@_register
def per_series_backtest(d: DemandDataset) -> DataFrame:
    return _series_scores(d.per_series_rows)


@_register
def per_series_backtest_days(d: DemandDataset) -> DataFrame:
    """Every holdout day's prediction by the model of its series, fitted in its group."""
    return _predicted_days(d.per_series_rows)


@_register
def moments_backtest(d: DemandDataset) -> DataFrame:
    return _series_scores(d.moment_rows)


@_register
def moments_backtest_days(d: DemandDataset) -> DataFrame:
    """The same predictions from sums of products."""
    return _predicted_days(d.moment_rows)


@_register
def gbt_backtest(d: DemandDataset) -> DataFrame:
    return _rounded(metrics.series_metrics(d.pooled_rows), "mae", "rmse", "weight")


@_register
def gbt_backtest_days(d: DemandDataset) -> DataFrame:
    return _scored_days(d.pooled_rows)
