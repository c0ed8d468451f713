"""Backtest run: train, checkpoint, replace the version, promote it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any, NamedTuple, Protocol

from pyspark.sql import DataFrame, SparkSession

from shelfline.models.moments import backtest_moments
from shelfline.models.per_series import Learner, backtest_per_series, least_squares
from shelfline.models.pooled import backtest_pooled
from shelfline.operators.features import build_features
from shelfline.operators.forecast import baseline_backtest, to_forecasts, to_history
from shelfline.operators.metrics import (
    baseline_metrics,
    overall_metrics,
    run_summary,
    series_metrics,
)
from shelfline.operators.quality import require_columns, require_unique
from shelfline.operators.split import holdout_split
from shelfline.schemas import DEFAULT_HORIZON, FORECASTS, SALES_HISTORY, SERIES
from shelfline.sources.files import read_metrics, write_metrics
from shelfline.store import ForecastStore
from shelfline.store.tables import run_row


class Forecaster(Protocol):
    def backtest(self, fact: DataFrame, horizon: int) -> DataFrame:
        """Holdout rows of all series with ``sales`` and ``predicted``."""

    def scores(self, backtest: DataFrame, fact: DataFrame) -> DataFrame:
        """Metrics of every series."""


@dataclass(frozen=True)
class Baseline:
    """Recent mean, with or without its trend."""

    trend: bool = True

    def backtest(self, fact: DataFrame, horizon: int) -> DataFrame:
        return baseline_backtest(fact, horizon, self.trend)

    def scores(self, backtest: DataFrame, fact: DataFrame) -> DataFrame:
        return baseline_metrics(backtest, fact)


@dataclass(frozen=True)
class PerSeries:
    """One model per series."""

    learner: Learner = least_squares

    def backtest(self, fact: DataFrame, horizon: int) -> DataFrame:
        return backtest_per_series(holdout_split(build_features(fact), horizon), self.learner)

    def scores(self, backtest: DataFrame, fact: DataFrame) -> DataFrame:
        return series_metrics(backtest)


@dataclass(frozen=True)
class Moments:
    """One linear model per series, from sums of products."""

    def backtest(self, fact: DataFrame, horizon: int) -> DataFrame:
        return backtest_moments(holdout_split(build_features(fact), horizon))

    def scores(self, backtest: DataFrame, fact: DataFrame) -> DataFrame:
        return series_metrics(backtest)


@dataclass(frozen=True)
class Pooled:
    """One boosted-tree model for all series."""

    params: Mapping[str, Any] = field(default_factory=dict)

    def backtest(self, fact: DataFrame, horizon: int) -> DataFrame:
        split = holdout_split(build_features(fact), horizon)
        return backtest_pooled(split, params=self.params)

    def scores(self, backtest: DataFrame, fact: DataFrame) -> DataFrame:
        return series_metrics(backtest)


class Checkpoint(NamedTuple):
    forecasts: str
    history: str
    metrics: str


def checkpoint_paths(root: str, version: str) -> Checkpoint:
    return Checkpoint(
        f"{root}/forecasts_{version}", f"{root}/history_{version}", f"{root}/metrics_{version}"
    )


def checkpoint_backtest(
    spark: SparkSession,
    fact: DataFrame,
    forecaster: Forecaster,
    version: str,
    root: str,
    horizon: int = DEFAULT_HORIZON,
) -> Checkpoint:
    """Train and save forecasts, actuals and scores before any table is touched.

    The model runs once: its rows are written, and all three checkpoints are
    derived from that copy.
    """
    paths = checkpoint_paths(root, version)
    rows_path = f"{root}/backtest_{version}"
    forecaster.backtest(fact, horizon).write.mode("overwrite").parquet(rows_path)
    rows = spark.read.parquet(rows_path)
    to_forecasts(rows).write.mode("overwrite").parquet(paths.forecasts)
    to_history(rows).write.mode("overwrite").parquet(paths.history)
    write_metrics(overall_metrics(forecaster.scores(rows, fact)), paths.metrics)
    return paths


def _subset(schema, names):
    return type(schema)([f for f in schema.fields if f.name in names])


def read_forecast_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    names = ["item_id", "store_id", "forecast_date", "predicted_sales"]
    return spark.read.schema(_subset(FORECASTS, names)).parquet(path).select(*names)


def read_history_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    names = ["item_id", "store_id", "sale_date", "actual_sales"]
    return spark.read.schema(_subset(SALES_HISTORY, names)).parquet(path).select(*names)


def publish(
    spark: SparkSession,
    store: ForecastStore,
    version: str,
    paths: Checkpoint,
    store_id: str,
    horizon: int = DEFAULT_HORIZON,
    parameters: Mapping[str, Any] | None = None,
    trained_at: datetime | None = None,
) -> tuple[int, int]:
    """Replace ``version`` in the store from its checkpoints; safe to repeat.

    Forecasts, actuals and the run change together: whatever fails before the last
    step leaves the old version, if there was one, as it was. Returns the forecast and
    history rows written.
    """
    predictions = read_forecast_checkpoint(spark, paths.forecasts)
    history = read_history_checkpoint(spark, paths.history)
    scores = read_metrics(spark, paths.metrics).first()
    run = run_row(
        spark,
        version,
        scores["mae"],
        scores["rmse"],
        scores["weighted_mae"],
        horizon,
        run_summary(predictions).first()["num_items"],
        store_id,
        parameters,
        trained_at,
    )
    return store.replace_version(version, predictions, history, run)


def run_backtest(
    spark: SparkSession,
    fact: DataFrame,
    store: ForecastStore,
    forecaster: Forecaster,
    version: str,
    checkpoint_root: str,
    store_id: str,
    horizon: int = DEFAULT_HORIZON,
    parameters: Mapping[str, Any] | None = None,
    trained_at: datetime | None = None,
) -> tuple[int, int]:
    """Whole run over a curated daily fact.

    The key check also guarantees that a series is at most one row per day,
    which bounds every window partition and model group that follows.
    """
    require_columns(fact)
    require_unique(fact, [*SERIES, "day_num"])
    paths = checkpoint_backtest(spark, fact, forecaster, version, checkpoint_root, horizon)
    return publish(
        spark, store, version, paths, store_id, horizon, parameters, trained_at
    )
