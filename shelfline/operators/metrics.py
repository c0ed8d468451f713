"""Accuracy per series and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import mean_absolute_error, root_mean_squared_error
from shelfline.schemas import SERIES


def series_metrics(backtest: DataFrame) -> DataFrame:
    """MAE, RMSE, weight and row counts of every series.

    ``backtest`` holds the holdout rows of a model fitted on a split, which
    carry ``n_train`` and ``train_mean``.
    """
    return backtest.groupBy(*SERIES).agg(
        mean_absolute_error("sales", "predicted").alias("mae"),
        root_mean_squared_error("sales", "predicted").alias("rmse"),
        F.max("train_mean").alias("weight"),
        F.max("n_train").alias("n_train"),
        F.count(F.lit(1)).alias("n_val"),
    )


def baseline_metrics(backtest: DataFrame, fact: DataFrame) -> DataFrame:
    """:func:`series_metrics` for a baseline, whose training rows are all earlier ones.

    Training totals are series totals minus holdout totals, so the fact is
    aggregated once with map-side combine and never ranked as a whole.
    """
    holdout = backtest.groupBy(*SERIES).agg(
        mean_absolute_error("sales", "predicted").alias("mae"),
        root_mean_squared_error("sales", "predicted").alias("rmse"),
        F.count(F.lit(1)).alias("n_val"),
        F.count("sales").alias("_val_known"),
        F.coalesce(F.sum("sales"), F.lit(0)).alias("_val_sales"),
    )
    totals = fact.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("sales").alias("_known"),
        F.coalesce(F.sum("sales"), F.lit(0)).alias("_sales"),
    )
    known = F.col("_known") - F.col("_val_known")
    weight = F.when(known > 0, (F.col("_sales") - F.col("_val_sales")) / known)
    return holdout.join(totals, SERIES).select(
        *SERIES,
        "mae",
        "rmse",
        weight.alias("weight"),
        (F.col("_rows") - F.col("n_val")).alias("n_train"),
        "n_val",
    )


def overall_metrics(per_series: DataFrame) -> DataFrame:
    """One row: mean of series scores and the volume-weighted MAE.

    RMSE is the mean of per-series RMSEs, not pooled. With no volume at all the
    weighted score falls back to the plain mean.
    """
    weight = F.sum("weight")
    weighted = F.sum(F.col("mae") * F.col("weight")) / weight
    return per_series.agg(
        F.avg("mae").alias("mae"),
        F.avg("rmse").alias("rmse"),
        F.when(weight > 0, weighted).otherwise(F.avg("mae")).alias("weighted_mae"),
    )


def run_summary(forecasts: DataFrame) -> DataFrame:
    """Items forecast and rows produced."""
    return forecasts.agg(
        F.countDistinct("item_id").alias("num_items"),
        F.count(F.lit(1)).alias("num_rows"),
    )
