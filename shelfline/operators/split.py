"""Chronological holdout of every series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.features import series_window
from shelfline.schemas import DEFAULT_HORIZON, FEATURE_COLUMNS, SERIES


def check_horizon(horizon: int) -> None:
    if horizon < 1:
        raise ValueError("horizon must be at least 1")


def holdout_split(
    features: DataFrame,
    horizon: int = DEFAULT_HORIZON,
    columns: Sequence[str] = FEATURE_COLUMNS,
) -> DataFrame:
    """Drop incomplete rows, then mark the last ``horizon`` rows of each series.

    Adds ``is_val``, ``n_train`` and ``train_mean`` (mean training sales, the
    volume weight of the series). Series without a row on both sides are left
    out. Position and count use the features' own window order, so no second
    exchange or sort is planned.
    """
    check_horizon(horizon)
    ordered = series_window()
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = features.dropna(subset=list(columns)).withColumns(
        {
            "_pos": F.row_number().over(ordered),
            "n_train": F.count(F.lit(1)).over(whole) - horizon,
        }
    )
    is_val = F.col("_pos") > F.col("n_train")
    return (
        placed.where(F.col("n_train") > 0)
        .withColumn("is_val", is_val)
        .withColumn("train_mean", F.avg(F.when(~F.col("is_val"), F.col("sales"))).over(whole))
        .drop("_pos")
    )


def tail_days(fact: DataFrame, n: int = 180) -> DataFrame:
    """Last ``n`` rows of every series.

    The rank filter is planned as a group limit, which keeps ``n`` rows per
    series on the map side before anything is shuffled.
    """
    newest_first = Window.partitionBy(*SERIES).orderBy(F.col("day_num").desc())
    return (
        fact.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )
