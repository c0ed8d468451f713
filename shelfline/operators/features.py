"""Leakage-free time-series features as window expressions.

Every feature shares one window specification, so a feature frame costs one
exchange (none on a table bucketed by item) and one sort. A series is at most
one row per day, which bounds what a window partition can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfline.functions import event_flag, weekend_flag
from shelfline.schemas import DEFAULT_LAGS, DEFAULT_WINDOWS, SERIES


def series_window() -> WindowSpec:
    return Window.partitionBy(*SERIES).orderBy("day_num")


def lag_columns(lags: Sequence[int] = DEFAULT_LAGS) -> dict[str, Column]:
    w = series_window()
    return {f"sales_lag_{n}": F.lag("sales", n).over(w) for n in lags}


def _sliding_columns(windows: Sequence[int]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        frame = series_window().rowsBetween(-n, -1)
        full = F.count("sales").over(frame) == n
        out[f"sales_rolling_mean_{n}"] = F.when(full, F.avg("sales").over(frame))
        out[f"sales_rolling_std_{n}"] = F.when(full, F.stddev_samp("sales").over(frame))
    return out


def calendar_columns() -> dict[str, Column]:
    return {"is_weekend": weekend_flag("wday"), "has_event": event_flag("event_name_1")}


def add_lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS) -> DataFrame:
    return df.withColumns(lag_columns(lags))


def _add_rolling(
    df: DataFrame, windows: Sequence[int], others: dict[str, Column]
) -> DataFrame:
    """Mean and sample deviation of the ``n`` rows before the current one.

    NULL until ``n`` non-null values are available. Frames slide, so sales of any
    numeric type and size are safe: no total grows with the length of a series.
    """
    return df.withColumns({**others, **_sliding_columns(windows)})


def add_rolling_features(df: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS) -> DataFrame:
    return _add_rolling(df, windows, {})


def add_calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns())


def build_features(
    df: DataFrame,
    lags: Sequence[int] = DEFAULT_LAGS,
    windows: Sequence[int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """All features over one exchange and one sort; existing columns are kept."""
    return _add_rolling(df, windows, {**lag_columns(lags), **calendar_columns()})
