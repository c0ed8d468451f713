"""One model per series, fitted where the series lives."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from shelfline.schemas import FEATURE_COLUMNS, SERIES

# Ship this module's functions inside the task, so that workers need no copy of
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# learner(x_train, y_train, x_val, y_val) -> predictions for x_val
Learner = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]

BACKTEST_SCHEMA = (
    "store_id string, item_id string, day_num int, cal_date date, sales double, "
    "predicted double, n_train long, train_mean double"
)


def least_squares(
    x_train: np.ndarray, y_train: np.ndarray, x_val: np.ndarray, y_val: np.ndarray
) -> np.ndarray:
    """Linear regression with intercept (minimum-norm when columns are collinear)."""
    center = x_train.mean(axis=0)
    coef, *_ = np.linalg.lstsq(x_train - center, y_train - y_train.mean(), rcond=None)
    return y_train.mean() + (x_val - center) @ coef


# Share of a feature's variance that is added to it, to make solutions unique.
PENALTY = 1e-4


def standardised(
    products: np.ndarray, with_label: np.ndarray, raw_squares: np.ndarray, penalty: float = PENALTY
) -> np.ndarray:
    """Slopes from centred sums of products; a feature without variance gets none.

    ``raw_squares`` are the sums of squares before centring, which tell what is rounding.
    """
    variance = np.diagonal(products)
    moving = variance > 1e-12 * raw_squares
    scale = np.sqrt(variance[moving])
    shared = products[np.ix_(moving, moving)] / np.outer(scale, scale)
    slopes = np.zeros(len(variance))
    if moving.any():
        solved = np.linalg.solve(shared + penalty * np.eye(len(scale)), with_label[moving] / scale)
        slopes[moving] = solved / scale
    return slopes


def ridge(
    x_train: np.ndarray, y_train: np.ndarray, x_val: np.ndarray, y_val: np.ndarray
) -> np.ndarray:
    """Linear regression on standardised features with a small penalty on each."""
    center = x_train.mean(axis=0)
    x, y = x_train - center, y_train - y_train.mean()
    slopes = standardised(x.T @ x, x.T @ y, (x_train * x_train).sum(axis=0))
    return y_train.mean() + (x_val - center) @ slopes


def backtest_per_series(
    split: DataFrame,
    learner: Learner = least_squares,
    features: Sequence[str] = FEATURE_COLUMNS,
) -> DataFrame:
    """Fit on each series' training rows and predict its holdout rows.

    The grouping key is the split's own window key, so the plan reuses its
    partitioning. A group is one series, i.e. at most one row per day of the
    calendar; ``quality.require_unique`` on (series, day) guards that bound.
    Rows without a label cannot be learned from or scored and are left out.
    """
    names = list(features)
    extra = [c for c in ("day_num", "cal_date", "sales", "is_val", "n_train", "train_mean")]
    columns = [*SERIES, *extra, *[c for c in names if c not in extra]]

    def fit_predict(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("day_num")
        is_val = rows["is_val"].to_numpy(dtype=bool)
        x = rows[names].to_numpy(dtype=float)
        y = rows["sales"].to_numpy(dtype=float)
        held = rows.loc[is_val, [*SERIES, "day_num", "cal_date", "sales"]].copy()
        if is_val.all() or not is_val.any():
            held["predicted"] = np.nan
            held = held.iloc[:0]
        else:
            held["predicted"] = learner(x[~is_val], y[~is_val], x[is_val], y[is_val])
        held["n_train"] = rows["n_train"].iloc[0]
        held["train_mean"] = rows["train_mean"].iloc[0]
        return held

    return (
        split.select(*columns)
        .dropna(subset=["sales"])
        .groupBy(*SERIES)
        .applyInPandas(fit_predict, BACKTEST_SCHEMA)
    )
