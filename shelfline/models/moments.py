"""Linear models of all series from sums of products, kept and added to.

One aggregation with map-side combine gives every series the sums of products of its
features and label. They are all a fit needs: each series becomes one row of numbers,
solved where it lies, and new days are learned by adding their sums to the stored ones,
without a look at the old days.

Features are standardised and a small penalty is put on each, so that the solution is
unique where features are collinear (windows that never hold two sales make a mean and
a deviation proportional).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.models.per_series import PENALTY, standardised
from shelfline.schemas import FEATURE_COLUMNS, SERIES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Taken off before products are summed. Any values give the same model; these keep the
# sums of the features that are far from zero small, and so precise.
ORIGIN = {"day_num": 1_000.0, "year": 2_000.0}


def _terms(features: Sequence[str]) -> list[Column]:
    """One, the features and the label, as doubles."""
    shifted = [F.col(c).cast("double") - F.lit(ORIGIN.get(c, 0.0)) for c in features]
    return [F.lit(1.0), *shifted, F.col("sales").cast("double")]


def _names(features: Sequence[str]) -> list[tuple[int, int]]:
    size = len(features) + 2
    return [(i, j) for i in range(size) for j in range(i, size)]


def series_moments(split: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Sums of products over the training rows with a label: ``m_0_0`` counts them."""
    terms = _terms(features)
    known = split.where("NOT is_val").dropna(subset=["sales", *features])
    return known.groupBy(*SERIES).agg(
        *[F.sum(terms[i] * terms[j]).alias(f"m_{i}_{j}") for i, j in _names(features)]
    )


def add_moments(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Moments of both sets of days; they must not hold the same day."""
    sums = [c for c in stored.columns if c not in SERIES]
    return stored.unionByName(new).groupBy(*SERIES).agg(*[F.sum(c).alias(c) for c in sums])


def solve(moments: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, penalty: float = PENALTY) -> DataFrame:
    """Per series: ``level``, and for each feature its ``centre`` and ``slope``."""
    size, pairs = len(features) + 2, _names(features)
    origin = np.array([ORIGIN.get(c, 0.0) for c in features])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sums = np.zeros((len(rows), size, size))
            for i, j in pairs:
                sums[:, i, j] = sums[:, j, i] = rows[f"m_{i}_{j}"]
            n = sums[:, 0, 0]
            means = sums[:, 0, 1:] / n[:, None]
            spread = sums[:, 1:, 1:] - n[:, None, None] * means[:, :, None] * means[:, None, :]
            slopes = [standardised(s[:-1, :-1], s[:-1, -1], np.diagonal(m)[1:-1], penalty) for s, m in zip(spread, sums, strict=True)]
            out = rows[SERIES].copy()
            out["level"] = means[:, -1]
            out["centre"] = list(means[:, :-1] + origin)
            out["slope"] = slopes
            yield out

    layout = "store_id string, item_id string, level double, centre array<double>, slope array<double>"
    return moments.mapInPandas(fitted, layout)


def predict(rows: DataFrame, models: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """``rows`` with ``predicted``; rows of series without a model are left out."""
    total = F.col("level")
    for k, c in enumerate(features):
        total = total + F.col("slope")[k] * (F.col(c).cast("double") - F.col("centre")[k])
    joined = rows.join(models, SERIES)
    return joined.withColumn("predicted", total).drop("level", "centre", "slope")


def backtest_moments(split: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, penalty: float = PENALTY) -> DataFrame:
    """Fit on the training rows of each series and predict its holdout rows."""
    held = split.where("is_val").dropna(subset=["sales"])
    models = solve(series_moments(split, features), features, penalty)
    return predict(held, models, features).select(
        *SERIES,
        "day_num",
        "cal_date",
        F.col("sales").cast("double").alias("sales"),
        "predicted",
        "n_train",
        "train_mean",
    )
