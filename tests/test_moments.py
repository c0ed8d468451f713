import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import random_series, to_spark
from shelfline.models.moments import add_moments, backtest_moments, predict, series_moments, solve
from shelfline.models.per_series import backtest_per_series, ridge
from shelfline.operators.features import build_features
from shelfline.operators.split import holdout_split
from shelfline.schemas import SERIES

KEYS = [*SERIES, "day_num"]


@pytest.fixture(scope="module")
def split(spark):
    lengths = {("A_1", "S1"): 150, ("A_1", "S2"): 100, ("B_2", "S1"): 57, ("C_3", "S1"): 40}
    return holdout_split(build_features(to_spark(spark, random_series(8, lengths))))


def by_key(df):
    return df.toPandas().sort_values(KEYS, ignore_index=True)


def test_equals_fits_of_the_rows(split):
    got, want = by_key(backtest_moments(split)), by_key(backtest_per_series(split, ridge))
    assert len(got) == 3 * 28
    np.testing.assert_allclose(got["predicted"], want["predicted"], atol=1e-7)
    pd.testing.assert_frame_equal(got.drop(columns="predicted"), want.drop(columns="predicted"), check_dtype=False)


def test_new_days_are_added_without_the_old_ones(spark, split):
    """Moments of two stretches of days make the model of all of them."""
    early, late = (split.where(c) for c in ("day_num <= 60", "day_num > 60"))
    both = add_moments(series_moments(early), series_moments(late))
    whole = series_moments(split)
    a, b = (df.toPandas().sort_values(SERIES, ignore_index=True) for df in (both, whole))
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-12)
    held = split.where("is_val")
    one, two = (by_key(predict(held, solve(m))) for m in (both, whole))
    np.testing.assert_allclose(one["predicted"], two["predicted"], atol=1e-9)


def test_one_exchange_for_features_and_moments(split, plan_of):
    plan = plan_of(series_moments(split))
    assert plan.count("Exchange hashpartitioning") == 1 and "ArrowEvalPython" not in plan


def test_series_without_variance_keep_their_level(spark):
    pdf = random_series(3, {("A_1", "S"): 90})
    pdf["sales"] = 4
    out = backtest_moments(holdout_split(build_features(to_spark(spark, pdf)))).toPandas()
    assert len(out) == 28 and out["predicted"].to_numpy() == pytest.approx(np.full(28, 4.0))


def test_collinear_features_have_one_solution(spark):
    """Lone sales make the 7-day mean and deviation proportional."""
    pdf = random_series(3, {("A_1", "S"): 160})
    pdf["sales"] = [5 if k % 29 == 0 else 0 for k in range(160)]
    rows = holdout_split(build_features(to_spark(spark, pdf)))
    got, want = by_key(backtest_moments(rows)), by_key(backtest_per_series(rows, ridge))
    assert got["predicted"].abs().max() < 20
    np.testing.assert_allclose(got["predicted"], want["predicted"], atol=1e-7)


def test_unknown_labels_and_empty_input(spark, split):
    pdf = random_series(2, {("A_1", "S"): 120})
    pdf["sales"] = pdf["sales"].astype(object)
    pdf.loc[[40, 118], "sales"] = None
    out = backtest_moments(holdout_split(build_features(to_spark(spark, pdf)))).toPandas()
    assert len(out) == 27 and out["predicted"].notna().all()
    assert backtest_moments(split.where(F.lit(False))).isEmpty()
