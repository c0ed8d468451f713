import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from frames import random_series, to_spark
from shelfline.models.per_series import backtest_per_series, least_squares
from shelfline.models import pooled
from shelfline.models.pooled import backtest_pooled, best_round, bin_edges, fit_pooled, score_pooled
from shelfline.operators.features import build_features
from shelfline.operators.metrics import series_metrics
from shelfline.operators.split import holdout_split
from shelfline.schemas import FEATURE_COLUMNS, SERIES


@pytest.fixture(scope="module")
def split(spark):
    lengths = {("A_1", "S1"): 150, ("A_1", "S2"): 100, ("B_2", "S1"): 57, ("C_3", "S1"): 40}
    return holdout_split(build_features(to_spark(spark, random_series(8, lengths))))


def test_per_series_equals_separate_fits(split):
    got = backtest_per_series(split).toPandas().set_index([*SERIES, "day_num"])
    assert len(got) == 3 * 28  # the fourth series is too short
    for key, part in split.toPandas().groupby(SERIES):
        part = part.sort_values("day_num")
        train, held = part[~part["is_val"]], part[part["is_val"]]
        x = np.c_[np.ones(len(part)), part[FEATURE_COLUMNS].to_numpy(float)]
        mask = part["is_val"].to_numpy()
        if len(train) > 20:
            coef, *_ = np.linalg.lstsq(x[~mask], train["sales"].to_numpy(float), rcond=None)
            np.testing.assert_allclose(
                got.loc[key]["predicted"].loc[held["day_num"]], x[mask] @ coef, atol=1e-6
            )
        assert (got.loc[key]["n_train"] == len(train)).all()


def test_learner_is_pluggable(split):
    def mean(x_train, y_train, x_val, y_val):
        return np.full(len(x_val), y_train.mean())

    out = backtest_per_series(split, mean).toPandas()
    assert out["predicted"].to_numpy() == pytest.approx(out["train_mean"].to_numpy())
    assert set(series_metrics(backtest_per_series(split, mean)).columns) == {
        *SERIES, "mae", "rmse", "weight", "n_train", "n_val",
    }


def test_per_series_reuses_the_window_partitioning(split, plan_of):
    assert plan_of(backtest_per_series(split)).count("Exchange hashpartitioning") == 1


def test_least_squares_recovers_a_line():
    x = np.arange(20.0).reshape(-1, 1)
    pred = least_squares(x[:15], 3 + 2 * x[:15, 0], x[15:], np.zeros(5))
    np.testing.assert_allclose(pred, 3 + 2 * x[15:, 0])


def test_learners_do_not_need_the_package_on_workers(tmp_path):
    (tmp_path / "learner.pickle").write_bytes(cloudpickle.dumps(least_squares))
    code = "import pickle; print(callable(pickle.load(open('learner.pickle', 'rb'))))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert done.stdout.strip() == "True", done.stderr


def test_unknown_labels_are_left_out(spark):
    pdf = random_series(2, {("A_1", "S"): 120})
    pdf["sales"] = pdf["sales"].astype(object)
    pdf.loc[118, "sales"] = None  # last but one holdout day
    rows = holdout_split(build_features(to_spark(spark, pdf)))
    assert rows.where("is_val").count() == 28
    out = backtest_per_series(rows).toPandas()
    assert len(out) == 27 and out["predicted"].notna().all()


def test_stop_rule():
    falling = [1.0 / (i + 1) for i in range(30)]
    assert best_round(falling, 20) == (30, False)
    assert best_round([3.0, 1.0, *[2.0] * 20], 20) == (2, True)
    assert best_round([3.0, 1.0, *[2.0] * 19], 20) == (2, False)
    assert best_round([3.0, 1.0, *[2.0] * 19, 0.5], 20) == (22, False)
    assert best_round([1.0, *[1.0] * 20], 20) == (1, True)  # an equal error is no gain


def boosted_anew(split, model, rounds, **params):
    """Spark's own boosting over all rows, on the same bins."""
    rows = model.assembled(model.binned(split.dropna(subset=["sales"])))
    rows = rows.withColumn("label", F.col("sales").cast("double"))
    fitted = GBTRegressor(featuresCol="_bins", maxIter=rounds, seed=7, **params).fit(rows.where("NOT is_val"))
    return fitted.transform(rows.where("is_val"))


@pytest.mark.parametrize("rounds", [1, 2, 13])
def test_staged_boosting_equals_a_full_refit(split, rounds):
    """Grown tree by tree over grouped cases, across several written states."""
    params = {"maxDepth": 3, "stepSize": 0.2}
    model = fit_pooled(split, params={**params, "maxIter": rounds}, patience=99)
    kept = model.num_trees
    mine = model.score(split.where("is_val").dropna(subset=["sales"]))
    keys = [*SERIES, "day_num"]
    got = mine.select(*keys, "prediction").toPandas().sort_values(keys)["prediction"]
    want = boosted_anew(split, model, kept, **params).select(*keys, "prediction").toPandas()
    assert len(got) == 3 * 28
    np.testing.assert_allclose(got, want.sort_values(keys)["prediction"], rtol=1e-9)


def test_the_round_with_the_least_absolute_error_is_kept(split):
    params = {"maxIter": 12, "maxDepth": 2, "stepSize": 0.3}
    model = fit_pooled(split, params=params, patience=3)
    rows = score_pooled(model, split).toPandas()
    kept = (rows["sales"] - rows["predicted"]).abs().mean()
    assert kept == pytest.approx(min(model.errors)) == pytest.approx(model.errors[model.num_trees - 1])
    assert len(model.errors) <= min(12, model.num_trees + 3)
    longer = fit_pooled(split, params=params, patience=99)
    np.testing.assert_allclose(longer.errors[: len(model.errors)], model.errors)


def test_no_tree_is_grown_twice_or_past_the_stop(split, monkeypatch):
    grown = []
    fit = DecisionTreeRegressor.fit
    monkeypatch.setattr(pooled.DecisionTreeRegressor, "fit", lambda self, rows: grown.append(1) or fit(self, rows))
    model = fit_pooled(split, params={"maxIter": 200, "maxDepth": 2, "stepSize": 0.9}, patience=2)
    assert len(grown) == len(model.errors) == model.num_trees + 2


def test_equal_bins_are_one_case(split):
    train = split.where("NOT is_val").dropna(subset=["sales"]).withColumn("label", F.col("sales").cast("double"))
    features = ["wday", "is_weekend", "sales_lag_7"]
    model = pooled.PooledModel(features, bin_edges(train, features), [], [])
    made = pooled.cases(train, model).toPandas()
    pdf = train.select(*features, "label").toPandas()
    assert made["weight"].sum() == len(pdf) and len(made) < len(pdf)
    assert (made["weight"] * made["label"]).sum() == pytest.approx(pdf["label"].sum())
    assert pdf["wday"].nunique() == len(model.edges[0]) + 1  # few values: one bin each


def test_bins_leave_room_for_rare_values(spark):
    rows = spark.range(10_000).selectExpr("if(id % 50 = 0, id / 50.0, 0.0) AS x", "7 AS same", "id AS wide")
    zero, same, wide = bin_edges(rows, ["x", "same", "wide"])
    assert 25 <= len(zero) <= 31 and zero[0] > 0 and same == [] and 25 <= len(wide) <= 31


def test_pooled_settings_are_checked(split):
    with pytest.raises(ValueError, match="squared"):
        fit_pooled(split, params={"lossType": "absolute"})
    with pytest.raises(ValueError, match="maxIter"):
        fit_pooled(split, params={"maxIter": 0})


def test_pooled_trees(split):
    params = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.3}
    first = backtest_pooled(split, params=params).toPandas()
    again = backtest_pooled(split, params=params).toPandas()
    assert len(first) == 3 * 28 and first["predicted"].notna().all()
    keys = [*SERIES, "day_num"]
    pd.testing.assert_frame_equal(
        first.sort_values(keys, ignore_index=True), again.sort_values(keys, ignore_index=True)
    )
