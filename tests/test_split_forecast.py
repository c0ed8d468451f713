import numpy as np
import pandas as pd
import pytest

from frames import ramp, random_series, to_spark
from shelfline.operators.features import build_features
from shelfline.operators.forecast import baseline_backtest, forecast_errors
from shelfline.operators.metrics import baseline_metrics
from shelfline.operators.split import holdout_split, tail_days
from shelfline.schemas import FEATURE_COLUMNS, SERIES


def split_counts(spark, n, horizon):
    rows = holdout_split(build_features(to_spark(spark, ramp(n))), horizon)
    return {r.is_val: r["count"] for r in rows.groupBy("is_val").count().collect()}


def test_split_sides(spark):
    # 28 rows lack a full 28-day history
    assert split_counts(spark, 80, 28) == {True: 28, False: 24}
    assert split_counts(spark, 57, 28) == {True: 28, False: 1}


def test_series_without_training_rows_is_skipped(spark):
    assert split_counts(spark, 56, 28) == {}
    assert split_counts(spark, 35, 28) == {}
    assert split_counts(spark, 20, 28) == {}


@pytest.mark.parametrize("horizon", [0, -1])
def test_horizon_must_be_positive(spark, horizon):
    df = to_spark(spark, ramp())
    with pytest.raises(ValueError):
        holdout_split(build_features(df), horizon)
    with pytest.raises(ValueError):
        baseline_backtest(df, horizon)


def test_rows_are_dropped_after_features_are_built(spark):
    """A NULL calendar value removes its row but still feeds later lags."""
    pdf = ramp(60)
    pdf["wday"] = pdf["wday"].astype(object)
    pdf.loc[40, "wday"] = None
    out = holdout_split(build_features(to_spark(spark, pdf)), 5).toPandas().set_index("day_num")
    assert 41 not in out.index
    assert out.loc[48, "sales_lag_7"] == 41
    assert out["is_val"].sum() == 5
    assert out["train_mean"].nunique() == 1
    train = out[~out["is_val"]]
    assert out["train_mean"].iloc[0] == pytest.approx(train["sales"].mean())
    assert (out["n_train"] == len(train)).all()


def test_split_matches_pandas(spark):
    lengths = {("A_1", "S1"): 90, ("A_1", "S2"): 57, ("B_2", "S1"): 56, ("C_3", "S1"): 12}
    pdf = random_series(3, lengths, nulls=0.02)
    df = build_features(to_spark(spark, pdf))
    kept = df.toPandas().dropna(subset=FEATURE_COLUMNS).sort_values("day_num")
    want = set()
    for key, part in kept.groupby(SERIES):
        if len(part) > 28:
            want |= {(*key, d, True) for d in part["day_num"].iloc[-28:]}
            want |= {(*key, d, False) for d in part["day_num"].iloc[:-28]}
    got = holdout_split(df).select(*SERIES, "day_num", "is_val").collect()
    assert {tuple(r) for r in got} == want


def test_split_adds_no_exchange_or_sort(spark, plan_of):
    plan = plan_of(holdout_split(build_features(to_spark(spark, ramp()))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def brute_force_baseline(part: pd.DataFrame, horizon: int, trend: bool = True) -> pd.DataFrame:
    part = part.sort_values("day_num")
    train, held = part.iloc[:-horizon], part.iloc[-horizon:].copy()
    sales = pd.to_numeric(train["sales"])
    level = sales.tail(28).mean()
    slope = (level - sales.tail(56).head(28).mean()) / 28 if trend else 0.0
    held["predicted"] = [max(0.0, level + slope * i) for i in range(len(held))]
    return held


@pytest.mark.parametrize("trend", [True, False])
@pytest.mark.parametrize("horizon", [7, 28])
def test_baseline_equals_brute_force(spark, horizon, trend):
    lengths = {(f"I_{n}", "S"): n for n in (8, 9, 29, 30, 40, 56, 57, 70, 84, 85, 200)}
    pdf = random_series(11, lengths)
    got = baseline_backtest(to_spark(spark, pdf), horizon, trend).toPandas()
    got = got.set_index(["item_id", "day_num"])["predicted"]
    want = pd.concat(
        brute_force_baseline(p, horizon, trend)
        for _, p in pdf.groupby("item_id")
        if len(p) > horizon
    ).set_index(["item_id", "day_num"])["predicted"]
    assert len(got) == len(want)
    np.testing.assert_allclose(got.loc[want.index], want, rtol=1e-12)


def test_baseline_never_negative(spark):
    pdf = ramp(90)
    pdf["sales"] = [max(0.0, 60.0 - k) for k in range(90)]
    out = baseline_backtest(to_spark(spark, pdf)).toPandas()
    assert (out["predicted"] >= 0).all() and (out["predicted"] == 0).any()


def test_baseline_prunes_before_the_shuffle(spark, plan_of):
    plan = plan_of(baseline_backtest(to_spark(spark, ramp())))
    assert "row_number(), 84, Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_baseline_metrics(spark):
    pdf = random_series(4, {("A_1", "S"): 100, ("B_1", "S"): 60})
    df = to_spark(spark, pdf)
    got = baseline_metrics(baseline_backtest(df), df).toPandas().set_index("item_id")
    for item, part in pdf.groupby("item_id"):
        held = brute_force_baseline(part, 28)
        e = held["sales"].astype(float) - held["predicted"]
        train = part.sort_values("day_num").iloc[:-28]["sales"].astype(float)
        assert got.loc[item, "mae"] == pytest.approx(e.abs().mean())
        assert got.loc[item, "rmse"] == pytest.approx(np.sqrt((e**2).mean()))
        assert got.loc[item, "weight"] == pytest.approx(train.mean())
        assert (got.loc[item, "n_train"], got.loc[item, "n_val"]) == (len(train), 28)


def test_error_table(spark):
    errors = forecast_errors(baseline_backtest(to_spark(spark, ramp(90), "double")))
    assert errors.columns == [*SERIES, "Day", "Actual", "Predicted", "Error"]
    row = errors.orderBy("Day").first()
    assert row.Error == pytest.approx(row.Predicted - row.Actual)


def test_tail_days(spark, plan_of):
    df = to_spark(spark, random_series(1, {("A_1", "S"): 30, ("B_1", "S"): 4}))
    tail = tail_days(df, 5)
    got = {}
    for r in tail.collect():
        got.setdefault(r.item_id, []).append(r.day_num)
    assert {k: sorted(v) for k, v in got.items()} == {
        "A_1": [26, 27, 28, 29, 30],
        "B_1": [1, 2, 3, 4],
    }
    assert tail.columns == df.columns
    assert "WindowGroupLimit" in plan_of(tail)
