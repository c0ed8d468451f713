import numpy as np
import pandas as pd
import pytest

from frames import ramp, random_series, to_spark
from shelfline.operators.features import (
    add_calendar_features,
    add_lag_features,
    add_rolling_features,
    build_features,
)
from shelfline.schemas import DEFAULT_LAGS, DEFAULT_WINDOWS, SERIES


def by_day(df):
    return df.orderBy("day_num").toPandas().set_index("day_num")


@pytest.mark.parametrize("kind", ["int", "double"])
def test_lag_values_and_warm_up(spark, kind):
    out = by_day(add_lag_features(to_spark(spark, ramp(), kind)))
    assert out.loc[8, "sales_lag_7"] == 1
    assert out.loc[11, "sales_lag_7"] == 4
    assert out["sales_lag_7"].isna().sum() == 7
    assert out["sales_lag_28"].isna().sum() == 28


@pytest.mark.parametrize("kind", ["int", "double"])
def test_rolling_mean_excludes_current_row(spark, kind):
    out = by_day(add_rolling_features(to_spark(spark, ramp(15), kind), windows=[3]))
    assert out.loc[5, "sales_rolling_mean_3"] == 3.0  # mean of 2, 3, 4
    assert out["sales_rolling_mean_3"].isna().sum() == 3
    assert out.loc[5, "sales_rolling_std_3"] == pytest.approx(1.0)


def test_custom_names(spark):
    out = build_features(to_spark(spark, ramp()), lags=[1], windows=[2, 5])
    expected = {"sales_lag_1"} | {
        f"sales_rolling_{f}_{n}" for f in ("mean", "std") for n in (2, 5)
    }
    assert expected <= set(out.columns)


def test_build_adds_nine_columns_and_keeps_the_rest(spark):
    df = to_spark(spark, ramp())
    out = build_features(df)
    added = [c for c in out.columns if c not in df.columns]
    assert sorted(added) == sorted(
        [f"sales_lag_{n}" for n in DEFAULT_LAGS]
        + [f"sales_rolling_{f}_{n}" for f in ("mean", "std") for n in DEFAULT_WINDOWS]
        + ["is_weekend", "has_event"]
    )
    assert set(df.columns) <= set(out.columns)


def test_calendar_flags(spark):
    rows = [(w, None) for w in range(1, 8)] + [(None, "SuperBowl"), (3, "Easter")]
    df = spark.createDataFrame(rows, "wday int, event_name_1 string")
    out = add_calendar_features(df).toPandas()
    assert out["is_weekend"].tolist() == [1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert out["has_event"].tolist() == [0] * 7 + [1, 1]


@pytest.mark.parametrize("kind", ["int", "double"])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_same_as_pandas_with_missing_cells(spark, kind, seed):
    """Several series in one frame, interior NULLs, row-based shifts."""
    lengths = {("A_1", "S1"): 70, ("A_1", "S2"): 40, ("B_2", "S1"): 5, ("C", "S2"): 100}
    pdf = random_series(seed, lengths, nulls=0.08)
    want = []
    for _, part in pdf.groupby(SERIES):
        part = part.sort_values("day_num").copy()
        sales = pd.to_numeric(part["sales"])
        for n in DEFAULT_LAGS:
            part[f"sales_lag_{n}"] = sales.shift(n)
        for n in DEFAULT_WINDOWS:
            window = sales.shift(1).rolling(n)
            part[f"sales_rolling_mean_{n}"] = window.mean()
            part[f"sales_rolling_std_{n}"] = window.std()
        want.append(part)
    keys = [*SERIES, "day_num"]
    want = pd.concat(want).sort_values(keys, ignore_index=True)
    got = build_features(to_spark(spark, pdf, kind)).toPandas()
    got = got.sort_values(keys, ignore_index=True)
    for c in want.columns:
        if c.startswith("sales_"):
            np.testing.assert_allclose(
                got[c].astype(float), want[c].astype(float), atol=1e-9, err_msg=c
            )


def test_integer_path_equals_sliding_path(spark):
    pdf = random_series(5, {("A_1", "S1"): 200, ("B_1", "S1"): 33}, nulls=0.03)
    keys = [*SERIES, "day_num"]
    ints = build_features(to_spark(spark, pdf, "int")).toPandas().sort_values(keys)
    doubles = build_features(to_spark(spark, pdf, "double")).toPandas().sort_values(keys)
    for c in [c for c in ints.columns if "rolling" in c]:
        np.testing.assert_allclose(ints[c], doubles[c], atol=1e-9, err_msg=c)


def test_one_exchange_and_one_sort(spark, plan_of):
    for kind in ("int", "double"):
        plan = plan_of(build_features(to_spark(spark, ramp(), kind)))
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Sort [") == 1


def test_rolling_features_of_large_units_do_not_overflow(spark):
    rows = [("A_1", "S", day, 2_000_000_000 - day % 3) for day in range(1, 41)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, day_num int, sales int")
    out = add_rolling_features(df).orderBy("day_num").toPandas()
    sales = pd.Series([float(r[3]) for r in rows])
    expected = sales.shift(1).rolling(7).mean()
    np.testing.assert_allclose(out["sales_rolling_mean_7"].astype(float), expected, rtol=1e-12)
