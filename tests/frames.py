"""Small frames shared by the tests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

START = dt.date(2016, 1, 1)

SERIES_SCHEMA = (
    "item_id string, store_id string, day_num int, cal_date date, wday int, month int, "
    "year int, event_name_1 string, sales {sales}"
)


def ramp(n: int = 35) -> pd.DataFrame:
    """One series with sales 1..n and two events near its end."""
    events: list[str | None] = [None] * n
    events[n - 3], events[n - 1] = "SuperBowl", "Easter"
    return pd.DataFrame(
        {
            "item_id": "ITEM_1",
            "store_id": "CA_1",
            "day_num": range(1, n + 1),
            "cal_date": [START + dt.timedelta(days=k) for k in range(n)],
            "wday": [k % 7 + 1 for k in range(n)],
            "month": 1,
            "year": 2016,
            "event_name_1": events,
            "sales": [float(k) for k in range(1, n + 1)],
        }
    )


def random_series(seed: int, lengths: dict[tuple[str, str], int], nulls: float = 0.0):
    """Integer demand of several series; a share of the cells may be missing."""
    rng = np.random.default_rng(seed)
    parts = []
    for (item, store), n in lengths.items():
        part = ramp(max(n, 3)).head(n)
        part["item_id"], part["store_id"] = item, store
        sales = rng.integers(0, 40, n).astype(object)
        sales[rng.random(n) < nulls] = None
        part["sales"] = sales
        days = pd.Series(part["cal_date"])
        part["month"] = days.map(lambda d: d.month)
        part["year"] = days.map(lambda d: d.year)
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf: pd.DataFrame, sales: str = "int"):
    cast = int if sales == "int" else float
    order = [f.split()[0] for f in SERIES_SCHEMA.split(", ")]
    rows = [
        tuple(
            None
            if value is None or value != value
            else cast(value)
            if name == "sales"
            else value
            for name, value in zip(order, row)
        )
        for row in pdf[order].astype(object).itertuples(index=False)
    ]
    return spark.createDataFrame(rows, SERIES_SCHEMA.format(sales=sales))
