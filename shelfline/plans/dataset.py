"""Curated tables derived from one directory of star-schema tables.

The raw tables are scanned once; what later steps read is written below the
session's shared folder, as a production pipeline keeps a curated zone and a
prediction store between its jobs. Every table is built on first use.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.models.moments import backtest_moments
from shelfline.models.per_series import backtest_per_series, ridge
from shelfline.models.pooled import backtest_pooled
from shelfline.operators.features import build_features
from shelfline.operators.split import holdout_split
from shelfline.plans.backtest import Baseline, Checkpoint, checkpoint_backtest, publish
from shelfline.session import new_dir
from shelfline.sources.files import CALENDAR_FILE, SALES_FILE, read_sales_wide, write_series_table
from shelfline.sources.star import Star
from shelfline.store import ForecastStore

# The two model versions kept in the derived store. The first stays
# active while the second is the newest, so "active" and "latest" differ.
V1, V2 = "v1.0", "v2.0"
TRAINED_AT = {V1: datetime(2001, 11, 5), V2: datetime(2001, 12, 5)}
PARAMETERS = {
    V1: {"recent_days": 28},
    V2: {"recent_days": 28, "trend_days": 56},
}
FORECASTERS = {V1: Baseline(trend=False), V2: Baseline(trend=True)}
ALL_STORES = "ALL"


class DemandDataset:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @cached_property
    def star(self) -> Star:
        return Star(self.spark, self.sf_dir)

    @property
    def demand(self) -> DataFrame:
        """Units per series and day with sales, straight from the raw tables."""
        return self.star.demand()

    @cached_property
    def raw_path(self) -> str:
        """Folder with the wide sales CSV."""
        path = new_dir(self.spark, "raw")
        self.star.write_sales_file(path)
        return path

    @cached_property
    def calendar_path(self) -> str:
        """Folder with the calendar CSV."""
        path = new_dir(self.spark, "calendar")
        self.star.write_calendar_file(path)
        return path

    @cached_property
    def damaged_path(self) -> str:
        """Folder with both CSV files, some of whose cells do not parse, are empty or have decimals."""
        path = new_dir(self.spark, "damaged")
        sales = read_sales_wide(self.spark, self.raw_path)
        of = lambda column, value: F.col(column) == value
        sales = sales.withColumns(
            {
                "d_5": F.when(of("dept_id", "ECONOMY"), "n/a").otherwise(F.col("d_5")),
                "d_9": F.when(of("store_id", "ASIA"), "12x").otherwise(F.col("d_9")),
                "d_11": F.when(~of("store_id", "EUROPE"), F.col("d_11")),
                "d_12": F.concat("d_12", F.lit(".0")),
                "d_extra": F.lit("1"),
            }
        )
        sales.write.option("header", True).csv(f"{path}/{SALES_FILE}")
        days = self.spark.read.option("header", True).csv(f"{self.calendar_path}/{CALENDAR_FILE}")
        days = days.withColumns(
            {
                "date": F.when(of("month", "2"), "soon").otherwise(F.col("date")),
                "wday": F.when(of("wday", "1"), "Sat").otherwise(F.col("wday")),
                "year": F.when(~of("month", "3"), F.col("year")),
            }
        )
        days.write.option("header", True).csv(f"{path}/{CALENDAR_FILE}")
        return path

    @cached_property
    def fact_table(self) -> str:
        name = f"daily_sales_{uuid.uuid4().hex[:12]}"
        buckets = self.star.buckets()
        write_series_table(
            self.star.daily_fact(buckets),
            name,
            new_dir(self.spark, "daily_sales"),
            buckets,
            placed=True,
        )
        return name

    @property
    def fact(self) -> DataFrame:
        """Dense daily fact, bucketed so that series operators need no exchange."""
        return self.spark.table(self.fact_table)

    @cached_property
    def checkpoints(self) -> dict[str, Checkpoint]:
        root = new_dir(self.spark, "checkpoints")
        return {
            v: checkpoint_backtest(self.spark, self.fact, FORECASTERS[v], v, root)
            for v in FORECASTERS
        }

    def _model_rows(self, name: str, backtest: Callable[[DataFrame], DataFrame]) -> DataFrame:
        path = new_dir(self.spark, name)
        features = build_features(self.fact)
        # As the features are handed to other engines: six decimals.
        real = [c for c in features.columns if "rolling" in c]
        features = features.withColumns({c: F.round(c, 6) for c in real})
        backtest(holdout_split(features)).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def per_series_rows(self) -> DataFrame:
        """Backtest of one model per series, fitted once."""
        return self._model_rows("per-series", lambda split: backtest_per_series(split, ridge))

    @cached_property
    def moment_rows(self) -> DataFrame:
        """Backtest of the same models, solved from sums of products."""
        return self._model_rows("moments", backtest_moments)

    @cached_property
    def pooled_rows(self) -> DataFrame:
        """Backtest of the pooled model, fitted once."""
        return self._model_rows("pooled", backtest_pooled)

    def publish(self, store: ForecastStore, version: str) -> tuple[int, int]:
        return publish(
            self.spark,
            store,
            version,
            self.checkpoints[version],
            ALL_STORES,
            parameters=PARAMETERS[version],
            trained_at=TRAINED_AT[version],
        )

    @cached_property
    def store(self) -> ForecastStore:
        store = ForecastStore(self.spark, new_dir(self.spark, "store"))
        for version in FORECASTERS:
            self.publish(store, version)
        store.promote(V1)
        return store


_datasets: dict[tuple[str, str], DemandDataset] = {}


def dataset(spark: SparkSession, sf_dir: str) -> DemandDataset:
    """The application's dataset for ``sf_dir``; tables are built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _datasets:
        _datasets[key] = DemandDataset(spark, sf_dir)
    return _datasets[key]
