"""Versioned forecasts, actuals and model runs as Parquet tables.

Rows of a version lie in one or more *batches*, directories that are written once and
never changed. What counts is said by the newest *snapshot*: a small file with all model
runs and the list of live batches. Every change, be it a new version, a replaced or deleted one, an
append or an activation, first writes its batches, which nobody reads yet, and last a
snapshot, which is one file. A job that dies before that leaves everything as it was;
readers follow the newest complete snapshot, and one that has started keeps its own.

The snapshot also knows the extent of every batch (items, days, ids). So new ids need no
look at stored rows, and an append compares its keys only with batches, and within them
row groups, that overlap its own.

Snapshots beyond the newest ``retain`` and batches that none of the kept ones lists are
deleted after a change. One writer at a time is assumed, any number of readers.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import date, datetime
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.quality import not_null, require_unique
from shelfline.schemas import FORECASTS, MODEL_RUNS, NOT_NULL, SALES_HISTORY, UNIQUE_KEYS

_VERSION = re.compile(r"[A-Za-z0-9._-]{1,20}")
_LAYOUT = {
    "forecasts": (FORECASTS, "forecast_date"),
    "sales_history": (SALES_HISTORY, "sale_date"),
}


def delete_version(rows: DataFrame, version: str) -> DataFrame:
    """Rows of every other version; rows without a version stay."""
    return rows.where(~F.col("model_version").eqNullSafe(F.lit(version)))


def promote_version(runs: DataFrame, version: str) -> DataFrame:
    """Make ``version`` the only active run."""
    return runs.withColumn("is_active", F.col("model_version") == version)


def append_run(runs: DataFrame, run: DataFrame) -> DataFrame:
    """Add one logged run, numbered after the existing ones."""
    last = runs.agg(F.coalesce(F.max("run_id"), F.lit(0).cast("long"))).scalar()
    return runs.unionByName(run.withColumn("run_id", last + 1).select(*MODEL_RUNS.names))


def run_row(
    spark: SparkSession,
    model_version: str,
    mae: float | None,
    rmse: float | None,
    weighted_mae: float | None,
    horizon_days: int,
    num_items: int,
    store_id: str,
    parameters: Mapping[str, Any] | None = None,
    trained_at: datetime | None = None,
) -> DataFrame:
    """One run as a DataFrame: parameters as JSON (or NULL), inactive, stamped now."""
    # As text, so that the session's time zone applies and not the driver's.
    stamp = (
        F.current_timestamp()
        if trained_at is None
        else F.to_timestamp(F.lit(trained_at.isoformat(sep=" ")))
    )
    return _one_run(
        spark,
        {
            "model_version": F.lit(model_version),
            "trained_at": stamp,
            "mae": F.lit(mae),
            "rmse": F.lit(rmse),
            "weighted_mae": F.lit(weighted_mae),
            "horizon_days": F.lit(horizon_days),
            "num_items": F.lit(num_items),
            "store_id": F.lit(store_id),
            "parameters": F.lit(json.dumps(dict(parameters)) if parameters else None),
            "is_active": F.lit(False),
        },
    )


def _one_run(spark: SparkSession, values: Mapping[str, Column]) -> DataFrame:
    """A single row of the run table; columns not given are NULL."""
    return spark.range(0, 1, 1, 1).select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MODEL_RUNS.fields
        ]
    )


def _checked(version: str) -> str:
    if not _VERSION.fullmatch(version):
        raise ValueError(f"model version {version!r}: 1-20 letters, digits, '.', '_' or '-'")
    return version


class Batch(NamedTuple):
    """A directory of rows of one version, and what they cover."""

    table: str
    model_version: str
    batch: str
    rows: int
    last_id: int
    first_item: str
    last_item: str
    first_day: date
    last_day: date


_LIVE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("first_item", T.StringType()),
        T.StructField("last_item", T.StringType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("last_day", T.DateType()),
    ]
)
_SNAPSHOT = T.StructType([*MODEL_RUNS.fields, T.StructField("live", T.ArrayType(_LIVE))])
# Fixed value: the file that the writer of a job adds when all its files are in place.
_COMPLETE = "_SUCCESS"


class Change:
    """Batches and runs prepared on top of a snapshot; nothing is visible before :meth:`commit`."""

    def __init__(self, store: ForecastStore):
        self.store, self.spark = store, store.spark
        self.number, self.runs, self.live = store.newest()

    # -- forgetting ---------------------------------------------------------------

    def forget(self, version: str, tables: Iterable[str] = tuple(_LAYOUT)) -> None:
        """Leave out the rows of a version."""
        names = set(tables)
        self.live = [b for b in self.live if b.model_version != _checked(version) or b.table not in names]

    def forget_run(self, version: str) -> None:
        self.runs = delete_version(self.runs, _checked(version))

    # -- adding -------------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, version: str, mode: str = "replace") -> int:
        """Write a batch; with ``replace`` it stands for all the version held before."""
        if mode not in ("replace", "append"):
            raise ValueError(f"unknown mode {mode!r}")
        schema, day = _LAYOUT[table]
        _checked(version)
        last = max((b.last_id for b in self.live if b.table == table), default=-1)
        columns = [c for c in schema.names if c not in ("id", "model_version")]
        required = [c for c in NOT_NULL[table] if c != "model_version"]
        # Range placement makes each file cover its own stretch of series, so
        # min/max statistics skip files on item and store lookups. Keys are
        # unique within a version, so no range can be dominated by one of them.
        placed = not_null(rows, required).repartitionByRange("item_id", "store_id", day)
        batch = f"{self.number + 1}-{uuid.uuid4().hex[:12]}"
        path = self.store.batch_path(table, version, batch)
        seen = Observation()
        (
            placed.sortWithinPartitions("item_id", "store_id", day)
            .withColumn("id", F.lit(last + 1) + F.monotonically_increasing_id())
            .select("id", *columns)
            .observe(
                seen,
                F.count(F.lit(1)).alias("rows"),
                F.max("id").alias("last_id"),
                F.min("item_id").alias("first_item"),
                F.max("item_id").alias("last_item"),
                F.min(day).alias("first_day"),
                F.max(day).alias("last_day"),
            )
            .write.parquet(path)
        )
        found = seen.get
        self.store.step(f"wrote {table}")
        made = Batch(table, version, batch, **found) if found["rows"] else None
        if made:
            self._check_keys(made, [] if mode == "replace" else self.overlapping(made))
        if mode == "replace":
            self.forget(version, [table])
        if made:
            self.live.append(made)
        return found["rows"]

    def overlapping(self, new: Batch) -> list[Batch]:
        """Live batches of the same version that may hold a key of ``new``."""
        return [
            b
            for b in self.live
            if (b.table, b.model_version) == (new.table, new.model_version)
            and b.first_item <= new.last_item
            and new.first_item <= b.last_item
            and b.first_day <= new.last_day
            and new.first_day <= b.last_day
        ]

    def _check_keys(self, new: Batch, others: list[Batch]) -> None:
        """Refuse keys that repeat within the batch or are held by ``others``."""
        keys = [c for c in UNIQUE_KEYS[new.table] if c != "model_version"]
        mine = self.store.read_batches(new.table, [new]).select(*keys)
        try:
            require_unique(mine, keys)
            if others:
                taken = self.stored_keys(new, others).join(mine, keys, "left_semi").limit(1).collect()
                if taken:
                    raise ValueError(f"duplicate key: {taken[0].asDict()}")
        except ValueError:
            self.store.delete(self.store.batch_path(new.table, new.model_version, new.batch))
            raise

    def stored_keys(self, new: Batch, others: list[Batch]) -> DataFrame:
        """Keys in ``others`` within the extent of ``new``: bounds that Parquet skips row groups by."""
        day = _LAYOUT[new.table][1]
        keys = [c for c in UNIQUE_KEYS[new.table] if c != "model_version"]
        return self.store.read_batches(new.table, others).where(
            F.col("item_id").between(new.first_item, new.last_item)
            & F.col(day).between(F.lit(new.first_day), F.lit(new.last_day))
        ).select(*keys)

    def log(self, run: DataFrame, version: str) -> None:
        """Add a run and make it the active one."""
        runs = append_run(self.runs, run)
        require_unique(runs, UNIQUE_KEYS["model_runs"])
        self.promote(version, runs)

    def promote(self, version: str, runs: DataFrame | None = None) -> None:
        self.runs = promote_version(self.runs if runs is None else runs, _checked(version))

    def commit(self) -> None:
        """Make the change visible by one file, then delete what no kept snapshot lists."""
        self.store.step("before the snapshot")
        self.store.save(self.runs, self.live, self.number + 1)
        self.store.step("wrote the snapshot")
        self.store.expire()


class ForecastStore:
    """The three tables below one root path."""

    def __init__(self, spark: SparkSession, root: str, retain: int = 8):
        """Open the store, creating empty tables where there are none.

        ``retain``: snapshots kept, so a reader may go on through so many changes but one.
        """
        if retain < 1:
            raise ValueError("retain must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain = retain
        for table in UNIQUE_KEYS:
            path, fs = self._filesystem(table)
            fs.mkdirs(path)

    # -- reading ------------------------------------------------------------------

    def newest(self) -> tuple[int, DataFrame, list[Batch]]:
        """Number of the newest complete snapshot (0 without one), its runs and live batches."""
        numbers = self._snapshots()
        if not numbers:
            return 0, self.spark.createDataFrame([], MODEL_RUNS), []
        runs = self._read_snapshot(numbers[-1]).where(F.col("model_version").isNotNull())
        return numbers[-1], runs.select(*MODEL_RUNS.names), self._live_in(numbers[-1])

    def _read_snapshot(self, number: int) -> DataFrame:
        """Rows of one snapshot; the predicate tells the optimizer that they are few, so
        that a join with runs prunes the versions that are read."""
        schema = T.StructType([*_SNAPSHOT.fields, T.StructField("snapshot", T.LongType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/model_runs")
        return reader.parquet(self._snapshot_path(number)).where(F.col("snapshot") == number)

    def _live_in(self, number: int) -> list[Batch]:
        rows = self._read_snapshot(number)
        marker = rows.where(F.col("model_version").isNull()).select("live").first()
        return [Batch(*b) for b in (marker["live"] or [])]

    def read_batches(self, table: str, batches: Iterable[Batch]) -> DataFrame:
        """Rows of some batches; ``model_version`` is a partition column."""
        schema = _LAYOUT[table][0]
        paths = [self.batch_path(table, b.model_version, b.batch) for b in batches]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*paths).select(*schema.names)

    def _table(self, table: str) -> DataFrame:
        numbers = self._snapshots()
        live = self._live_in(numbers[-1]) if numbers else []
        return self.read_batches(table, [b for b in live if b.table == table])

    def forecasts(self) -> DataFrame:
        return self._table("forecasts")

    def sales_history(self) -> DataFrame:
        return self._table("sales_history")

    def model_runs(self) -> DataFrame:
        return self.newest()[1]

    # -- writing ------------------------------------------------------------------

    def change(self) -> Change:
        """A change to several tables that becomes visible as a whole."""
        return Change(self)

    def write_forecasts(self, predictions: DataFrame, version: str, mode: str = "replace") -> int:
        """Store predictions under ``version``; returns the number of rows written.

        ``replace`` stands for what the version held, ``append`` adds to it.
        """
        change = self.change()
        written = change.write("forecasts", stamped(predictions), version, mode)
        change.commit()
        return written

    def write_sales_history(self, history: DataFrame, version: str, mode: str = "replace") -> int:
        change = self.change()
        written = change.write("sales_history", history, version, mode)
        change.commit()
        return written

    def replace_version(self, version: str, predictions: DataFrame, history: DataFrame, run: DataFrame) -> tuple[int, int]:
        """Put forecasts, actuals and run of ``version`` in the place of its old ones, in one step.

        Returns the forecast and history rows written. Until the last step, and after a
        failure in any, the old version is the one that is read.
        """
        change = self.change()
        written = (
            change.write("forecasts", stamped(predictions), version),
            change.write("sales_history", history, version),
        )
        change.forget_run(version)
        change.log(run, version)
        change.commit()
        return written

    def log_model_run(
        self,
        model_version: str,
        mae: float | None,
        rmse: float | None,
        weighted_mae: float | None,
        horizon_days: int,
        num_items: int,
        store_id: str,
        parameters: Mapping[str, Any] | None = None,
        trained_at: datetime | None = None,
    ) -> None:
        """Record a run and make it the active one."""
        run = run_row(
            self.spark,
            _checked(model_version),
            mae,
            rmse,
            weighted_mae,
            horizon_days,
            num_items,
            store_id,
            parameters,
            trained_at,
        )
        change = self.change()
        change.log(run, model_version)
        change.commit()

    def promote(self, version: str) -> None:
        change = self.change()
        change.promote(version)
        change.commit()

    def delete_model_version(self, version: str) -> None:
        """Remove a version from all three tables in one step; repeating it does nothing."""
        change = self.change()
        change.forget(version)
        change.forget_run(version)
        change.commit()

    # -- snapshots and files --------------------------------------------------------

    def step(self, name: str) -> None:
        """Called after each step of a change."""

    def save(self, runs: DataFrame, live: Iterable[Batch], number: int) -> None:
        """Write a snapshot as one file: the runs, and a row without a version for the batches."""
        listed = self.spark.createDataFrame([(list(live),)], T.StructType([_SNAPSHOT["live"]]))
        marker = _one_run(self.spark, {}).withColumn("_", F.lit(1)).join(listed.withColumn("_", F.lit(1)), "_").drop("_")
        none = F.lit(None).cast(_SNAPSHOT["live"].dataType)
        rows = runs.withColumn("live", none).unionByName(marker)
        rows.coalesce(1).write.mode("overwrite").parquet(self._snapshot_path(number))

    def expire(self) -> None:
        """Delete snapshots beyond the newest ``retain``, and batches in none of those left."""
        numbers = self._snapshots()
        kept = numbers[-self.retain :]
        named = {(b.table, b.model_version, b.batch) for n in kept for b in self._live_in(n)}
        for number, path in self._numbered():
            if number < kept[0] or (number not in kept and number < kept[-1]):
                self.delete(path)
        for table in _LAYOUT:
            for version in self._children(table):
                batches = self._children(f"{table}/{version}")
                for batch in batches:
                    key = (table, version.removeprefix("model_version="), batch.removeprefix("batch="))
                    if key not in named:
                        self.delete(f"{self.root}/{table}/{version}/{batch}")

    def batch_path(self, table: str, version: str, batch: str) -> str:
        return f"{self.root}/{table}/model_version={_checked(version)}/batch={batch}"

    def _snapshot_path(self, number: int) -> str:
        return f"{self.root}/model_runs/snapshot={number}"

    def _numbered(self) -> list[tuple[int, str]]:
        """Number and path of every snapshot directory, complete or not."""
        names = [n for n in self._children("model_runs") if n.startswith("snapshot=")]
        return sorted((int(n.removeprefix("snapshot=")), f"{self.root}/model_runs/{n}") for n in names)

    def _snapshots(self) -> list[int]:
        """Numbers of the complete snapshots, rising."""
        out = []
        for number, _ in self._numbered():
            path, fs = self._filesystem(f"model_runs/snapshot={number}/{_COMPLETE}")
            if fs.exists(path):
                out.append(number)
        return out

    def _children(self, name: str) -> list[str]:
        path, fs = self._filesystem(name)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def delete(self, path: str) -> None:
        target, fs = self._filesystem(path.removeprefix(f"{self.root}/"))
        fs.delete(target, True)

    def _filesystem(self, name: str):
        """Hadoop path below the root and the file system it lives on."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())


def stamped(predictions: DataFrame) -> DataFrame:
    """Forecasts with the time of their writing."""
    return predictions.withColumn("created_at", F.current_timestamp())
