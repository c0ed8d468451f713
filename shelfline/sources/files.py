"""CSV, Parquet and JSON inputs and the Parquet sink of the curated layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.quality import CastLosses
from shelfline.operators.reshape import whole_number
from shelfline.schemas import DAILY_SALES, METRICS

# Input file names.
SALES_FILE = "sales_train_evaluation.csv"
CALENDAR_FILE = "calendar.csv"


def read_sales_wide(spark: SparkSession, raw_path: str) -> DataFrame:
    """Wide sales table: header names, every column a string, no inference pass."""
    return spark.read.option("header", True).csv(f"{raw_path}/{SALES_FILE}")


def read_calendar(spark: SparkSession, raw_path: str, losses: CastLosses | None = None) -> DataFrame:
    """Calendar columns in use, typed; values that do not parse become NULL.

    ``losses`` counts those values.
    """
    raw = spark.read.option("header", True).csv(f"{raw_path}/{CALENDAR_FILE}")
    numbers = {c: whole_number(F.col(c)) for c in ("wday", "month", "year")}
    typed = {"cal_date": F.col("date").try_cast("date"), **numbers}
    if losses is not None:
        raws = {"cal_date": "date"}
        raw = losses.watch(raw, "calendar", {c: (F.col(raws.get(c, c)), t) for c, t in typed.items()})
    return raw.select(
        "d", *[t.alias(c) for c, t in typed.items()], "event_name_1", "event_type_1"
    )


def read_daily_sales(spark: SparkSession, path: str) -> DataFrame:
    """Curated fact from Hive-partitioned Parquet.

    The explicit schema keeps numeric-looking ids strings and skips inference;
    filters on ``store_id`` prune directories.
    """
    return spark.read.schema(DAILY_SALES).parquet(path).select(*DAILY_SALES.names)


def daily_sales_path(curated_path: str, store_id: str) -> str:
    """Folder of one store's curated fact."""
    return f"{curated_path.rstrip('/')}/daily_{store_id.lower()}"


def write_parquet(
    df: DataFrame,
    output_path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Write Parquet, optionally partitioned into directories.

    Rows are rebalanced on the partition columns first, so a directory gets few
    files of about the advisory size; a directory with a large share of all rows
    (one dominant store) is split over several tasks by AQE. Pass
    ``rebalance=False`` for rows already placed that way.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(output_path)


def write_series_table(
    df: DataFrame, table: str, path: str, buckets: int, placed: bool = False
) -> None:
    """Write the fact as a catalog table partitioned by store and bucketed by item.

    A series then lives in one bucket of one store: feature windows, per-series
    models and per-series aggregates over this table need no exchange, and a
    store filter still prunes directories. Rows are first shuffled on the bucket
    key, to write one file per store and bucket, unless they are ``placed`` that
    way. A bucket is bounded by its items times stores times days, whatever the
    raw volume of an item was.
    """
    if not placed:
        df = df.repartition(buckets, "item_id")
    (
        df.write.mode("overwrite")
        .option("path", path)
        .partitionBy("store_id")
        .bucketBy(buckets, "item_id")
        .sortBy("item_id", "day_num")
        .saveAsTable(table)
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One-row metrics frame as a single JSON document."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)
