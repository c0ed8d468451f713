"""Raw wide sales to the long daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators.quality import CastLosses
from shelfline.operators.reshape import (
    FILE_ROWS,
    add_day_number,
    cluster_by_store,
    day_columns,
    filter_by_store,
    join_calendar,
    wide_to_long,
)
from shelfline.schemas import CALENDAR_COLUMNS, ID_COLUMNS
from shelfline.sources.files import read_calendar, read_sales_wide


def transform_sales_to_long(
    spark: SparkSession,
    raw_path: str,
    store_id: str | None = None,
    add_day_num: bool = True,
    calendar_path: str | None = None,
    file_rows: int | None = None,
    buckets: int | None = None,
    losses: CastLosses | None = None,
) -> DataFrame:
    """Read, optionally keep one store, unpivot, number the days, add the calendar.

    The store filter runs on the wide rows, before each becomes one row per day.
    With ``store_id=None`` all stores are transformed. ``file_rows`` clusters
    the wide rows for an output partitioned by store, with so many rows a file;
    ``buckets`` places them by item instead, for :func:`write_curated`.
    ``losses`` counts the raw values that casts turn into NULL, as the result is written.
    """
    sales = read_sales_wide(spark, raw_path)
    if store_id is not None:
        sales = filter_by_store(sales, store_id)
    if file_rows is not None:
        sales = cluster_by_store(sales, file_rows)
    if buckets is not None:
        sales = sales.repartition(buckets, "item_id")
    columns = [*ID_COLUMNS, "d", "sales"]
    long = wide_to_long(sales, losses)
    if add_day_num:
        long = add_day_number(long, losses)
        columns.append("day_num")
    if calendar_path is not None:
        long = join_calendar(long, read_calendar(spark, calendar_path, losses))
        columns += [c for c in CALENDAR_COLUMNS if c != "d"]
    return long.select(*columns)


def bucket_count(spark: SparkSession, raw_path: str, store_id: str | None, file_rows: int = FILE_ROWS) -> int:
    """Buckets of about ``file_rows`` long rows, and at least one per core."""
    sales = read_sales_wide(spark, raw_path)
    days = len(day_columns(sales))
    if store_id is not None:
        sales = filter_by_store(sales, store_id)
    return max(-(-sales.count() * days // file_rows), spark.sparkContext.defaultParallelism)
