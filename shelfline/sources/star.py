"""Daily demand tables from a star of line items, parts and suppliers.

item  = part type + brand number, e.g. ``ECONOMY_17``
store = region of the supplier
day   = ship date, numbered from the first ship date in the data
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.operators.joins import broadcast_within
from shelfline.operators.reshape import join_calendar
from shelfline.schemas import DAILY_SALES, ID_COLUMNS, SERIES
from shelfline.sources.files import CALENDAR_FILE, SALES_FILE

# Rows of a bucket of the daily fact, over all stores.
BUCKET_ROWS = 2_000_000

# Holidays of the calendar as (month-day, name, type).
HOLIDAYS = (
    ("01-01", "NewYear", "National"),
    ("07-04", "IndependenceDay", "National"),
    ("10-31", "Halloween", "Cultural"),
    ("12-25", "Christmas", "National"),
)


@dataclass(frozen=True)
class Span:
    """First day and number of days covered by the line items."""

    first: date
    days: int

    @property
    def columns(self) -> list[str]:
        return [f"d_{k}" for k in range(1, self.days + 1)]

    @property
    def last(self) -> date:
        return self.first + timedelta(days=self.days - 1)


def id_columns() -> dict[str, Column]:
    """The descriptive ids that follow from item and store."""
    kind = F.substring_index("item_id", "_", 1)
    return {
        "id": F.concat("item_id", F.lit("_"), "store_id"),
        "dept_id": kind,
        "cat_id": kind,
        "state_id": F.col("store_id"),
    }


def dense_demand(demand: DataFrame, span: Span) -> DataFrame:
    """Fill the days without sales with 0, from the first to the last day.

    Each sold day also emits the gap up to the next one, so the fill needs one
    window over the (already aggregated) series and neither a cross join with
    the calendar nor a join back.
    """
    w = Window.partitionBy(*SERIES).orderBy("day_num")
    start = F.when(F.row_number().over(w) == 1, 1).otherwise(F.col("day_num"))
    end = F.coalesce(F.lead("day_num").over(w) - 1, F.lit(span.days))
    gaps = demand.withColumns({"_start": start, "_end": end})
    return gaps.select(
        *SERIES,
        F.col("day_num").alias("_sold"),
        F.col("sales").alias("_units"),
        F.explode(F.sequence("_start", "_end")).alias("day_num"),
    ).select(
        *SERIES,
        "day_num",
        F.when(F.col("day_num") == F.col("_sold"), F.col("_units")).otherwise(0).alias("sales"),
    )


def calendar(spark: SparkSession, span: Span) -> DataFrame:
    """One row per day of the span, weekday 1 = Saturday."""
    day = F.date_add(F.lit(span.first), F.col("k").cast("int"))
    month_day = F.date_format("cal_date", "MM-dd")
    name = F.coalesce(*[F.when(month_day == md, n) for md, n, _ in HOLIDAYS])
    kind = F.coalesce(*[F.when(month_day == md, t) for md, _, t in HOLIDAYS])
    return (
        spark.range(span.days)
        .select(F.col("id").alias("k"))
        .select(F.concat(F.lit("d_"), F.col("k") + 1).alias("d"), day.alias("cal_date"))
        .select(
            "d",
            "cal_date",
            (F.dayofweek("cal_date") % 7 + 1).alias("wday"),
            F.month("cal_date").alias("month"),
            F.year("cal_date").alias("year"),
            name.alias("event_name_1"),
            kind.alias("event_type_1"),
        )
    )


class Star:
    """The star-schema tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def span(self) -> Span:
        """One-row aggregate over a single column of the line items."""
        day = F.col("l_shipdate").cast("date")
        low, high = self.table("lineitem").agg(F.min(day), F.max(day)).first()
        return Span(low, (high - low).days + 1)

    @cached_property
    def items(self) -> DataFrame:
        """Item of every part."""
        return broadcast_within(
            self.table("part").select(
                F.col("p_partkey").alias("l_partkey"),
                F.concat("p_type", F.lit("_"), F.substring("p_brand", 7, 100)).alias("item_id"),
            )
        )

    @cached_property
    def stores(self) -> DataFrame:
        """Store of every supplier."""
        return broadcast_within(
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("store_id"))
        )

    @property
    def calendar(self) -> DataFrame:
        return calendar(self.spark, self.span)

    def buckets(self) -> int:
        """Buckets for the daily fact: by its size, and at least one per core."""
        items = self.items.select("item_id").distinct().count()
        stores = self.stores.select("store_id").distinct().count()
        by_size = math.ceil(items * stores * self.span.days / BUCKET_ROWS)
        shuffle = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(by_size, min(shuffle, self.spark.sparkContext.defaultParallelism))

    def demand(self) -> DataFrame:
        """Units per item, store and day, for days with sales.

        The line items are read once and, while parts and suppliers fit a
        broadcast, not shuffled before the aggregation. That combines map-side,
        so an item with a third of all line items still shuffles at most one row
        per store, day and map task.
        """
        return (
            self.table("lineitem")
            .select(
                "l_partkey",
                "l_suppkey",
                F.col("l_shipdate").cast("date").alias("cal_date"),
                "l_quantity",
            )
            .join(self.items, "l_partkey")
            .join(self.stores, "l_suppkey")
            .groupBy("item_id", "store_id", "cal_date")
            .agg(F.sum("l_quantity").cast("int").alias("sales"))
            .withColumn("day_num", F.date_diff("cal_date", F.lit(self.span.first)) + 1)
        )

    def daily_fact(self, buckets: int | None = None) -> DataFrame:
        """Dense, calendar-enriched daily fact in the curated schema.

        ``buckets`` places the rows for a table bucketed by item. That happens on
        the days with sales, before the gaps are filled: the fill's window needs
        no further exchange and the dense rows are never shuffled.
        """
        demand = self.demand()
        if buckets is not None:
            demand = demand.repartition(buckets, "item_id")
        dense = dense_demand(demand, self.span)
        long = dense.withColumns(id_columns()).withColumn("d", F.concat(F.lit("d_"), "day_num"))
        return join_calendar(long, self.calendar).select(*DAILY_SALES.names)

    def sales_wide(self) -> DataFrame:
        """One row per series, one column per day; days without sales are NULL.

        The day list is fixed at plan time. Rows are placed by series before the
        pivot, which then needs no exchange of its own and yields one CSV file
        per task, so that the file can be read back in parallel.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return (
            self.demand()
            .repartition(tasks, *SERIES)
            .withColumns(id_columns())
            .withColumn("d", F.concat(F.lit("d_"), "day_num"))
            .groupBy(*ID_COLUMNS)
            .pivot("d", self.span.columns)
            .agg(F.sum("sales"))
        )

    def write_sales_file(self, raw_path: str) -> None:
        """The wide sales CSV, as the ETL pipeline reads it; days without sales are 0."""
        writer = self.sales_wide().write.option("header", True).option("nullValue", "0")
        writer.csv(f"{raw_path}/{SALES_FILE}")

    def write_calendar_file(self, raw_path: str) -> None:
        self.calendar.withColumnRenamed("cal_date", "date").write.option("header", True).csv(
            f"{raw_path}/{CALENDAR_FILE}"
        )
