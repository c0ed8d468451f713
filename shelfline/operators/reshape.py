"""Wide daily sales -> long, calendar-enriched daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import day_number
from shelfline.operators.quality import CastLosses
from shelfline.schemas import CALENDAR_COLUMNS, DAY_PREFIX, ID_COLUMNS

# Long rows of one output file of the curated fact.
FILE_ROWS = 2_000_000


def whole_number(column: Column) -> Column:
    """Text as an integer: decimals are cut off, other text becomes NULL.

    Plain integers, nearly all of the cells, are cast once.
    """
    return F.coalesce(column.try_cast("int"), column.try_cast("double").try_cast("int"))


def day_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(DAY_PREFIX)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def filter_by_store(df: DataFrame, store_id: str) -> DataFrame:
    return df.where(F.col("store_id") == store_id)


def cluster_by_store(wide: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """Place the wide rows of each store in tasks of about ``file_rows`` long rows.

    Done before the unpivot, this shuffles one compact row per series instead of
    one row per day, and a later write partitioned by store yields one file per
    slot. A store gets slots in proportion to its rows, so one with most of them
    spreads over most of the tasks. The count per store reads two columns.
    """
    days = max(1, len(day_columns(wide)))
    slots = wide.groupBy("store_id").agg(
        F.ceil(F.count(F.lit(1)) * days / file_rows).cast("int").alias("_slots")
    )
    tasks = max(
        slots.agg(F.coalesce(F.sum("_slots"), F.lit(0))).first()[0],
        int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    known = slots.select(F.col("store_id").alias("_store"), "_slots")
    placed = wide.join(known, F.col("store_id").eqNullSafe(F.col("_store")))
    slot = F.pmod(F.hash(*ID_COLUMNS), F.col("_slots"))
    return placed.repartition(tasks, F.col("store_id"), slot).select(*[F.col(_quoted(c)) for c in wide.columns])


def wide_to_long(df: DataFrame, losses: CastLosses | None = None) -> DataFrame:
    """One output row per id row and day column; NULL cells are kept.

    A row's cells become one map from column name to value, which a single
    generator explodes: no shuffle, and the plan names each day column once. The
    map is given as expression text because a Column object per day column costs
    seconds of driver time at a few thousand columns.
    """
    days = day_columns(df)
    if not days:
        raise ValueError(f"no {DAY_PREFIX}* column to unpivot")
    names = F.split(F.lit("\n".join(days)), "\n")
    cells = F.expr("array(" + ", ".join(_quoted(d) for d in days) + ")")
    long = df.select(
        *ID_COLUMNS, F.explode(F.map_from_arrays(names, cells)).alias("d", "sales")
    )
    if losses is None:
        return long.withColumn("sales", whole_number(F.col("sales")))
    both = long.withColumn("_raw", F.col("sales")).withColumn("sales", whole_number(F.col("sales")))
    return losses.watch(both, "sales", {"sales": (F.col("_raw"), F.col("sales"))}).drop("_raw")


def add_day_number(df: DataFrame, losses: CastLosses | None = None) -> DataFrame:
    out = df.withColumn("day_num", day_number("d"))
    if losses is not None:
        out = losses.watch(out, "sales", {"day_num": (F.col("d"), F.col("day_num"))})
    return out


def join_calendar(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on ``d``.

    No broadcast hint: a calendar of any realistic length is far below the
    session's broadcast threshold, and Spark checks that size itself; an
    oversized one falls back to a shuffle join instead of exhausting executors.
    """
    enriched = long.join(calendar.select(*CALENDAR_COLUMNS), "d", "left")
    added = [c for c in CALENDAR_COLUMNS if c != "d"]
    return enriched.select(*long.columns, *added)


def first_days(df: DataFrame, n: int = 7) -> DataFrame:
    """Narrow sample of the wide table: ids and the first ``n`` days as integers."""
    days: list[Column] = [whole_number(F.col(_quoted(d))).alias(d) for d in day_columns(df)[:n]]
    return df.select(*ID_COLUMNS, *days)


def item_slice(fact: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """Daily sales of one series in day order."""
    wanted = (F.col("item_id") == item_id) & (F.col("store_id") == store_id)
    return fact.where(wanted).select("day_num", "sales").orderBy("day_num")


def peek(fact: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of the fact's key columns in a total order."""
    return (
        fact.select("id", "store_id", "item_id", "d", "day_num", "sales")
        .orderBy("id", "day_num")
        .limit(n)
    )
