"""The curated daily fact between jobs: bucketed by item, and found again by any session.

A session's catalog ends with it, so the placement is recorded with the data. Each write
makes a new folder of data and, when that is complete, a small numbered record with its
name and number of buckets. Readers take the newest complete record and declare the table
in their own catalog under a name made from the folder; no file is listed or inferred
differently from how it was written, and a write that fails changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfline.schemas import DAILY_SALES, SERIES
from shelfline.sources.files import write_series_table

RECORD = T.StructType([T.StructField("folder", T.StringType()), T.StructField("buckets", T.IntegerType())])
_COMPLETE = "_SUCCESS"
#: Records kept: readers of the one before the newest may go on.
KEPT = 2


def _children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _filesystem(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []


def _filesystem(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(sc._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [n for n in _children(spark, root) if n.startswith("record-")]
    return sorted(int(n.removeprefix("record-")) for n in names)


def _complete(spark: SparkSession, root: str) -> list[int]:
    return [n for n in _numbers(spark, root) if _COMPLETE in _children(spark, f"{root}/record-{n}")]


def _record(spark: SparkSession, root: str, number: int) -> tuple[str, int]:
    """Full path of the data and number of buckets; the record itself holds the bare name."""
    row = spark.read.schema(RECORD).json(f"{root}/record-{number}").first()
    target, fs = _filesystem(spark, f"{root}/{row['folder']}")
    return fs.makeQualified(target).toString(), row["buckets"]


def table_name(folder: str) -> str:
    """Stable for a folder, and a legal identifier whatever the folder is called."""
    return f"daily_sales_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def write_curated(df: DataFrame, root: str, buckets: int) -> DataFrame:
    """Write the fact below ``root`` and make it what :func:`read_curated` reads.

    ``df`` is placed by ``repartition(buckets, "item_id")`` already.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    name = f"data-{uuid.uuid4().hex[:12]}"
    target, fs = _filesystem(spark, f"{root}/{name}")
    folder = fs.makeQualified(target).toString()
    write_series_table(df, table_name(folder), folder, buckets, placed=True)
    number = max(_numbers(spark, root), default=0) + 1
    spark.createDataFrame([(name, buckets)], RECORD).coalesce(1).write.json(f"{root}/record-{number}")
    kept = _complete(spark, root)[-KEPT:]
    named = {_record(spark, root, n)[0].rsplit("/", 1)[1] for n in kept}
    for child in _children(spark, root):
        stale = child.startswith("data-") and child not in named
        if stale or (child.startswith("record-") and int(child.removeprefix("record-")) not in kept):
            target, fs = _filesystem(spark, f"{root}/{child}")
            fs.delete(target, True)
    return read_curated(spark, root)


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """The fact last written below ``root``; operators by series plan no exchange over it."""
    numbers = _complete(spark, root.rstrip("/"))
    if not numbers:
        raise FileNotFoundError(f"no curated fact in {root}")
    folder, buckets = _record(spark, root.rstrip("/"), numbers[-1])
    name = table_name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DAILY_SALES.fields)
        store, item = SERIES
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({store}) "
            f"CLUSTERED BY ({item}) SORTED BY ({item}, day_num) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*DAILY_SALES.names)
