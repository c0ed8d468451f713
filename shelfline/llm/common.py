"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import new_dir


#: Texts scanned at once.
SCANNED = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, executors may go."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`saved` wrote and nothing will read again."""
    for df in tables:
        session = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = session._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns of the given names, in any case: results replace them."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_scanned(
    df: DataFrame,
    column: str,
    fields: T.StructType,
    scan: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """Append what ``scan()(texts)`` makes of every Arrow batch; rows stay where they are.

    ``scan`` is called once a task, so what it returns may keep caches for that task.
    """
    df = without(df, fields.names)
    schema = T.StructType([*df.schema.fields, *fields.fields])
    at = df.columns.index(column)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = scan()
        for batch in batches:
            # What a scan makes of texts is several times their size, so some are taken at a time.
            for start in range(0, batch.num_rows, SCANNED):
                part = batch.slice(start, SCANNED)
                yield pa.RecordBatch.from_arrays([*part.columns, *step(part.column(at))], names=names)
        del step
        trim()

    return df.mapInArrow(run, schema)


def kept_in_worker(kind: str, key: Hashable, make: Callable[[], object]) -> object:
    """``make()``, kept in this Python worker for later tasks; one object of each kind."""
    kept = vars(sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")))
    if kind not in kept or kept[kind][0] != key:
        release_kept()  # a stage keeps one object; what others kept is not asked for again
        kept[kind] = (key, make())
    return kept[kind][1]


def release_kept() -> None:
    """Free what earlier stages kept in this Python worker."""
    kept = vars(sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")))
    for kind in [k for k, v in kept.items() if isinstance(v, tuple) and len(v) == 2]:
        del kept[kind]
    trim()


def trim() -> None:
    """Give freed memory back to the system: workers outlive their tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def hex_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
