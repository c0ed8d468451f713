"""Schema, key and completeness checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import DAILY_SALES


def missing_columns(
    columns: Iterable[str], required: Sequence[str] | T.StructType = DAILY_SALES
) -> tuple[bool, list[str]]:
    """``(complete, missing)`` by name: order is free and extra columns are allowed."""
    names = required.names if isinstance(required, T.StructType) else list(required)
    have = set(columns)
    missing = [c for c in names if c not in have]
    return not missing, missing


def type_mismatches(df: DataFrame, required: T.StructType = DAILY_SALES) -> list[str]:
    """Columns present under the right name with another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [
        f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in required.fields
        if f.name in have and have[f.name] != f.dataType
    ]


def require_columns(
    df: DataFrame, required: Sequence[str] | T.StructType = DAILY_SALES
) -> DataFrame:
    """Pass ``df`` through, or fail at plan time, before any job runs."""
    ok, missing = missing_columns(df.columns, required)
    if not ok:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Counts combine map-side, so hot keys are cheap."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of every required column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [arg for c in columns for arg in (F.lit(c), F.col(c))]
    return counts.select(
        F.stack(F.lit(len(columns)), *pairs).alias("column_name", "null_count")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key repeats; stops at the first violation found."""
    bad = unique_violations(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key: {bad[0].asDict()}")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pass ``df`` through; the job that evaluates it fails on a NULL in ``columns``.

    The check is part of the row's own expressions and costs no extra pass.
    """
    return df.withColumns(
        {c: F.coalesce(c, F.raise_error(F.lit(f"NULL in required column {c}"))) for c in columns}
    )


def table_profile(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: Sequence[str] = ()
) -> DataFrame:
    """Per column: row count, NULLs, min and max as text, exact distinct count if asked.

    Columns with a distinct count share one scan, see :func:`_counted`; the others share
    one aggregation.
    """
    names = list(columns or df.columns)
    with_count = [c for c in names if c in distinct]
    parts = []
    if with_count:
        parts.append(_counted(df, with_count))
    if len(with_count) < len(names):
        parts.append(_measured(df, [c for c in names if c not in with_count]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _stacked(stats: DataFrame, names: Sequence[str]) -> DataFrame:
    cells = []
    for c in names:
        cells += [F.lit(c), *[F.col(f"{c}__{k}") for k in ("nulls", "min", "max", "distinct")]]
    return stats.select(
        "row_count",
        F.stack(F.lit(len(names)), *cells).alias(
            "column_name", "null_count", "min_value", "max_value", "distinct_count"
        ),
    )


def _measured(df: DataFrame, names: Sequence[str]) -> DataFrame:
    unknown = F.lit(None).cast("long")
    stats = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in names],
        *[F.min(c).cast("string").alias(f"{c}__min") for c in names],
        *[F.max(c).cast("string").alias(f"{c}__max") for c in names],
    )
    return _stacked(stats.withColumns({f"{c}__distinct": unknown for c in names}), names)


def _counted(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One scan: rows become (column, value) pairs, which tasks reduce to distinct ones before
    the shuffle; everything else follows from those pairs and their counts.

    Values travel as text and are compared as their own type again, so columns must be of
    types that text keeps (numbers, dates, timestamps, booleans, strings).
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(
        *[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("value")) for k, c in enumerate(names)]
    )
    values = (
        df.select(F.explode(pairs).alias("pair"))
        .groupBy("pair.k", "pair.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stats = [F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("n"))), F.lit(0)).alias("row_count")]
    for k, c in enumerate(names):
        mine = F.col("k") == k
        known = F.when(mine, F.col("value").try_cast(kinds[c]))
        stats += [
            F.coalesce(F.sum(F.when(mine & F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(f"{c}__nulls"),
            F.min(known).cast("string").alias(f"{c}__min"),
            F.max(known).cast("string").alias(f"{c}__max"),
            F.count_if(mine & F.col("value").isNotNull()).alias(f"{c}__distinct"),
        ]
    return _stacked(values.agg(*stats), names)


class CastLosses:
    """Counts, per typed column, of raw values and of those that became NULL in the cast.

    Sources and operators that cast pass their rows through :meth:`watch`. The counters
    ride along with the job that evaluates those rows; nothing is read a second time.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[str, list[str], Observation]] = []

    def watch(self, df: DataFrame, source: str, casts: Mapping[str, tuple[Column, Column]]) -> DataFrame:
        """``casts``: for each typed column its name, raw expression and typed expression."""
        seen = Observation()
        self._watched.append((source, list(casts), seen))
        counts = []
        for k, (raw, typed) in enumerate(casts.values()):
            counts += [
                F.count_if(raw.isNotNull()).alias(f"raw_{k}"),
                F.count_if(raw.isNotNull() & typed.isNull()).alias(f"lost_{k}"),
            ]
        return df.observe(seen, *counts)

    def rows(self) -> list[tuple[str, str, int, int]]:
        """Source, column, raw values and lost ones, once the job has run."""
        out = []
        for source, names, seen in self._watched:
            found = seen.get
            out += [(source, c, found[f"raw_{k}"], found[f"lost_{k}"]) for k, c in enumerate(names)]
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        layout = "source string, column_name string, raw_values long, lost_values long"
        return spark.createDataFrame(self.rows(), layout)
