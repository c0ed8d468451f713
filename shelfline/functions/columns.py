"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.schemas import WEEKEND_WDAYS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(d: Column | str) -> Column:
    """``d_17`` -> 17; anything else -> NULL instead of a failed job."""
    return F.regexp_replace(_col(d), "^d_", "").try_cast("int")


def department(item_id: Column | str) -> Column:
    """Text before the first underscore (the whole id when there is none)."""
    return F.substring_index(_col(item_id), "_", 1)


def weekend_flag(wday: Column | str) -> Column:
    """1 on the two weekend codes, else 0; an unknown weekday counts as 0."""
    return F.coalesce(_col(wday).isin(*WEEKEND_WDAYS), F.lit(False)).cast("int")


def event_flag(event_name: Column | str) -> Column:
    return _col(event_name).isNotNull().cast("int")


def mean_absolute_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.avg(F.abs(_col(actual) - _col(predicted)))


def root_mean_squared_error(actual: Column | str, predicted: Column | str) -> Column:
    error = _col(actual) - _col(predicted)
    return F.sqrt(F.avg(error * error))


def non_negative(value: Column | str) -> Column:
    return F.greatest(F.lit(0.0), _col(value))


def version_tag(ts: Column | str) -> Column:
    """Version label of a scheduled run, e.g. ``v2026-03-01``."""
    return F.date_format(_col(ts), "'v'yyyy-MM-dd")
