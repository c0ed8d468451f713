import pytest

from pyspark.sql import functions as F

from shelfline.functions import (
    department,
    mean_absolute_error,
    non_negative,
    root_mean_squared_error,
    version_tag,
)
from shelfline.operators import quality
from shelfline.operators.metrics import overall_metrics, run_summary, series_metrics
from shelfline.schemas import DAILY_SALES, MODEL_INPUT_COLUMNS


def scores(spark, actual, predicted):
    df = spark.createDataFrame(
        [(float(a), float(p)) for a, p in zip(actual, predicted)], "a double, p double"
    )
    return tuple(df.agg(mean_absolute_error("a", "p"), root_mean_squared_error("a", "p")).first())


def test_metric_vectors(spark):
    assert scores(spark, [100, 200, 300], [100, 200, 300]) == (0, 0)
    assert scores(spark, [100], [80]) == (20, 20)
    assert scores(spark, [100, 200, 150], [110, 210, 160])[0] == 10
    assert scores(spark, [0, 100], [0, 100])[0] == 0
    mae, rmse = scores(spark, [100, 100], [90, 50])
    assert mae < rmse
    assert scores(spark, [], []) == (None, None)


SERIES = "store_id string, item_id string, mae double, rmse double, weight double"


def test_overall_is_mean_of_series_scores(spark):
    df = spark.createDataFrame([("S", "A", 1.0, 2.0, 3.0), ("S", "B", 5.0, 6.0, 1.0)], SERIES)
    row = overall_metrics(df).first()
    assert (row.mae, row.rmse, row.weighted_mae) == (3.0, 4.0, 2.0)


def test_weighted_mae_without_volume(spark):
    df = spark.createDataFrame([("S", "A", 1.0, 2.0, 0.0), ("S", "B", 5.0, 6.0, 0.0)], SERIES)
    assert overall_metrics(df).first().weighted_mae == 3.0


def test_overall_of_nothing_is_null(spark):
    assert tuple(overall_metrics(spark.createDataFrame([], SERIES)).first()) == (None,) * 3


def test_series_metrics(spark):
    df = spark.createDataFrame(
        [("S", "A", 10.0, 7.0, 4, 2.5), ("S", "A", 10.0, 14.0, 4, 2.5)],
        "store_id string, item_id string, sales double, predicted double, n_train long, "
        "train_mean double",
    )
    row = series_metrics(df).first()
    assert (row.mae, row.weight, row.n_train, row.n_val) == (3.5, 2.5, 4, 2)
    assert row.rmse == pytest.approx(12.5**0.5)


def test_run_summary(spark):
    df = spark.createDataFrame([("A", "S"), ("A", "T"), ("B", "S")], "item_id string, store_id string")
    assert tuple(run_summary(df).first()) == (2, 3)


def test_schema_check_by_name():
    names = DAILY_SALES.names
    assert quality.missing_columns(names) == (True, [])
    assert quality.missing_columns(reversed(names)) == (True, [])
    assert quality.missing_columns([*names, "extra"]) == (True, [])
    assert quality.missing_columns([n for n in names if n not in ("d", "sales")]) == (
        False,
        ["d", "sales"],
    )
    ok, missing = quality.missing_columns([])
    assert not ok and len(missing) == 15
    assert quality.missing_columns(names, MODEL_INPUT_COLUMNS) == (True, [])


def test_schema_check_on_frames(spark):
    df = spark.createDataFrame([], DAILY_SALES)
    assert quality.require_columns(df) is df
    assert quality.type_mismatches(df) == []
    assert quality.type_mismatches(df.withColumn("sales", F.lit("x"))) == [
        "sales: string instead of int"
    ]
    with pytest.raises(ValueError, match="sales"):
        quality.require_columns(df.drop("sales"))


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, None)], "a int, b int")
    assert [tuple(r) for r in quality.unique_violations(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    with pytest.raises(ValueError, match="duplicate key"):
        quality.require_unique(df, ["a", "b"])
    quality.require_unique(df.distinct(), ["a", "b"])


def test_null_checks(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    got = {r.column_name: r.null_count for r in quality.null_violations(df, ["a", "b"]).collect()}
    assert got == {"a": 0, "b": 1}
    assert quality.not_null(df, ["a"]).count() == 2
    with pytest.raises(Exception, match="NULL in required column b"):
        quality.not_null(df, ["b"]).collect()


def test_profile(spark):
    df = spark.createDataFrame([(10, "x"), (9, None), (10, "y")], "n int, s string")
    rows = {r.column_name: r for r in quality.table_profile(df, distinct=["n"]).collect()}
    assert rows["n"].min_value == "9" and rows["n"].max_value == "10"
    assert rows["n"].distinct_count == 2 and rows["s"].distinct_count is None
    assert rows["s"].null_count == 1 and rows["s"].row_count == 3


def test_scalar_functions(spark):
    df = spark.createDataFrame([("FOODS_3_090", -2.0), ("PLAIN", 4.0)], "item_id string, x double")
    rows = df.select(department("item_id").alias("d"), non_negative("x").alias("x")).collect()
    assert [tuple(r) for r in rows] == [("FOODS", 0.0), ("PLAIN", 4.0)]
    tag = spark.sql("SELECT timestamp'2026-03-01 10:00:00' AS ts").select(version_tag("ts"))
    assert tag.first()[0] == "v2026-03-01"


def test_profile_counts_distinct_values_in_one_scan(spark, plan_of, tmp_path):
    rows = [(1, "b", None, 0.1), (1, None, None, -0.0), (None, "a", None, 0.1), (10, "", None, 1e300)]
    spark.createDataFrame(rows, "i int, s string, d date, x double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    profile = quality.table_profile(df, ["i", "s", "d", "x"], distinct=["i", "s", "d", "x"])
    assert plan_of(profile).count("FileScan") == 1
    got = {r.column_name: tuple(r)[2:] for r in profile.collect()}
    assert got["i"] == (1, "1", "10", 2)
    assert got["s"] == (1, "", "b", 3)
    assert got["d"] == (4, None, None, 0)
    assert got["x"][1:3] == ("-0.0", "1.0E300")
    some = {r.column_name: tuple(r)[2:] for r in quality.table_profile(df, ["i", "s"], ["s"]).collect()}
    assert some["s"] == got["s"] and some["i"] == (1, "1", "10", None)
    empty = quality.table_profile(df.where("false"), ["i"], ["i"]).collect()
    assert [tuple(r) for r in empty] == [(0, "i", 0, None, None, 0)]


def test_cast_losses_ride_along(spark):
    losses = quality.CastLosses()
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.7",)], "raw string")
    typed = df.withColumn("n", F.col("raw").try_cast("double"))
    out = losses.watch(typed, "file", {"n": (F.col("raw"), F.col("n"))})
    assert out.count() == 4
    assert losses.rows() == [("file", "n", 3, 1)]
    assert losses.report(spark).columns == ["source", "column_name", "raw_values", "lost_values"]
