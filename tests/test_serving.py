import datetime as dt

import pytest

from shelfline.operators import serving
from shelfline.schemas import FORECASTS, MODEL_RUNS, SALES_HISTORY

DAY = dt.date(2016, 5, 1)
NOW = dt.datetime(2016, 6, 1)


def day(k):
    return DAY + dt.timedelta(days=k)


def run(run_id, version, trained, active, mae=1.0):
    return (run_id, version, NOW + dt.timedelta(days=trained), mae, 2.0, 1.5, 28, 2, "CA", None, active)


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [run(1, "v1", 0, True), run(2, "v2", 1, False, None), run(3, "v3", 1, False, 0.5)],
        MODEL_RUNS,
    )


@pytest.fixture
def forecasts(spark):
    rows = []
    # (item, store, day, prediction, version); ids grow in this order
    for item, store, k, value, version in [
        ("F_1", "CA", 0, 2.0, "v1"),
        ("F_1", "CA", 1, 4.0, "v1"),
        ("F_1", "CA", 1, 9.0, "v1"),  # later copy of the same key
        ("F_2", "CA", 0, 1.0, "v1"),
        ("PLAIN", "CA", 0, 5.0, "v1"),
        ("F_1", "TX", 0, 7.0, "v1"),
        ("F_1", "CA", 0, 3.0, "v3"),
        ("F_2", "CA", 0, 30.0, "v3"),
    ]:
        rows.append((len(rows), item, store, day(k), value, version, NOW))
    return spark.createDataFrame(rows, FORECASTS)


@pytest.fixture
def history(spark):
    rows = []
    for item, store, k, value, version in [
        ("F_1", "CA", 0, 1.0, "v1"),
        ("F_1", "CA", 1, 10.0, "v1"),
        ("F_1", "CA", 2, 4.0, "v1"),  # no forecast for this day
        ("F_2", "CA", 0, 8.0, "v3"),
        ("F_1", "CA", 0, 6.0, "v3"),
    ]:
        rows.append((len(rows), item, store, day(k), value, version))
    return spark.createDataFrame(rows, SALES_HISTORY)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_latest_and_active_differ(runs):
    assert serving.latest_run(runs).first().model_version == "v3"  # tie on time: later run id
    assert serving.active_run(runs).first().model_version == "v1"
    assert serving.model_status(runs).columns == [
        "model_version",
        "trained_at",
        "mae",
        "rmse",
        "weighted_mae",
        "horizon_days",
        "num_items",
        "store_id",
    ]


def test_runs_by_mae_puts_unscored_first(runs):
    assert [r.model_version for r in serving.runs_by_mae(runs).collect()] == ["v2", "v3", "v1"]


def test_run_parameters(runs):
    from pyspark.sql import functions as F

    logged = runs.withColumn("parameters", F.lit('{"num_leaves": 31, "metric": "mae"}'))
    got = {(r.parameter, r.value) for r in serving.run_parameters(logged).collect()}
    assert got == {("num_leaves", "31"), ("metric", "mae")}
    assert serving.run_parameters(runs).isEmpty()


def test_item_forecasts_cover_every_version(forecasts):
    got = rows(serving.item_forecasts(forecasts, "F_1", "CA"))
    assert [(r[2], r[3], r[4]) for r in got][0] == (day(0), 2.0, "v1")
    assert len(got) == 4


def test_latest_copy_wins(forecasts, history, runs):
    got = rows(serving.latest_forecasts(forecasts, runs, "F_1", "CA").orderBy("date"))
    assert got == [("F_1", "CA", "2016-05-01", 2.0, "v1"), ("F_1", "CA", "2016-05-02", 9.0, "v1")]
    got = rows(serving.latest_history(history, runs, "F_1", "CA").orderBy("date"))
    assert [r[2:] for r in got] == [("2016-05-01", 1.0), ("2016-05-02", 10.0), ("2016-05-03", 4.0)]


def test_summary_and_top_use_the_latest_run(forecasts, runs):
    assert rows(serving.forecast_summary(forecasts, runs)) == [
        ("F_1", "CA", 1, 3.0, day(0), day(0)),
        ("F_2", "CA", 1, 30.0, day(0), day(0)),
    ]
    assert rows(serving.top_items(forecasts, runs, 1)) == [("F_2", 30.0)]


def test_version_compare(forecasts, runs):
    got = rows(serving.version_compare(forecasts, runs, "F_1", "CA"))
    assert got == [
        ("F_1", "CA", "v3", 0.5, 2.0, 3.0, 1),
        ("F_1", "CA", "v1", 1.0, 2.0, 5.0, 3),
    ]


def test_dept_rollup_ignores_unmatched_days_in_mae(forecasts, history, runs):
    got = rows(serving.dept_rollup(forecasts, history, runs, "CA"))
    # PLAIN has no underscore and no actuals; F covers 2, 4, 9 (matched) and 1 (not)
    assert got == [("CA", "PLAIN", 1, 5.0, None), ("CA", "F", 2, 4.0, pytest.approx(8 / 3))]


def test_item_lists(forecasts, history, runs):
    assert rows(serving.items_by_name(forecasts, runs, "CA")) == [
        ("CA", "F_1"),
        ("CA", "F_2"),
        ("CA", "PLAIN"),
    ]
    assert rows(serving.items_by_name(forecasts, runs, "CA", "F")) == [("CA", "F_1"), ("CA", "F_2")]
    assert rows(serving.items_by_volume(forecasts, history, runs, "CA")) == [
        ("CA", "F_1", 5.0),
        ("CA", "F_2", 0.0),
        ("CA", "PLAIN", 0.0),
    ]
    assert rows(serving.items_by_volume(forecasts, history, runs, "CA", "PLAIN")) == [
        ("CA", "PLAIN", 0.0)
    ]
    assert rows(serving.avg_sales_by_item(history, runs)) == [("CA", "F_1", 5.0)]


def test_tiles(forecasts, history, runs):
    matched = rows(serving.actual_vs_predicted(forecasts, history, runs).orderBy("date"))
    assert [r[2:] for r in matched] == [("2016-05-01", 1.0, 2.0), ("2016-05-02", 10.0, 9.0)]
    assert rows(serving.item_tiles(forecasts, history, runs)) == [("F_1", "CA", 1.0, 1.0, 5.0)]
    tiles = {tuple(r)[:2]: tuple(r)[2:] for r in serving.forecast_tiles(forecasts, runs).collect()}
    assert tiles["F_1", "CA"] == (5.5, 2)


def test_no_active_run_gives_empty_frames(spark, forecasts, history, runs):
    from pyspark.sql import functions as F

    idle = runs.withColumn("is_active", F.lit(False))
    for df in (
        serving.model_status(idle),
        serving.latest_forecasts(forecasts, idle),
        serving.latest_history(history, idle),
        serving.dept_rollup(forecasts, history, idle),
        serving.items_by_name(forecasts, idle),
        serving.items_by_volume(forecasts, history, idle),
        serving.item_tiles(forecasts, history, idle),
    ):
        assert df.isEmpty() and df.columns
    assert serving.latest_forecasts(forecasts, runs, "NO_SUCH", "CA").isEmpty()


def test_copies_are_dropped_before_the_shuffle(forecasts, runs, plan_of):
    plan = plan_of(serving.latest_forecasts(forecasts, runs))
    assert "row_number(), 1, Partial" in plan


def test_matching_reuses_the_window_partitioning(forecasts, history, runs, plan_of):
    plan = plan_of(serving.actual_vs_predicted(forecasts, history, runs))
    assert plan.count("Exchange hashpartitioning") == 2  # one per side, none for the join


def test_most_copies_on_one_key(spark, runs):
    """A key with most of all rows keeps exactly its last copy."""
    hot = spark.range(20000).selectExpr(
        "id", "'F_1' item_id", "'CA' store_id", "date'2016-05-01' forecast_date",
        "double(id) predicted_sales", "'v1' model_version", "current_timestamp() created_at",
    )
    cold = spark.range(500).selectExpr(
        "id + 20000 id", "concat('F_', id + 2) item_id", "'CA' store_id",
        "date'2016-05-01' forecast_date", "1D predicted_sales", "'v1' model_version",
        "current_timestamp() created_at",
    )
    got = serving.latest_forecasts(hot.unionByName(cold), runs)
    assert got.count() == 501
    assert got.where("item_id = 'F_1'").first().predicted_sales == 19999.0


def test_fact_aggregates(spark):
    fact = spark.createDataFrame(
        [("F_1", "CA", 1, 4), ("F_2", "CA", 1, 8), ("G_1", "CA", 1, 7)],
        "item_id string, store_id string, day_num int, sales int",
    )
    assert rows(serving.fact_dept_summary(fact)) == [("G", 7.0, 1), ("F", 6.0, 2)]
