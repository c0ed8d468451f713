import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import random_series, to_spark
from shelfline.operators import serving
from shelfline.plans.backtest import (
    Baseline,
    Moments,
    PerSeries,
    Pooled,
    checkpoint_backtest,
    publish,
    read_forecast_checkpoint,
    run_backtest,
)
from shelfline.sources.files import read_metrics
from shelfline.store import ForecastStore, delete_version, promote_version
from shelfline.schemas import FORECASTS, MODEL_RUNS, SALES_HISTORY


def predictions(spark, value=1.0, n=3):
    rows = [(f"F_{k}", "CA", dt.date(2016, 1, 1), value + k) for k in range(n)]
    return spark.createDataFrame(
        rows, "item_id string, store_id string, forecast_date date, predicted_sales double"
    )


@pytest.fixture
def store(spark, tmp_path):
    return ForecastStore(spark, str(tmp_path / "store"))


def log(store, version, **changes):
    values = dict(mae=1.0, rmse=2.0, weighted_mae=3.0, horizon_days=28, num_items=3, store_id="CA")
    store.log_model_run(version, **{**values, **changes})


def test_new_store_is_empty_with_schema(store):
    assert store.forecasts().schema == FORECASTS and store.forecasts().isEmpty()
    assert store.sales_history().schema == SALES_HISTORY
    assert store.model_runs().schema == MODEL_RUNS and store.model_runs().isEmpty()


def test_write_returns_rows_and_fills_defaults(spark, store):
    assert store.write_forecasts(predictions(spark), "v1.0") == 3
    rows = store.forecasts().collect()
    assert {r.model_version for r in rows} == {"v1.0"}
    assert all(r.created_at is not None for r in rows)
    assert len({r.id for r in rows}) == 3


def test_rewriting_a_version_replaces_only_that_version(spark, store):
    store.write_forecasts(predictions(spark), "v1.0")
    store.write_forecasts(predictions(spark), "v2.0")
    store.write_forecasts(predictions(spark, 10.0, n=2), "v1.0")
    got = sorted((r.model_version, r.item_id, r.predicted_sales) for r in store.forecasts().collect())
    assert got == [
        ("v1.0", "F_0", 10.0),
        ("v1.0", "F_1", 11.0),
        ("v2.0", "F_0", 1.0),
        ("v2.0", "F_1", 2.0),
        ("v2.0", "F_2", 3.0),
    ]
    assert store.forecasts().select("id").distinct().count() == 5


def test_replacing_with_nothing_leaves_nothing(spark, store):
    store.write_forecasts(predictions(spark), "v1.0")
    assert store.write_forecasts(predictions(spark).where("false"), "v1.0") == 0
    assert store.forecasts().isEmpty()


def test_append_keeps_earlier_rows_and_grows_ids(spark, store):
    store.write_forecasts(predictions(spark), "v1.0")
    first = store.forecasts().agg({"id": "max"}).first()[0]
    later = predictions(spark, 5.0).withColumn("forecast_date", F.date_add("forecast_date", 400))
    store.write_forecasts(later, "v1.0", mode="append")
    assert store.forecasts().count() == 6
    assert store.forecasts().where(f"id > {first}").count() == 3


def test_append_refuses_stored_keys(spark, store):
    store.write_forecasts(predictions(spark), "v1.0")
    with pytest.raises(ValueError, match="duplicate key"):
        store.write_forecasts(predictions(spark, 5.0), "v1.0", mode="append")
    assert store.forecasts().count() == 3
    store.write_forecasts(predictions(spark, 5.0), "v2.0", mode="append")
    assert store.forecasts().count() == 6


def test_failed_replace_keeps_the_old_version(spark, store):
    store.write_forecasts(predictions(spark), "v1.0")
    before = sorted(store.forecasts().collect())
    broken = predictions(spark, 5.0).withColumn(
        "predicted_sales", F.raise_error(F.lit("broken input")).cast("double")
    )
    with pytest.raises(Exception, match="broken input"):
        store.write_forecasts(broken, "v1.0")
    assert sorted(store.forecasts().collect()) == before
    assert store.write_forecasts(predictions(spark).limit(0), "v1.0") == 0
    assert store.forecasts().isEmpty()


def test_constraints_are_checked(spark, store):
    twice = predictions(spark).union(predictions(spark))
    with pytest.raises(ValueError, match="duplicate key"):
        store.write_forecasts(twice, "v1.0")
    missing = predictions(spark).selectExpr(
        "item_id", "store_id", "forecast_date", "nullif(predicted_sales, 1D) predicted_sales"
    )
    with pytest.raises(Exception, match="NULL in required column predicted_sales"):
        store.write_forecasts(missing, "v1.0")
    assert store.forecasts().isEmpty()
    log(store, "v1.0")
    with pytest.raises(ValueError, match="duplicate key"):
        log(store, "v1.0")


@pytest.mark.parametrize("version", ["", "../x", "a=b", "v" * 21])
def test_version_names(spark, store, version):
    with pytest.raises(ValueError, match="model version"):
        store.write_forecasts(predictions(spark), version)


def test_purely_numeric_versions_stay_text(spark, store):
    store.write_forecasts(predictions(spark), "7")
    assert store.forecasts().first().model_version == "7"


def test_logging_promotes_and_numbers_runs(store):
    log(store, "v1.0", parameters={"num_leaves": 31})
    log(store, "v2.0", trained_at=dt.datetime(2016, 1, 2, 3, 4, 5))
    runs = {r.model_version: r for r in store.model_runs().collect()}
    assert [runs["v1.0"].run_id, runs["v2.0"].run_id] == [1, 2]
    assert [runs["v1.0"].is_active, runs["v2.0"].is_active] == [False, True]
    assert json.loads(runs["v1.0"].parameters) == {"num_leaves": 31}
    assert runs["v2.0"].parameters is None
    assert runs["v1.0"].trained_at is not None
    text = store.model_runs().selectExpr("model_version", "string(trained_at) t").collect()
    assert dict(map(tuple, text))["v2.0"] == "2016-01-02 03:04:05"
    store.promote("v1.0")
    assert serving.active_run(store.model_runs()).first().model_version == "v1.0"


def test_delete_version(spark, store):
    for v in ("v1.0", "v2.0"):
        store.write_forecasts(predictions(spark), v)
        log(store, v)
    for _ in range(2):
        store.delete_model_version("v1.0")
    assert [r.model_version for r in store.model_runs().collect()] == ["v2.0"]
    assert {r.model_version for r in store.forecasts().collect()} == {"v2.0"}


def test_deleting_the_only_run(spark, store):
    log(store, "v1.0")
    store.delete_model_version("v1.0")
    assert store.model_runs().isEmpty()
    log(store, "v1.0")
    assert [(r.run_id, r.is_active) for r in store.model_runs().collect()] == [(1, True)]


def test_delete_operator_keeps_rows_without_version(spark):
    df = spark.createDataFrame([("v1",), ("v2",), (None,)], "model_version string")
    left = {r.model_version for r in delete_version(df, "v1").collect()}
    assert left == {"v2", None}
    flags = promote_version(df, "v2").where("is_active").collect()
    assert [r.model_version for r in flags] == ["v2"]


def test_version_filter_prunes_partitions(spark, store, plan_of):
    store.write_forecasts(predictions(spark), "v1.0")
    log(store, "v1.0")
    plan = plan_of(serving.forecast_summary(store.forecasts(), store.model_runs()))
    assert "dynamicpruning" in plan
    plan = plan_of(store.forecasts().where("model_version = 'v1.0' AND item_id = 'F_1'"))
    assert "PartitionFilters: [isnotnull(model_version" in plan
    assert "EqualTo(item_id,F_1)" in plan


@pytest.fixture
def fact(spark):
    from pyspark.sql import functions as F

    lengths = {("F_1", "CA"): 120, ("F_2", "CA"): 90, ("G_1", "CA"): 70, ("G_2", "CA"): 20}
    base = to_spark(spark, random_series(21, lengths))
    extra = {c: F.lit("x") for c in ("id", "dept_id", "cat_id", "state_id", "d", "event_type_1")}
    return base.withColumns(extra)


@pytest.mark.parametrize("forecaster", [Baseline(), PerSeries(), Moments(), Pooled({"maxIter": 2, "maxDepth": 3})])
def test_whole_run_can_be_repeated(spark, fact, store, tmp_path, forecaster):
    args = dict(store_id="CA", parameters={"a": 1})
    first = run_backtest(spark, fact, store, forecaster, "v1.0", str(tmp_path / "cp"), **args)
    again = run_backtest(spark, fact, store, forecaster, "v1.0", str(tmp_path / "cp"), **args)
    assert first == again == (84, 84)  # three series are long enough
    assert store.forecasts().count() == store.sales_history().count() == 84
    run = store.model_runs().collect()
    assert len(run) == 1 and run[0].is_active and run[0].num_items == 3
    tiles = serving.item_tiles(store.forecasts(), store.sales_history(), store.model_runs())
    by_item = tiles.agg({"mae": "avg", "rmse": "avg"}).first()
    assert run[0].mae == pytest.approx(by_item["avg(mae)"])
    assert run[0].rmse == pytest.approx(by_item["avg(rmse)"])


def test_publishing_restarts_from_checkpoints(spark, fact, store, tmp_path):
    paths = checkpoint_backtest(spark, fact, Baseline(), "v9", str(tmp_path / "cp"))
    assert read_forecast_checkpoint(spark, paths.forecasts).count() == 84
    assert read_metrics(spark, paths.metrics).first().mae > 0
    # an earlier attempt died after writing some forecasts
    store.write_forecasts(predictions(spark), "v9")
    assert publish(spark, store, "v9", paths, "CA") == (84, 84)
    assert store.forecasts().count() == 84


def test_run_rejects_bad_facts(spark, fact, store, tmp_path):
    with pytest.raises(ValueError, match="missing columns: sales"):
        run_backtest(spark, fact.drop("sales"), store, Baseline(), "v1", str(tmp_path), "CA")
    with pytest.raises(ValueError, match="duplicate key"):
        run_backtest(spark, fact.union(fact), store, Baseline(), "v1", str(tmp_path), "CA")


# -- one visible step ------------------------------------------------------------------


class Crash(Exception):
    pass


def crashing(store, after):
    """The store fails after so many steps of a change."""
    left = [after]

    def step(name):
        if left[0] == 0:
            raise Crash(name)
        left[0] -= 1

    store.step = step
    return store


def contents(store):
    """All that readers see, without the times of writing."""
    return tuple(
        sorted(map(repr, t.drop("created_at", "trained_at").collect()))
        for t in (store.forecasts(), store.sales_history(), store.model_runs())
    )


@pytest.mark.parametrize("after", range(4))
def test_a_crash_after_any_step_leaves_old_or_new(spark, fact, tmp_path, after):
    root = str(tmp_path / "store")
    store = ForecastStore(spark, root)
    old = checkpoint_backtest(spark, fact, Baseline(trend=False), "v1", str(tmp_path / "old"))
    new = checkpoint_backtest(spark, fact, Baseline(), "v1", str(tmp_path / "new"))
    publish(spark, store, "v1", old, "CA")
    before = contents(store)
    with pytest.raises(Crash) as at:
        publish(spark, crashing(ForecastStore(spark, root), after), "v1", new, "CA")
    seen = contents(ForecastStore(spark, root))
    finished = str(at.value) == "wrote the snapshot"
    assert (seen != before) == finished == (after == 3)
    assert publish(spark, ForecastStore(spark, root), "v1", new, "CA") == (84, 84)
    again = ForecastStore(spark, root)
    assert contents(again) != before and again.forecasts().count() == 84
    # What the failed attempt wrote is gone.
    listed = {b.batch for n in again._snapshots() for b in again._live_in(n)}
    on_disk = {p.name.removeprefix("batch=") for p in (tmp_path / "store").glob("*/model_version=*/batch=*")}
    assert on_disk == listed


@pytest.mark.parametrize("part", ["forecasts", "history"])
def test_a_failing_job_leaves_the_old_version(spark, fact, store, tmp_path, part):
    paths = checkpoint_backtest(spark, fact, Baseline(), "v1", str(tmp_path / "cp"))
    publish(spark, store, "v1", paths, "CA")
    before = contents(store)
    broken = spark.read.parquet(getattr(paths, part))
    key = "predicted_sales" if part == "forecasts" else "actual_sales"
    broken.withColumn(key, F.nullif(key, F.max(key).over(Window.partitionBy()))).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="NULL in required column"):
        publish(spark, store, "v1", paths._replace(**{part: str(tmp_path / "bad")}), "CA")
    assert contents(store) == before


def test_an_unfinished_snapshot_is_not_read(spark, store, tmp_path):
    store.write_forecasts(predictions(spark), "v1.0")
    before = contents(store)
    number = store.newest()[0]
    unfinished = tmp_path / "store" / "model_runs" / f"snapshot={number + 1}"
    unfinished.mkdir()
    (unfinished / "part-00000.parquet").write_bytes(b"half")
    assert contents(ForecastStore(spark, store.root)) == before
    store.promote("v1.0")
    assert store.newest()[0] == number + 1


def test_snapshots_and_batches_stay_bounded(spark, tmp_path):
    store = ForecastStore(spark, str(tmp_path / "store"), retain=3)
    store.write_forecasts(predictions(spark), "v1.0")
    log(store, "v1.0")
    log(store, "v2.0")
    reader, runs = store.forecasts(), store.model_runs()
    for k in range(2):
        store.write_forecasts(predictions(spark, 10.0 + k), "v1.0")
    assert reader.count() == 3 and {r.predicted_sales for r in reader.collect()} == {1.0, 2.0, 3.0}
    assert runs.count() == 2  # both were opened two changes ago
    for k in range(6):
        store.promote(f"v{k % 2 + 1}.0")
    folders = list((tmp_path / "store" / "model_runs").glob("snapshot=*"))
    assert len(folders) == 3
    assert len(list((tmp_path / "store").glob("forecasts/*/batch=*"))) == 1
    assert store.forecasts().count() == 3 and store.model_runs().count() == 2
    with pytest.raises(ValueError, match="retain"):
        ForecastStore(spark, store.root, retain=0)


# -- appends ---------------------------------------------------------------------------


def days_of(spark, first, n=3, items=("F_0", "F_1")):
    rows = [(i, "CA", first + dt.timedelta(days=k), 1.0) for i in items for k in range(n)]
    return spark.createDataFrame(rows, "item_id string, store_id string, forecast_date date, predicted_sales double")


def test_an_append_reads_only_overlapping_batches(spark, store, monkeypatch):
    read = []
    whole = ForecastStore.read_batches
    monkeypatch.setattr(ForecastStore, "read_batches", lambda self, t, b: read.append([x.batch for x in b]) or whole(self, t, b))
    for month in (1, 2, 3):
        read.clear()
        store.write_forecasts(days_of(spark, dt.date(2016, month, 1)), "v1", mode="append")
        assert len(read) == 1  # its own keys; no stored batch overlaps
    read.clear()
    store.write_forecasts(days_of(spark, dt.date(2016, 2, 4)), "v1", mode="append")
    assert len(read) == 1
    with pytest.raises(ValueError, match="duplicate key"):
        store.write_forecasts(days_of(spark, dt.date(2016, 2, 6)), "v1", mode="append")
    assert [len(b) for b in read[-2:]] == [1, 1]
    # Same days of another item: the extents of items do not meet.
    store.write_forecasts(days_of(spark, dt.date(2016, 1, 1), items=("G_1",)), "v1", mode="append")
    assert store.forecasts().count() == 27
    assert store.forecasts().select("id").distinct().count() == 27


def test_an_append_pushes_its_extent_to_the_files(spark, store, plan_of):
    store.write_forecasts(days_of(spark, dt.date(2016, 1, 1), n=20), "v1")
    change = store.change()
    new = change.live[0]._replace(first_day=dt.date(2016, 1, 5), last_day=dt.date(2016, 1, 6))
    spark.conf.set("spark.sql.maxMetadataStringLength", 5_000)
    plan = plan_of(change.stored_keys(new, change.overlapping(new)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(forecast_date,2016-01-05)" in plan and "LessThanOrEqual(forecast_date,2016-01-06)" in plan


def test_stamps_lie_between_start_and_end(spark, store, fact, tmp_path):
    now = lambda: spark.sql("SELECT current_timestamp()").first()[0]
    start = now()
    run_backtest(spark, fact, store, Baseline(), "v1", str(tmp_path / "cp"), "CA")
    end = now()
    assert all(start <= r.created_at <= end for r in store.forecasts().collect())
    assert start <= store.model_runs().first().trained_at <= end
