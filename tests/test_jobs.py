import datetime as dt

import numpy as np
import pytest

from shelfline.__main__ import main
from shelfline.models.per_series import backtest_per_series
from shelfline.operators import serving
from shelfline.operators.features import build_features
from shelfline.operators.split import holdout_split
from shelfline.schemas import ID_COLUMNS
from shelfline.sources.curated import read_curated, table_name, write_curated
from shelfline.store import ForecastStore

DAYS = 70


@pytest.fixture
def raw(tmp_path):
    rng = np.random.default_rng(0)
    lines = [",".join([*ID_COLUMNS, *(f"d_{k}" for k in range(1, DAYS + 1))])]
    for store in ("CA_1", "TX_1"):
        for item in ("F_1", "F_2", "G_1"):
            units = map(str, rng.integers(0, 30, DAYS))
            lines.append(",".join([f"{item}_{store}", item, "D", store, "C", store[:2], *units]))
    (tmp_path / "sales_train_evaluation.csv").write_text("\n".join(lines) + "\n")
    lines = ["date,wday,month,year,d,event_name_1,event_type_1"]
    for k in range(DAYS):
        day = dt.date(2016, 1, 1) + dt.timedelta(days=k)
        lines.append(f"{day},{(day.weekday() + 2) % 7 + 1},{day.month},{day.year},d_{k + 1},,")
    (tmp_path / "calendar.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


@pytest.mark.parametrize("store_id, items", [("CA_1", 3), ("ALL", 6)])
def test_etl_then_backtest(spark, raw, tmp_path, capsys, store_id, items):
    curated, root = str(tmp_path / "curated"), str(tmp_path / "store")
    where = ["--curated", curated, "--store-id", store_id]
    main(["etl", "--raw", raw, *where])
    for version, model in (("v1.0", "baseline"), ("v2.0", "least-squares")):
        args = ["--store", root, "--model-version", version, "--model", model, "--horizon", "7"]
        main(["backtest", *where, *args])
    assert f"version v2.0: {items * 7} forecasts" in capsys.readouterr().out
    store = ForecastStore(spark, root)
    run = serving.model_status(store.model_runs()).first()
    assert (run.model_version, run.store_id, run.horizon_days) == ("v2.0", store_id, 7)
    latest = serving.latest_forecasts(store.forecasts(), store.model_runs())
    assert latest.count() == items * 7
    last = dt.date(2016, 1, 1) + dt.timedelta(days=DAYS - 1)
    assert latest.agg({"date": "max"}).first()[0] == str(last)


def forget_tables(spark):
    """As in another session: the catalog is empty, the files are there."""
    for t in spark.catalog.listTables():
        if t.name.startswith("daily_sales_"):
            spark.sql(f"DROP TABLE {t.name}")


def test_the_next_job_finds_the_layout(spark, raw, tmp_path, plan_of):
    curated = tmp_path / "curated"
    main(["etl", "--raw", raw, "--curated", str(curated)])
    forget_tables(spark)
    fact = read_curated(spark, str(curated / "daily_all"))
    plan = plan_of(backtest_per_series(holdout_split(build_features(fact), 7)))
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "PartitionFilters: [isnotnull(store_id" in plan_of(fact.where("store_id = 'CA_1'"))
    rows = fact.toPandas()
    assert len(rows) == 6 * DAYS and rows["sales"].notna().all() and rows["cal_date"].notna().all()


def test_a_new_fact_replaces_the_old_one_when_complete(spark, raw, tmp_path):
    root = str(tmp_path / "curated" / "daily_all")
    main(["etl", "--raw", raw, "--curated", str(tmp_path / "curated")])
    first = read_curated(spark, root)
    broken = first.selectExpr("* EXCEPT (sales)", "CAST(raise_error('lost') AS int) AS sales")
    with pytest.raises(Exception, match="lost"):
        write_curated(broken.select(first.columns).repartition(2, "item_id"), root, 2)
    forget_tables(spark)
    assert read_curated(spark, root).count() == 6 * DAYS
    for k in range(3):
        write_curated(read_curated(spark, root).where(f"day_num > {k}").repartition(3, "item_id"), root, 3)
    assert read_curated(spark, root).count() == 6 * (DAYS - 2)
    names = [p.name.split("-")[0] for p in (tmp_path / "curated" / "daily_all").iterdir()]
    assert names.count("data") == names.count("record") == 2
    with pytest.raises(FileNotFoundError):
        read_curated(spark, str(tmp_path / "nothing"))
    assert table_name("a/b c").isidentifier()


def test_the_etl_job_tells_what_casts_lost(spark, raw, tmp_path, capsys):
    text = (tmp_path / "sales_train_evaluation.csv").read_text().splitlines()
    cells = text[1].split(",")
    cells[6:9] = ["n/a", "", "2.0"]
    (tmp_path / "sales_train_evaluation.csv").write_text("\n".join([text[0], ",".join(cells), *text[2:]]))
    main(["etl", "--raw", raw, "--curated", str(tmp_path / "c")])
    out = capsys.readouterr().out
    assert f"sales.sales: 1 of {6 * DAYS - 1} values lost" in out
    assert f"calendar.cal_date: 0 of {DAYS} values lost" in out
