import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.operators import reshape
from shelfline.plans.etl import transform_sales_to_long
from shelfline.schemas import DAILY_SALES, ID_COLUMNS
from shelfline.sources.files import (
    read_calendar,
    read_daily_sales,
    read_sales_wide,
    write_parquet,
)

SALES = """id,item_id,dept_id,store_id,cat_id,state_id,d_1,d_2,d_3
F_1_CA,F_1,F,CA,F,C,3,,0
F_1_TX,F_1,F,TX,F,T,1,x,7
G_2_CA,G_2,G,CA,G,C,0,5,6
"""
CALENDAR = """date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1
2016-01-01,1,Friday,7,1,2016,d_1,NewYear,National
2016-01-02,1,Saturday,1,1,2016,d_2,,
not-a-date,1,Sunday,?,1,2016,d_4,,
"""


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "sales_train_evaluation.csv").write_text(SALES)
    (tmp_path / "calendar.csv").write_text(CALENDAR)
    return str(tmp_path)


def test_sales_are_read_as_strings(spark, raw):
    df = read_sales_wide(spark, raw)
    assert {t for _, t in df.dtypes} == {"string"}
    assert reshape.day_columns(df) == ["d_1", "d_2", "d_3"]


def test_calendar_types_and_unparsable_values(spark, raw):
    rows = read_calendar(spark, raw).collect()
    assert rows[0].asDict() == {
        "d": "d_1",
        "cal_date": dt.date(2016, 1, 1),
        "wday": 7,
        "month": 1,
        "year": 2016,
        "event_name_1": "NewYear",
        "event_type_1": "National",
    }
    assert rows[1].event_name_1 is None
    assert rows[2].cal_date is None and rows[2].wday is None


def test_unpivot_keeps_null_and_unparsable_cells(spark, raw):
    long = reshape.wide_to_long(read_sales_wide(spark, raw))
    assert long.columns == [*ID_COLUMNS, "d", "sales"]
    cells = {(r.id, r.d): r.sales for r in long.collect()}
    assert cells == {
        ("F_1_CA", "d_1"): 3,
        ("F_1_CA", "d_2"): None,
        ("F_1_CA", "d_3"): 0,
        ("F_1_TX", "d_1"): 1,
        ("F_1_TX", "d_2"): None,
        ("F_1_TX", "d_3"): 7,
        ("G_2_CA", "d_1"): 0,
        ("G_2_CA", "d_2"): 5,
        ("G_2_CA", "d_3"): 6,
    }


def test_unpivot_needs_no_shuffle(spark, raw, plan_of):
    assert "Exchange" not in plan_of(reshape.wide_to_long(read_sales_wide(spark, raw)))


def test_unpivot_without_day_columns_is_an_error(spark):
    df = spark.createDataFrame([tuple("abcdef")], ID_COLUMNS)
    with pytest.raises(ValueError, match="no d_"):
        reshape.wide_to_long(df)


def test_unpivot_quotes_column_names(spark):
    df = spark.createDataFrame([(*"abcdef", "4", "5")], [*ID_COLUMNS, "d_1.x", "d_2`y"])
    got = {r.d: r.sales for r in reshape.wide_to_long(df).collect()}
    assert got == {"d_1.x": 4, "d_2`y": 5}


def test_day_number(spark):
    df = spark.createDataFrame([("d_1",), ("d_1913",), ("x",), (None,)], "d string")
    assert [r.day_num for r in reshape.add_day_number(df).collect()] == [1, 1913, None, None]


def test_store_filter_reaches_the_scan(spark, raw, plan_of):
    df = reshape.filter_by_store(read_sales_wide(spark, raw), "CA")
    assert sorted(r.id for r in df.collect()) == ["F_1_CA", "G_2_CA"]
    assert "EqualTo(store_id,CA)" in plan_of(df)


def test_first_days(spark, raw):
    out = reshape.first_days(read_sales_wide(spark, raw), 2)
    assert out.columns == [*ID_COLUMNS, "d_1", "d_2"]
    assert dict(out.dtypes)["d_1"] == "int"
    assert {r.id: r.d_2 for r in out.collect()} == {"F_1_CA": None, "F_1_TX": None, "G_2_CA": 5}


@pytest.mark.parametrize("file_rows", [None, 1, 4])
def test_pipeline_and_round_trip(spark, raw, tmp_path, file_rows):
    long = transform_sales_to_long(
        spark, raw, "CA", calendar_path=raw, file_rows=file_rows
    )
    assert long.columns == DAILY_SALES.names
    out = str(tmp_path / "curated")
    write_parquet(long, out, ["store_id"], rebalance=file_rows is None)
    back = read_daily_sales(spark, out)
    assert back.schema == DAILY_SALES
    rows = {(r.id, r.day_num): r for r in back.collect()}
    assert len(rows) == 6 and {r.store_id for r in rows.values()} == {"CA"}
    assert rows["G_2_CA", 2].sales == 5 and rows["G_2_CA", 2].cal_date == dt.date(2016, 1, 2)
    # a day missing from the calendar keeps its row
    assert rows["G_2_CA", 3].sales == 6 and rows["G_2_CA", 3].cal_date is None


def test_pipeline_options(spark, raw):
    plain = transform_sales_to_long(spark, raw, add_day_num=False)
    assert plain.columns == [*ID_COLUMNS, "d", "sales"]
    assert plain.count() == 9


def test_partition_values_stay_strings(spark, tmp_path):
    df = spark.createDataFrame(
        [("i", "7", "d", "01", "c", "s", "d_1", 1, 1, None, 1, 1, 2016, None, None)], DAILY_SALES
    )
    write_parquet(df, str(tmp_path / "p"), ["store_id", "item_id"])
    row = read_daily_sales(spark, str(tmp_path / "p")).first()
    assert (row.store_id, row.item_id) == ("01", "7")


def test_store_clustering_bounds_files(spark, tmp_path):
    rows = [(f"{i}", f"I_{i}", "D", "BIG" if i % 3 else "TINY", "C", "S", "1") for i in range(300)]
    wide = spark.createDataFrame(rows, [*ID_COLUMNS, "d_1"]).repartition(8)
    placed = reshape.cluster_by_store(wide, 100)
    out = tmp_path / "p"
    write_parquet(reshape.wide_to_long(placed), str(out), ["store_id"], rebalance=False)
    assert placed.columns == wide.columns and placed.count() == 300
    for store, most in (("BIG", 2), ("TINY", 1)):
        assert 1 <= len(list((out / f"store_id={store}").glob("*.parquet"))) <= most


def test_large_store_uses_tasks_in_proportion(spark):
    rows = [(f"{i}", f"I_{i}", "D", "BIG" if i % 10 else "TINY", "C", "S", "1") for i in range(1000)]
    wide = spark.createDataFrame(rows, [*ID_COLUMNS, "d_1"])
    placed = reshape.cluster_by_store(wide, 10).withColumn("task", F.spark_partition_id())
    used = {r.store_id: r.n for r in placed.groupBy("store_id").agg(F.countDistinct("task").alias("n")).collect()}
    assert used["BIG"] > 40 and used["TINY"] <= 10


def test_numbers_as_text(spark):
    texts = ["3.0", "3", "-2.9", "1e2", "junk", "", "NaN", "1e99", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(reshape.whole_number(F.col("t"))).collect()]
    assert got == [3, 3, -2, 100, None, None, None, None, None]


def test_peek_and_slice(spark, raw):
    fact = transform_sales_to_long(spark, raw, calendar_path=raw)
    assert [tuple(r) for r in reshape.item_slice(fact, "G_2", "CA").collect()] == [
        (1, 0),
        (2, 5),
        (3, 6),
    ]
    assert [(r.id, r.day_num) for r in reshape.peek(fact, 4).collect()] == [
        ("F_1_CA", 1),
        ("F_1_CA", 2),
        ("F_1_CA", 3),
        ("F_1_TX", 1),
    ]
