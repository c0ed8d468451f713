import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline import session
from shelfline.operators.features import build_features
from shelfline.operators.forecast import baseline_backtest
from shelfline.operators.joins import broadcast_within
from shelfline.operators.split import holdout_split
from shelfline.sources.files import (
    daily_sales_path,
    read_metrics,
    write_metrics,
    write_series_table,
)
from shelfline.sources.jdbc import JdbcStore
from shelfline.sources.star import Star

SF = "/root/testdata/sf0.001"
ENV = {
    "FORECAST_DB_SERVER": "db.example.org",
    "FORECAST_DB_DATABASE": "demand",
    "FORECAST_DB_USER": "writer",
    "FORECAST_DB_PASSWORD": "secret",
}


def test_jdbc_options():
    store = JdbcStore.from_env(ENV)
    assert store.url == (
        "jdbc:sqlserver://db.example.org:1433;databaseName=demand;encrypt=true;"
        "trustServerCertificate=false;"
    )
    assert store.options("forecasts") == {
        "url": store.url,
        "dbtable": "forecasts",
        "user": "writer",
        "password": "secret",
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    }
    with pytest.raises(KeyError):
        JdbcStore.from_env({})


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


def test_cluster_without_shared_dir_is_refused():
    class Settings:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"
        applicationId = "application_1"

        def getConf(self):
            return Settings()

    class Session:
        conf = Settings()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Context.master, Context.applicationId = "local[2]", "local-1"
    assert session.shared_dir(Session()) == session.shared_dir(Session())


def test_store_path_is_lower_case():
    assert daily_sales_path("s3://curated/", "CA_1") == "s3://curated/daily_ca_1"


def test_metrics_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.5, 2.5, None)], "mae double, rmse double, weighted_mae double")
    write_metrics(df, str(tmp_path / "m"))
    assert tuple(read_metrics(spark, str(tmp_path / "m")).first()) == (1.5, 2.5, None)


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, SF)


def test_dense_fact_covers_every_day_once(star):
    demand, fact, span = star.demand(), star.daily_fact(), star.span
    series = demand.select("item_id", "store_id").distinct().count()
    assert fact.count() == series * span.days
    assert fact.select("id", "day_num").distinct().count() == series * span.days
    assert fact.agg({"sales": "sum"}).first()[0] == demand.agg({"sales": "sum"}).first()[0]
    bounds = fact.selectExpr("min(cal_date)", "max(cal_date)", "count_if(cal_date IS NULL)").first()
    assert tuple(bounds) == (span.first, span.last, 0)


def test_size_checked_broadcast(spark, plan_of):
    spark.range(100).createOrReplaceTempView("facts")
    small = spark.range(10).withColumn("x", F.rand())
    facts = spark.table("facts").hint("merge")
    assert "Broadcast" in plan_of(facts.join(broadcast_within(small, 10), "id"))
    assert "Broadcast" not in plan_of(facts.join(broadcast_within(small, 9), "id"))


def test_hot_item_is_summed_whole(spark, tmp_path):
    """A third of all line items on one item, store and day; a part never sold."""
    rng = np.random.default_rng(0)
    n = 9000
    lines = pd.DataFrame(
        {
            "l_partkey": rng.integers(0, 6, n),
            "l_suppkey": rng.integers(0, 4, n),
            "l_quantity": rng.integers(1, 50, n).astype(float),
            "l_shipdate": pd.Timestamp("2000-01-01") + pd.to_timedelta(rng.integers(0, 9, n), "D"),
        }
    )
    lines.loc[: n // 3, ["l_partkey", "l_suppkey"]] = 1
    lines.loc[: n // 3, "l_shipdate"] = pd.Timestamp("2000-01-05")
    tables = {
        "lineitem": lines,
        "part": pd.DataFrame(
            {
                "p_partkey": range(7),
                "p_brand": [f"Brand#{k % 3}" for k in range(7)],
                "p_type": ["X" if k < 4 else "Y" for k in range(7)],
            }
        ),
        "supplier": pd.DataFrame({"s_suppkey": range(4), "s_nationkey": [0, 1, 1, 2]}),
        "nation": pd.DataFrame({"n_nationkey": range(3), "n_regionkey": [0, 0, 1]}),
        "region": pd.DataFrame({"r_regionkey": range(2), "r_name": ["EAST", "WEST"]}),
    }
    for name, table in tables.items():
        table.to_parquet(tmp_path / f"{name}.parquet", coerce_timestamps="us")
    star = Star(spark, str(tmp_path))
    assert star.span.days == 9
    joined = (
        lines.merge(tables["part"], left_on="l_partkey", right_on="p_partkey")
        .merge(tables["supplier"], left_on="l_suppkey", right_on="s_suppkey")
        .merge(tables["nation"], left_on="s_nationkey", right_on="n_nationkey")
        .merge(tables["region"], left_on="n_regionkey", right_on="r_regionkey")
    )
    joined["item_id"] = joined["p_type"] + "_" + joined["p_brand"].str[6:]
    want = joined.groupby(["item_id", "r_name", "l_shipdate"])["l_quantity"].sum()
    fact = star.daily_fact(buckets=4).collect()
    got = {(r.item_id, r.store_id, pd.Timestamp(r.cal_date)): r.sales for r in fact}
    series = {(i, s) for i, s, _ in want.index}
    assert len(got) == len(fact) == 9 * len(series)
    for key, sales in got.items():
        assert sales == want.get(key, 0)


def test_line_items_are_pruned_and_not_shuffled(star, plan_of):
    plan = plan_of(star.demand())
    assert (
        "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,"
        "l_shipdate:timestamp_ntz>" in plan
    )
    assert plan.count("Exchange hashpartitioning") == 1  # the aggregation's
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan_of(star.daily_fact())


def test_bucketed_fact_needs_no_exchange(spark, star, tmp_path, plan_of):
    placed = star.daily_fact(buckets=8)
    assert plan_of(placed).count("Exchange hashpartitioning") == 2  # daily sums, then by item
    write_series_table(placed, "fact_under_test", str(tmp_path / "fact"), 8, placed=True)
    for store in (tmp_path / "fact").glob("store_id=*"):
        assert len(list(store.glob("*.parquet"))) <= 8
    fact = spark.table("fact_under_test")
    split = holdout_split(build_features(fact))
    for df in (split, baseline_backtest(fact), fact.groupBy("store_id", "item_id").count()):
        assert "Exchange" not in plan_of(df)
    plan = plan_of(build_features(fact.where("store_id = 'ASIA'")))
    assert "PartitionFilters: [isnotnull(store_id" in plan
    spark.sql("DROP TABLE fact_under_test")
