"""Registered queries against their SQL equivalents, at the smallest scale."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from shelfline.oracles import all_oracles
from shelfline.queries import all_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: str(v)[:10] if hasattr(v, "year") else v)
        elif str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].dt.strftime("%Y-%m-%d")
        elif pd.api.types.is_numeric_dtype(df[c].dtype):
            df[c] = df[c].astype(float)
    return df.sort_values(list(df.columns), ignore_index=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    got = all_queries()[name](spark, SF).toPandas()
    want = db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    pd.testing.assert_frame_equal(
        canonical(got), canonical(want), check_dtype=False, rtol=0, atol=2e-6
    )


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(ORACLES)))
def test_learned_models_run(spark, name):
    rows = all_queries()[name](spark, SF).toPandas()
    assert len(rows) and rows["mae"].notna().all() and (rows["mae"] <= rows["rmse"] + 1e-9).all()


def test_the_contract_holds_every_query():
    assert set(ORACLES) <= set(all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("hidden", ["tiktoken", "sentencepiece", "tokenizers", "xxhash", "shelfline.llm"])
def test_the_entry_works_where_text_libraries_are_missing(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from shelfline.queries import all_queries\n"
        "assert set(all_queries()) <= set(e.queries()) and e.oracle_sql()\n"
    )
    root = os.path.dirname(os.path.abspath(contract.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "item_id",
        "store_id",
        "forecast_days",
        "avg_predicted_sales",
        "first_date",
        "last_date",
    ]


def test_no_query_plans_a_cross_join(spark, plan_of):
    for name, query in all_queries().items():
        plan = plan_of(query(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, name
