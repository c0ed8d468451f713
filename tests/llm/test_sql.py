"""Queries of the text operators against their SQL, at the smallest scale."""

import duckdb
import pytest

from shelfline.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_same_as_sql(spark, db, name):
    got = llm_queries()[name](spark, SF).toPandas()
    want = db.execute(llm_oracles()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want) > 0
    as_text = lambda df: df[columns].astype(object).where(df[columns].notna(), None).map(
        lambda v: str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    )
    ours, theirs = (as_text(df).sort_values(columns, ignore_index=True) for df in (got, want))
    assert ours.equals(theirs)


def test_every_query_is_registered_once():
    names = list(llm_queries())
    assert len({n.split("_")[0] for n in names}) == len(names)
    assert set(llm_oracles()) <= set(names)
