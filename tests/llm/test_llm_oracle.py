"""Queries with SQL against DuckDB on the smallest tables."""

import glob
import os

import pytest

from corpusloom.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = QUERIES[name](spark, DATA)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in result.fetchall())
