"""Every core query with SQL against DuckDB on the smallest tables."""

import glob
import os

import pytest

from corpusloom.plans.registry import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in data]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
