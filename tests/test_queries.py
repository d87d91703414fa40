"""Every query with SQL beside it gives the same rows in DuckDB; the others run."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TALLYLOOM_TEST_DATA", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(DATA):
        path = f"{DATA}/{f}"
        c.execute(f"create view {f.split('.')[0]} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(cell(r[c]) for c in columns) for r in df.collect())
    rel = db.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = Counter(tuple(cell(r[i]) for i in at) for r in rel.fetchall())
    assert got == want
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, DATA).count() >= 0
    spark.catalog.clearCache()


def test_entry(spark):
    assert entry.entry(spark).columns == ["channel", "d", "score"]
