"""Every query with SQL must give the SQL's rows; all others must run."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

from tests.conftest import DATA

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NaT or v != v:
        return "null"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(round(float(v), 6))
    return str(v)


def normal(df):
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQL))
def test_same_rows_as_sql(spark, con, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL and not n.startswith("p")))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
