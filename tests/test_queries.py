"""Every registered query with SQL, against DuckDB at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
ORACLES = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def same(value):
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(tuple(same(r[i]) for i in places) for r in result.fetchall())
    assert sorted(tuple(same(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
