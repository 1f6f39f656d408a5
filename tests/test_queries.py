"""Every registered query against its SQL twin, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", list(queries()))
def test_query(key, spark, duck):
    df = queries()[key](spark, SF)
    got = df.collect()
    sql = oracle_sql().get(key)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(got, df.columns) == rows_of(cur.fetchall(), names)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
