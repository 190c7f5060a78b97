"""Every named query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    want, want_columns = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert columns == want_columns
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())
