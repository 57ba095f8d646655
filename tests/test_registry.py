"""Every query against its SQL twin, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from registry import all_queries
from tools.check import TABLES, rows_of

FOLDER = driver.SMALLEST
QUERIES, SQL = all_queries().queries, all_queries().sql

pytestmark = pytest.mark.skipif(
    not os.path.isdir(FOLDER), reason="the driver's tables are not here"
)


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, twin, name):
    df = QUERIES[name](spark, FOLDER)
    want = twin.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
