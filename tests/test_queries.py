"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from loomwright.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_the_rows_of_its_sql(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    wanted = duck.execute(SQL[name])
    names = [d[0] for d in wanted.description]
    assert columns == sorted(names)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in found.collect())
    assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in wanted.fetchall())


def test_entry_forecasts(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["shop", "sku", "spu", "month", "qty", "method", "trend"]
    assert set(e.oracle_sql()) <= set(e.queries())
