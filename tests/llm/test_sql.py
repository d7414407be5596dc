"""The queries that have SQL, against it."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from loomwright.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_are_those_of_the_sql(spark, name):
    duck = duckdb.connect()
    for file in glob.glob(f"{DATA}/*.parquet"):
        duck.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    wanted = duck.execute(SQL[name])
    names = [d[0] for d in wanted.description]
    assert columns == sorted(names)
    assert sorted(tuple(map(str, (r[c] for c in columns))) for r in found.collect()) == sorted(tuple(str(r[names.index(c)]) for c in columns) for r in wanted.fetchall())
