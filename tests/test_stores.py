"""Sinks, sources and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomwright.sinks import merge
from loomwright.sinks.files import fresh_path, replace_folder
from loomwright.sources import paged

WANTED = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_busy_pages_are_tried_again():
    calls = []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise paged.Busy
        return [1]

    assert paged.with_retries(call, pause=0) == [1] and len(calls) == 3
    with pytest.raises(paged.Busy):
        paged.with_retries(lambda: (_ for _ in ()).throw(paged.Busy()), tries=2, pause=0)


@pytest.mark.parametrize("told", [{}, {"total": 25}, {"total": 20}, {"total": 7}, {"total": 60}])
def test_pages_are_read_to_a_short_one(spark, told):
    """Whatever number of rows the remote side tells, all are read once."""
    rows = paged.read_paged(spark, "id long, slice string", fetch="tests.remote:demo_page", page=10, pages_per_task=1, slices="a,b", **told)
    assert sorted((r["slice"], r["id"]) for r in rows.collect()) == [(s, k) for s in "ab" for k in range(25)]


def test_schemas_are_checked(spark):
    rows = spark.createDataFrame([(1, "x")], "part int, extra string")
    with pytest.raises(ValueError, match="unexpected"):
        merge.evolve(rows, WANTED, {"part": "id"})
    assert merge.check_schema(merge.evolve(rows, WANTED, {"part": "id"}, extra="drop"), WANTED).collect()[0]["name"] is None
    with pytest.raises(ValueError, match="differ"):
        merge.check_schema(rows, WANTED)


def test_size_is_guarded_not_cut(spark):
    assert merge.guarded_size(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError, match="more than 4"):
        merge.guarded_size(spark.range(5), 4)


def test_range_replace_drops_slices_that_vanish(spark):
    old = spark.createDataFrame([(1, "a"), (5, "b"), (6, "c")], "d long, v string")
    new = spark.createDataFrame([(6, "n")], "d long, v string")
    assert {(r["d"], r["v"]) for r in merge.replace_range(old, new, F.col("d") >= 5).collect()} == {(1, "a"), (6, "n")}


def test_upsert_keeps_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, owner string, q long")
    new = spark.createDataFrame([(2, "z", 9), (3, "y", 8)], "k long, owner string, q long")
    assert {tuple(r) for r in merge.upsert(old, new, ["k"], keep=["owner"]).collect()} == {(1, "a", 1), (2, "b", 9), (3, "y", 8)}
    twice = new.unionByName(spark.createDataFrame([(3, "y", 5), (2, "a", 10)], "k long, owner string, q long"))
    assert sorted(map(tuple, merge.upsert(old, twice, ["k"], keep=["owner"]).collect())) == [(1, "a", 1), (2, "b", 9), (3, "y", 8)]
    assert sorted(map(tuple, merge.upsert(old, twice, ["k"]).collect())) == [(1, "a", 1), (2, "z", 9), (3, "y", 8)]
    assert {tuple(r) for r in merge.last_wins(old.unionByName(new), ["k"], "q").collect()} == {(1, "a", 1), (2, "z", 9), (3, "y", 8)}


def test_folder_is_replaced_by_what_is_read_from_it(spark):
    path = fresh_path(spark, "swap")
    replace_folder(spark.range(10), path)
    replace_folder(spark.read.parquet(path).where("id < 3"), path)
    assert spark.read.parquet(path).count() == 3
