"""Paged sources over landed pages, pacing, completeness, lookups and databases."""

from __future__ import annotations

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loomwright.sinks.files import fresh_path
from loomwright.sources import paged, stores

LANDED = "loomwright.sources.paged:landed_page"


def test_pace_slows_after_refusals_and_quickens_after_three_successes():
    """A clock of its own: the pauses asked for."""
    pace = paged.Pace()
    met = [False, False, False, False, True, True, True, True, True, False, False, False, False]
    assert [pace.after(m) for m in met] == [2, 2, 1.5, 2, 3, 4, 5, 5, 5, 2, 2, 1.5, 2]
    assert paged.Pace(base=1.2).after(False) == 1.2 and [paged.Pace(1.2, successes=2).after(False)] == [1.0]
    slept = []
    calls = iter([paged.Busy, paged.Busy, [1]])

    def call():
        x = next(calls)
        if x is paged.Busy:
            raise x
        return x

    assert paged.with_retries(call, pause=3, sleep=slept.append) == [1] and slept == [3, 6]


def test_pages_refused_at_random_lose_no_row(spark):
    rows = paged.read_paged(spark, "id long, slice string", fetch="tests.remote:moody_page", page=5, slices="a,b,c", strides=2, pause=0.001, interval=0.002)
    assert sorted((r["slice"], r["id"]) for r in rows.collect()) == [(s, k) for s in "abc" for k in range(25)]


@pytest.mark.parametrize("size", [0, 1, 9, 10, 11, 200])
@pytest.mark.parametrize("strides", [1, 3])
def test_landed_pages_are_read_to_a_short_one(spark, size, strides):
    path = paged.land_pages(spark.range(size).select("id", (F.col("id") * 2).alias("v")), ["id"], 10)
    rows = paged.read_paged(spark, "id long, v long", fetch=LANDED, folder=path, page=10, slices="all", strides=strides)
    assert sorted(map(tuple, rows.collect())) == [(k, 2 * k) for k in range(size)]


def test_a_dropped_page_makes_a_scan_fail(spark):
    path = paged.land_pages(spark.range(95).select("id", F.when(F.col("id") < 50, "a").otherwise("b").alias("s")), ["id"], 10, F.col("s"))
    scan = lambda: paged.complete_scan(paged.read_paged(spark, "id long, _slice string, _total long", fetch=LANDED, folder=path, page=10, slices="a,b"), ["a", "b"], F.col("id") % 5 == 0)
    assert sorted(r["id"] for r in scan().collect()) == [k for k in range(95) if k % 5]
    for file in glob.glob(f"{path.removeprefix('file:')}/slice=b/page=4/*"):
        os.remove(file)
    with pytest.raises(paged.Incomplete, match="90 of 95"):
        scan()
    for file in glob.glob(f"{path.removeprefix('file:')}/slice=a/page=*/*"):
        os.remove(file)
    with pytest.raises(paged.Incomplete, match="no page of .'a'."):
        scan()


def test_lookups_find_what_the_table_has(spark):
    path = fresh_path(spark, "details")
    spark.range(0, 5000, 2).select("id", (F.col("id") + 1).alias("v")).repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(path)
    keys = spark.createDataFrame([(k,) for k in [*range(0, 700, 3), None, 4998, 9999, 3, 3]], "id long")
    found = paged.batched_lookup(keys, "id", path, "id long, v long", 50)
    assert sorted(map(tuple, found.collect())) == [(k, k + 1) for k in [*range(0, 700, 6), 4998]]
    assert paged.batched_lookup(keys.limit(0), "id", path, "id long, v long").count() == 0


def test_a_database_is_read_in_ranges_of_its_own_bounds(spark):
    url, driver = f"jdbc:derby:{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.range(100, 400).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("V"), F.lit("x").alias("WIDE"))
    rows.write.format("jdbc").option("url", url).option("driver", driver).option("dbtable", "T").save()
    table = stores.read_database(spark, url, "T", "ID", 3, driver=driver)
    assert table.rdd.getNumPartitions() == 3 and min(table.rdd.glom().map(len).collect()) > 90 and table.count() == 300
    asked = table.where("V = 3").select("ID")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(V,3)" in plan and "WIDE" not in plan.split("ReadSchema")[-1]
    assert sorted(r["ID"] for r in asked.collect()) == [k for k in range(100, 400) if k % 7 == 3]
    assert stores.read_database(spark, url, "(SELECT * FROM T WHERE ID < 0) x", "ID", 3, driver=driver).count() == 0


def test_large_tables_are_numbered_in_more_tasks_than_the_session_has(spark, monkeypatch):
    """Ranges and pages were as many as the session's partitions, however many rows there were."""
    from loomwright.operators import ranking

    monkeypatch.setattr(ranking, "tasks_for", lambda df: 23)
    rows = ranking.chunked(spark.range(500).selectExpr("id", "id % 2 AS s"), ["s"], ["id"], 10)
    assert ", 23)" in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rows.collect())) == [(k, k % 2, k // 2 // 10) for k in range(500)]
