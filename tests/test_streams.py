"""Streams: any batches, any order, restarts, late and repeated events."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomwright.sinks.files import fresh_path
from loomwright.streaming import events as e

WANTED = {
    e.write_slices: "SELECT event_id, to_date(ts) AS day, event_type FROM events",
    e.write_daily_counts: "SELECT to_date(ts) AS day, event_type, count(*) AS n, sum(bigint(round(value * 100))) AS cents FROM events GROUP BY ALL",
    e.write_changes: "SELECT user_id, count(*) AS n, count_if(was <> event_type) AS changed FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events) GROUP BY user_id",
}


def rows_of(spark, write, target, columns):
    found = e.latest_changes(spark, target) if write is e.write_changes else spark.read.parquet(target)
    return sorted(map(str, map(tuple, found.select(columns).collect())))


@pytest.mark.parametrize("write", WANTED, ids=lambda w: w.__name__)
def test_a_stop_between_write_and_commit(spark, small, write, monkeypatch):
    """The second batch is written and not committed; the next run tries it again and reads only what is left, then new files."""
    path, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    rows = spark.read.parquet(f"{small}/events.parquet").withColumn("part", F.pmod(F.hash("event_id"), F.lit(4)))
    for k in range(3):
        rows.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
    run = e._run

    def stopping(stream, mode, each, where):
        def then_fail(batch, number):
            each(batch, number)
            if number == 1:
                raise RuntimeError("stopped after the write")

        return run(stream, mode, then_fail, where)

    monkeypatch.setattr(e, "_run", stopping)
    with pytest.raises(Exception, match="stopped after the write"):
        write(e.event_stream(spark, path, 1), target, checkpoint)
    monkeypatch.setattr(e, "_run", run)
    again = write(e.event_stream(spark, path, 1), target, checkpoint)
    assert [p.batch for p in again] == [1, 2]
    rows.where("part = 3").drop("part").coalesce(1).write.mode("append").parquet(path)
    last = write(e.event_stream(spark, path, 1), target, checkpoint)
    assert [p.batch for p in last] == [3] and last[0].rows == rows.where("part = 3").count()
    assert write(e.event_stream(spark, path, 1), target, checkpoint) == []
    rows.createOrReplaceTempView("events")
    wanted = spark.sql(WANTED[write])
    assert rows_of(spark, write, target, wanted.columns) == sorted(map(str, map(tuple, wanted.collect())))


def test_twenty_batches_of_changes(spark, small):
    """A file a batch, in no order of time; a batch reads the slots of its own events and no others."""
    path, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    rows = spark.read.parquet(f"{small}/events.parquet").withColumn("user_id", F.when(F.col("user_id") % 3 == 0, 1).otherwise(F.col("user_id")).cast("long"))  # a hot user
    rows.repartition(20, F.hash("event_id")).write.parquet(path)
    done = e.write_changes(e.event_stream(spark, path, 1), target, checkpoint)
    assert len(done) == 20
    rows.createOrReplaceTempView("events")
    wanted = spark.sql(WANTED[e.write_changes])
    assert rows_of(spark, e.write_changes, target, wanted.columns) == sorted(map(str, map(tuple, wanted.collect())))
    slots = spark.read.parquet(f"{checkpoint}/state/slots").groupBy("batch").count().collect()
    assert sum(r["count"] for r in slots) <= rows.count()  # summaries made follow the events, not batches times history
    e.compact_changes(spark, checkpoint)
    late = [(10**9, dt.datetime(2024, 1, 3, 1, 2), 1, "late", 1.0, None)]
    spark.createDataFrame(late, e.SCHEMA).coalesce(1).write.mode("append").parquet(path)
    assert [p.rows for p in e.write_changes(e.event_stream(spark, path, 1), target, checkpoint)] == [1]
    rows.unionByName(spark.createDataFrame(late, e.SCHEMA)).createOrReplaceTempView("events")
    assert rows_of(spark, e.write_changes, target, wanted.columns) == sorted(map(str, map(tuple, spark.sql(WANTED[e.write_changes]).collect())))


def _events(spark, rows, path):
    spark.createDataFrame([(k, t, u, kind, 1.0, None) for k, t, u, kind in rows], e.SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_repeated_moved_and_nameless_events(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    path, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "checkpoint"))
    _events(spark, [(1, day(1), 7, "a"), (1, day(1), 7, "a"), (2, day(2), 7, "b"), (None, day(2), 8, "x"), (None, day(2), 8, "x"), (3, day(5), 7, "c")], path)
    e.write_slices(e.event_stream(spark, path), target, checkpoint)
    read = lambda: sorted((r["event_id"] or 0, r["day"].day, r["event_type"]) for r in spark.read.parquet(target).collect())
    assert read() == [(0, 2, "x"), (0, 2, "x"), (1, 1, "a"), (2, 2, "b"), (3, 5, "c")]
    kept = set(f for f in spark.read.parquet(target).inputFiles() if "day=2024-01-02" in f)
    _events(spark, [(3, day(4), 7, "c"), (1, day(1), 7, "d")], path)
    e.write_slices(e.event_stream(spark, path), target, checkpoint)
    assert read() == [(0, 2, "x"), (0, 2, "x"), (1, 1, "d"), (2, 2, "b"), (3, 4, "c")]
    assert kept <= set(spark.read.parquet(target).inputFiles())  # a day without news keeps its file
    target, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "checkpoint")
    other = fresh_path(spark, "in")
    _events(spark, [(1, day(1), 7, "a"), (1, day(1), 7, "a"), (None, day(1, 1), 7, "b"), (None, day(1, 1), 7, "b"), (4, day(3), 7, "b"), (5, day(1), None, "z")], other)
    e.write_changes(e.event_stream(spark, other), target, checkpoint)
    _events(spark, [(6, day(2), 7, "c"), (1, day(1), 7, "a"), (7, day(1), None, "y")], other)
    e.write_changes(e.event_stream(spark, other), target, checkpoint)
    assert {r["user_id"]: (r["n"], r["changed"]) for r in e.latest_changes(spark, target).collect()} == {7: (5, 3), None: (2, 1)}


def test_a_landed_part_has_a_file_for_each_task_that_reads_the_table(spark, tmp_path, monkeypatch):
    """Four tasks held a quarter of all events each, however many there were."""
    from loomwright.queries import streams
    from loomwright.sinks.merge import one_a_key

    rows = spark.range(0, 4000, 1, 12).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts", "id % 7 AS user_id", "'a' AS event_type", "1.0D AS value", "'{}' AS props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    paths, real = [], streams.s.event_stream
    monkeypatch.setattr(streams.s, "event_stream", lambda spark, path, files: paths.append((path, files)) or real(spark, path, files))
    streams._in_two_runs(spark, str(tmp_path), lambda events, target, checkpoint: None, "none")
    tasks = spark.read.parquet(f"{tmp_path}/events.parquet").rdd.getNumPartitions()
    landed = spark.read.parquet(paths[0][0])
    assert 1 < tasks and [n for _, n in paths] == [tasks, tasks] and len(landed.inputFiles()) == 4 * tasks and landed.count() == 4000
    plan = one_a_key(spark.range(9).selectExpr("id AS k", "id AS v"), ["k"], tasks=77)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and ", 77)" in plan
