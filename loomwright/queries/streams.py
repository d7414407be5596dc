"""Streaming queries over events, run to the end of what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.queries.base import query
from loomwright.sinks.files import fresh_path
from loomwright.streaming import events as s


def _in_two_runs(spark: SparkSession, folder: str, write: Callable[..., object], name: str) -> str:
    """Writes all events, whose files are in no order of time, in four parts: a stream reads two of them, a part a batch, and ends; started again, it goes on with two more.

    A part has a file for each task that reads the table, so no task holds more
    than it reads; its files are those of one batch.
    """
    path, target, checkpoint = (fresh_path(spark, n) for n in ("landed", name, "checkpoint"))
    rows = spark.read.parquet(f"{folder}/events.parquet")
    held = 0
    for k in range(4):
        rows.where(F.pmod(F.hash("event_id"), F.lit(4)) == k).write.mode("append").parquet(path)
        if k % 2:
            had, held = held, len(spark.read.parquet(path).inputFiles())
            write(s.event_stream(spark, path, max(1, (held - had) // 2)), target, checkpoint)
    return target


@query("SELECT event_id, ts::DATE AS day, event_type FROM events")
def stm_01_slices_replaced(spark: SparkSession, folder: str) -> DataFrame:
    target = _in_two_runs(spark, folder, s.write_slices, "slices")
    return spark.read.parquet(target).select("event_id", "day", "event_type")


@query("SELECT ts::DATE AS day, event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY ALL")
def stm_02_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    target = _in_two_runs(spark, folder, s.write_daily_counts, "days")
    return spark.read.parquet(target).select("day", "event_type", "n", "cents")


@query("SELECT user_id, count(*) AS n, count(*) FILTER (was <> event_type) AS changed FROM (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events) GROUP BY user_id")
def stm_03_changes(spark: SparkSession, folder: str) -> DataFrame:
    return s.latest_changes(spark, _in_two_runs(spark, folder, s.write_changes, "changes"))
