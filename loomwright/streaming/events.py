"""Streams of events: daily buckets, slices replaced as late rows arrive, and changes by key.

Results are those of the whole table, in whatever batches and order its files
come.  Each stream has a named checkpoint: started again with it, it goes on
from the first batch that isn't committed.  That batch may have been written
already, wholly or in part; every write says which batch it is of, and replaces
what an earlier try of the same batch has left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.sinks.files import exists, replace_folder, spread, tasks_for, written
from loomwright.sinks.merge import one_a_key, replace_slices, rewrite_partitions

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files_at_once: int = 1) -> DataFrame:
    """Files of events as they come into a folder (or one file); times are taken as UTC."""
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(f.rstrip("/").endswith(f"/{name}") for f in spark.read.parquet(path).inputFiles()):  # a file by itself
        reader, path = reader.option("pathGlobFilter", name), folder
    rows = reader.parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@dataclass(frozen=True)
class Progress:
    """A batch that was committed, and the rows that it read."""

    batch: int
    rows: int


def _run(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None], checkpoint: str) -> list[Progress]:
    """Everything that is there and isn't committed yet, in micro-batches, then stop."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{checkpoint}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return [Progress(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]


def daily_counts(events: DataFrame) -> DataFrame:
    """A count and sum for each day and type; the state keeps one row for each of these, so that rows of any day may still come."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    days = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents")).select(F.col("w.start").cast("date").alias("day"), "event_type", "n", "cents")


def write_daily_counts(events: DataFrame, target: str, checkpoint: str) -> list[Progress]:
    """Counts as they stand after each batch: those of a batch replace the same ones in ``target``, whose other days aren't touched.

    A batch that is tried again has the same counts, as the state is that of
    the last committed one.
    """
    spark = events.sparkSession

    def each(batch: DataFrame, _: int) -> None:
        rows = written(batch.select("event_type", "n", "cents", "day"), "counts-batch")
        if exists(spark, target):
            rewrite_partitions(spark, target, rows.schema, "day", rows.select("day"), lambda old: replace_slices(old, rows, ["day", "event_type"]))
        else:
            rows.write.partitionBy("day").parquet(target)

    return _run(daily_counts(events), "update", each, checkpoint)


def write_slices(events: DataFrame, target: str, checkpoint: str) -> list[Progress]:
    """Days of each batch replace the same days in ``target``, with the rows that these have already.

    An event that comes again replaces itself, on whatever day it was: days that
    lose an event are replaced too, and are found by the target's ids alone.  Of
    an event's rows in a batch one stays; events without an id are all kept.
    ``batch`` says which batch a row came with; what an earlier try of a batch
    has written is left out.
    """
    spark = events.sparkSession
    kind = "event_id long, event_type string, batch long, day date"

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.select("event_id", "event_type", F.lit(number).cast("long").alias("batch"), F.to_date("ts").alias("day"))
        # Read from files, rows are those of one reading of the batch.
        read = written(rows, "slices-read")
        rows = written(one_a_key(read, ["event_id"], tasks=tasks_for(read)), "slices-batch")
        if not exists(spark, target):
            rows.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(target)
            return
        again = rows.select("event_id").where("event_id IS NOT NULL")
        gone = F.col("batch") == number
        held = spark.read.schema(kind).parquet(target)
        moved = held.join(again, "event_id", "left_semi").select("day").unionByName(held.where(gone).select("day"))
        touched = rows.select("day").unionByName(moved)
        rewrite_partitions(spark, target, rows.schema, "day", touched, lambda old: old.where(~gone).join(again, "event_id", "left_anti").select(rows.columns).unionByName(rows))

    return _run(events, "append", each, checkpoint)


# Changes by key


def _slot_counts(events: DataFrame) -> DataFrame:
    """For each user and slot: how many events, how often the type changes from one to the next, and the first and last type."""
    order = F.struct("ts", "event_id")
    was = F.lag("event_type").over(Window.partitionBy("user_id", "slot").orderBy("ts", "event_id"))
    kinds = events.withColumn("was", was).groupBy("user_id", "slot")
    return kinds.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("was") != F.col("event_type")).alias("changed"),
        F.min_by(F.struct("event_type"), order).alias("first"),
        F.max_by(F.struct("event_type"), order).alias("last"),
    )


def _of_user(slots: DataFrame) -> DataFrame:
    """Slots of users put together: what changes inside them, and from one slot's last type to the next one's first."""
    before = F.lag("last").over(Window.partitionBy("user_id").orderBy("slot"))  # a row for each slot, not for each event
    rows = slots.withColumn("before", before)
    crossed = F.count_if(F.col("before.event_type") != F.col("first.event_type"))
    return rows.groupBy("user_id").agg(F.sum("n").alias("n"), (F.sum("changed") + crossed).alias("changed"))


_EVENTS = "user_id long, ts timestamp, event_id long, event_type string, slot timestamp, day date, batch long"
_SLOTS = "user_id long, slot timestamp, n long, changed long, first struct<event_type:string>, last struct<event_type:string>, bucket int, batch long"


def write_changes(events: DataFrame, target: str, checkpoint: str, slot: str = "HOUR", buckets: int = 32) -> list[Progress]:
    """Writes each batch's users as they stand after it: user_id, n, changed (how often the type differs from that of the event before, by time, then id).

    State lies beside the checkpoint: events by day, and for each user and slot
    of time a summary, by buckets of users.  A batch counts again the slots in
    which it has events, from the events of its days, and puts its users'
    summaries together; other slots, days and users aren't read.  A user with
    very many events is spread over slots.  An event that comes again, at the
    same time, counts once; events without an id count each.  ``target`` has a
    folder for each batch, written again if the batch is; :func:`latest_changes`
    reads it.
    """
    spark, state = events.sparkSession, f"{checkpoint}/state"

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.select("user_id", "ts", "event_id", "event_type", F.date_trunc(slot, "ts").alias("slot"), F.to_date("ts").alias("day"))
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{state}/events/batch={number}")
        mine = spark.read.schema(_EVENTS).parquet(f"{state}/events").where(F.col("batch") == number)
        days = [r["day"] for r in mine.select("day").distinct().collect()]  # days of the calendar
        cells = mine.select(F.col("user_id").alias("u"), F.col("slot").alias("s"), "day").distinct()
        same = F.col("user_id").eqNullSafe(F.col("u"))
        so_far = spark.read.schema(_EVENTS).parquet(f"{state}/events").where((F.col("batch") <= number) & F.col("day").isin(days))
        tasks = tasks_for(so_far)
        so_far = so_far.join(cells.drop("day"), same & F.col("slot").eqNullSafe(F.col("s")), "left_semi").drop("day", "batch")
        so_far = one_a_key(so_far, ["event_id", "user_id", "ts"], known="event_id", tasks=tasks)
        counted = _slot_counts(spread(so_far, tasks, "user_id", "slot")).withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))
        counted.write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/slots/batch={number}")
        slots = spark.read.schema(_SLOTS).parquet(f"{state}/slots").where(F.col("batch") <= number)
        new = slots.where(F.col("batch") == number)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
        users = new.select(F.col("user_id").alias("u")).distinct()
        now = _latest_slots(slots.where(F.col("bucket").isin(touched)).join(users, same, "left_semi"))
        _of_user(spread(now, tasks, "user_id")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return _run(events, "append", each, checkpoint)


def _latest_slots(slots: DataFrame) -> DataFrame:
    rest = F.struct("n", "changed", "first", "last", "batch", "bucket")
    return slots.groupBy("user_id", "slot").agg(F.max_by(rest, "batch").alias("x")).select("user_id", "slot", "x.*")


def latest_changes(spark: SparkSession, target: str) -> DataFrame:
    """Each user as of the last batch that had events of theirs: user_id, n, changed."""
    rows = spark.read.schema("user_id long, n long, changed long, batch long").parquet(target)
    return rows.groupBy("user_id").agg(F.max_by("n", "batch").alias("n"), F.max_by("changed", "batch").alias("changed"))


def compact_changes(spark: SparkSession, checkpoint: str) -> None:
    """Puts the state's files together, between runs: one summary a slot, and few files for each batch."""
    slots = spark.read.schema(_SLOTS).parquet(f"{checkpoint}/state/slots")
    kept = _latest_slots(slots).select(slots.columns)
    replace_folder(kept.repartition("batch", "bucket"), f"{checkpoint}/state/slots", ("batch", "bucket"))
    held = spark.read.schema(_EVENTS).parquet(f"{checkpoint}/state/events")
    replace_folder(held.repartition("batch", "day"), f"{checkpoint}/state/events", ("batch", "day"))
