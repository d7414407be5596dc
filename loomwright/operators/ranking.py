"""Picking rows within groups.  Every order is total, so results don't depend on partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.sinks.files import spread, tasks_for, written


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], take: Sequence[str]) -> DataFrame:
    """For each key the columns ``take`` of the row that comes first by ``order``.

    An aggregation: each task keeps one row a key, so large groups aren't moved.
    ``order`` columns ascend; negate or invert them to descend.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    best = F.min_by(F.struct(*take), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))))
    return df.groupBy(*keys).agg(best.alias("best__")).select(*keys, "best__.*")


def latest_with_ties(df: DataFrame, keys: Sequence[str], when: str) -> DataFrame:
    """All rows of each key that share the latest ``when``."""
    latest = df.groupBy(*keys).agg(F.max(when).alias("latest__"))
    return df.join(latest, list(keys)).where(F.col(when) == F.col("latest__")).drop("latest__")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "number") -> DataFrame:
    """Rows numbered from 1 within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each key; the filter on the number limits what each task keeps."""
    return numbered(df, keys, order, "number__").where(F.col("number__") <= n).drop("number__")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], size: int, name: str = "chunk") -> DataFrame:
    """Rows dealt out in order to chunks of ``size`` within each key, from 0.

    Rows are range-partitioned by key and order, and numbered within a
    partition; a key that spans partitions goes on from the rows that those
    before hold.  So no key's rows are in one task, however many it has.  Rows
    are written first, as ranges are found by a reading of their own; where
    they are many, there are more ranges than the session's partitions.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    by = [*map(F.col, keys), *order]
    read = written(df, "unnumbered")
    tasks = tasks_for(read)
    ranges = read.repartitionByRange(tasks, *by) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else read.repartitionByRange(*by)
    placed = written(ranges.withColumn("part__", F.spark_partition_id()), "numbered")
    sizes = placed.groupBy(*keys, "part__").agg(F.count(F.lit(1)).alias("n__"))
    before = F.sum("n__").over(Window.partitionBy(*keys).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    starts = sizes.select(*(F.col(k).alias(f"{k}__") for k in keys), F.col("part__").alias("of__"), F.coalesce(before, F.lit(0)).alias("start__"))
    placed = spread(placed, tasks, *keys, "part__")
    within = F.row_number().over(Window.partitionBy(*keys, "part__").orderBy(*order))
    same = [placed[k].eqNullSafe(starts[f"{k}__"]) for k in keys] + [placed["part__"] == starts["of__"]]
    joined = placed.withColumn("row__", within).join(starts, same)
    return joined.withColumn(name, F.floor((F.col("start__") + F.col("row__") - 1) / size)).select(*df.columns, name)
