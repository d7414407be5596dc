"""Turning columns into rows and back, calendars, and dealing out totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.functions.numbers import not_negative


def unpivot_named(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], kind: str, value: str, keep: str = "<> 0") -> DataFrame:
    """One row for each of ``columns`` (column: label) whose value passes ``keep``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(label).alias(kind), F.col(c).alias(value)) for c, label in columns.items()]))
    return df.select(*ids, pairs.alias("x__")).select(*ids, f"x__.{kind}", f"x__.{value}").where(f"{value} {keep}")


def unpivot_groups(df: DataFrame, ids: Sequence[str], groups: Sequence[Mapping[str, str]]) -> DataFrame:
    """Repeated groups of columns (name: column) as rows; groups that are null in all columns go."""
    names = list(groups[0])
    rows = F.explode(F.array(*[F.struct(*(F.col(g[n]).alias(n) for n in names)) for g in groups]))
    some = F.coalesce(*(F.col(n).cast("string") for n in names)).isNotNull()
    return df.select(*ids, rows.alias("x__")).select(*ids, "x__.*").where(some)


def pivot_months(df: DataFrame, ids: Sequence[str], label: str, labels: Sequence[str], value: str) -> DataFrame:
    """One column for each of ``labels`` (given, so no pass over the data finds them); 0 where nothing is."""
    wide = df.groupBy(*ids).pivot(label, list(labels)).agg(F.sum(value))
    return wide.na.fill(0, list(labels))


def with_total_row(df: DataFrame, label: str, total: str, measures: Sequence[str]) -> DataFrame:
    """The rows, and one of sums."""
    sums = df.agg(*(F.sum(m).alias(m) for m in measures)).withColumn(label, F.lit(total))
    return df.select(label, *measures).unionByName(sums)


def allocate(df: DataFrame, keys: Sequence[str], order: str, total: str, weight: str, name: str) -> DataFrame:
    """Split ``total`` (the same on all rows of a key) over rows by whole ``weight``; the last gets what is left.

    Shares are rounded half to even in exact arithmetic and never negative.
    """
    group = Window.partitionBy(*keys)
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sum_w = F.sum(weight).over(group)
    product = F.col(total).cast("bigint") * F.col(weight).cast("bigint")
    quotient, rest = F.expr("product__ div sum__"), F.expr("product__ % sum__")
    up = (rest * 2 > F.col("sum__")) | ((rest * 2 == F.col("sum__")) & (quotient % 2 == 1))
    share = F.when(F.col("sum__") > 0, not_negative(quotient + up.cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
    df = df.withColumn("sum__", F.nullif(sum_w, F.lit(0).cast("bigint"))).withColumn("product__", product)
    df = df.withColumn("share__", F.coalesce(share, F.lit(0).cast("bigint"))).withColumn("last__", F.row_number().over(group.orderBy(F.desc(order))) == 1)
    left = F.col(total) - F.coalesce(F.sum("share__").over(before), F.lit(0).cast("bigint"))
    return df.withColumn(name, F.when(F.col("last__"), not_negative(left)).otherwise(F.col("share__"))).drop("sum__", "product__", "share__", "last__")


def key_value_columns(df: DataFrame, ids: Sequence[str], pairs: str, key: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Array of (key, value) structs to columns; of repeated keys the last wins."""
    chosen = lambda k: F.try_element_at(F.filter(pairs, lambda p: p[key] == k), F.lit(-1))[value]
    return df.select(*ids, *(chosen(k).alias(c) for k, c in names.items()))


def calendar(df: DataFrame, first: Column, last: Column, step: str, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(first, last, F.expr(f"interval 1 {step}"))))
