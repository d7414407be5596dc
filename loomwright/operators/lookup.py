"""Lookups: cascades, as-of months, wildcard keys, overlays and prefixes, all as equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.nulls import NONE


def fallback_lookup(probe: DataFrame, levels: Sequence[tuple[DataFrame, Sequence[str], str, str]], name: str) -> DataFrame:
    """Adds ``name`` and ``<name>_level``: the value of the first level that has one.

    A level is (table, keys, value column, label); its keys are unique.
    """
    value, label = F.lit(None), F.lit(None).cast("string")
    found: list[tuple[str, str]] = []
    for i, (table, keys, column, tag) in enumerate(levels):
        probe = probe.join(table.select(*keys, F.col(column).alias(f"level{i}__")), list(keys), "left")
        found.append((f"level{i}__", tag))
    for column, tag in reversed(found):
        value = F.coalesce(F.col(column), value)
        label = F.when(F.col(column).isNotNull(), F.lit(tag)).otherwise(label)
    return probe.withColumn(name, value).withColumn(f"{name}_level", label).drop(*(c for c, _ in found))


def as_of_months(probe: DataFrame, table: DataFrame, keys: Sequence[str], month: str, value: str, back: int, name: str, row: Sequence[str]) -> DataFrame:
    """``value`` of the probe's month, else of the nearest of the ``back`` months before it.

    The table's rows are copied to the months that may use them, so the join is
    on equality; ``row`` names the probe's unique key.
    """
    lags = F.explode(F.array(*[F.lit(k) for k in range(back + 1)]))
    offered = table.select(*keys, F.col(month).alias("of__"), F.col(value).alias("value__"), lags.alias("lag__"))
    offered = offered.select(*keys, F.add_months("of__", F.col("lag__")).alias(month), "lag__", "value__")
    nearest = offered.groupBy(*keys, month).agg(F.min_by("value__", "lag__").alias(name))
    return probe.join(nearest, [*keys, month], "left")


def wildcard_additive(probe: DataFrame, table: DataFrame, key: str, wild: str, values: Sequence[str], any_value: str = NONE) -> DataFrame:
    """Adds ``values``: those of (key, wild) and of (key, any) summed."""
    exact = table.where(F.col(wild) != any_value).select(key, wild, *(F.col(v).alias(f"e_{v}") for v in values))
    generic = table.where(F.col(wild) == any_value).select(key, *(F.col(v).alias(f"g_{v}") for v in values))
    joined = probe.join(exact, [key, wild], "left").join(generic, key, "left")
    both = {v: F.coalesce(f"e_{v}", F.lit(0).cast("bigint")) + F.coalesce(f"g_{v}", F.lit(0).cast("bigint")) for v in values}
    return joined.withColumns(both).drop(*(f"{p}_{v}" for p in "eg" for v in values))


def overlay(fixed: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``fixed``, and those of ``other`` whose key it lacks."""
    return fixed.unionByName(other.join(fixed.select(*keys).distinct(), list(keys), "left_anti"))


def prefix_lookup(probe: DataFrame, code: str, table: DataFrame, prefix: str, value: str, name: str, mark: str = "-") -> DataFrame:
    """``value`` of the first (smallest) prefix such that ``code`` starts with prefix and ``mark``.

    A prefix that itself holds marks ends at one of the code's marks, so each
    code offers its beginnings up to every mark and the join is on equality.
    """
    parts = F.split(F.col(code), mark, -1)
    heads = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat_ws(mark, F.slice(parts, F.lit(1), n)))
    codes = probe.select(code).distinct().where(F.contains(F.col(code), F.lit(mark)))
    offered = codes.select(code, F.explode(heads).alias("head__"))
    found = offered.join(table.select(F.col(prefix).alias("head__"), F.col(value).alias("value__")), "head__")
    best = found.groupBy(code).agg(F.min_by("value__", "head__").alias(name))
    return probe.join(best, code, "left")


def with_default(probe: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default: Column) -> DataFrame:
    """A left join on unique keys; the default where nothing is found."""
    return probe.join(table.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, default))
