"""What a table holds after rows are replaced, merged or changed, as plans over old and new rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomwright.operators.ranking import first_wins
from loomwright.sinks.files import delete, spread, written


def replace_range(old: DataFrame, new: DataFrame, replaced: Column) -> DataFrame:
    """Old rows outside ``replaced`` (nulls stay), and all new ones; slices without new rows vanish."""
    return old.where(~F.coalesce(replaced, F.lit(False))).unionByName(new)


def replace_slices(old: DataFrame, new: DataFrame, slice_of: Sequence[str]) -> DataFrame:
    """New rows replace all old rows of the slices they are in."""
    touched = new.select(*slice_of).distinct()
    return old.join(touched, list(slice_of), "left_anti").select(old.columns).unionByName(new)


def last_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row a key, the last by ``order`` (which is unique within a key)."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x__"))
    return best.select(*keys, "x__.*").select(rows.columns)


def one_a_key(rows: DataFrame, keys: Sequence[str], known: str | None = None, tasks: int = 0) -> DataFrame:
    """Of rows with one key the largest by their other columns in order; rows whose key (or its column ``known``) has a null are all kept.

    With ``tasks``, rows are parted by key over so many of them before they
    are sorted, if the session has fewer.
    """
    rest = [c for c in rows.columns if c not in keys]
    named = F.col(known).isNotNull() if known else reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    best = spread(rows.where(named), tasks, *keys).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("x__")).select(*keys, "x__.*").select(rows.columns)
    return best.unionByName(rows.where(~named))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """New rows replace old ones of their key, but for the columns ``keep``, which stay as they were where a row was.

    Of new rows with one key the largest counts, by their other columns in
    order.  Rows whose key has a null are those of no other row: all stay.
    """
    new = one_a_key(new, keys)
    if not keep:
        return old.join(new.select(*keys), list(keys), "left_anti").select(old.columns).unionByName(new)
    was = old.select(*keys, *(F.col(c).alias(f"{c}__") for c in old.columns if c not in keys), F.lit(True).alias("was__"))
    now = new.select(*keys, *(F.col(c) for c in new.columns if c not in keys), F.lit(True).alias("now__"))
    both = was.join(now, list(keys), "full_outer")
    pick = lambda c: F.when(F.col("was__") & (F.col("now__").isNull() | F.lit(c in keep)), F.col(f"{c}__")).otherwise(F.col(c)).alias(c)
    return both.select(*(F.col(c) if c in keys else pick(c) for c in old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """New rows whose key is nowhere yet; of several the first by ``order``."""
    first = first_wins(new, keys, [order], [c for c in new.columns if c not in keys]).select(new.columns)
    return old.unionByName(first.join(old.select(*keys), list(keys), "left_anti").select(old.columns))


def delete_then_insert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows go whose key a new row has; all new rows are added."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(old.columns).unionByName(new)


def update_columns(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Columns of ``changes`` overwrite those of their key, where they aren't null."""
    names = [c for c in changes.columns if c != key]
    joined = old.join(changes.select(key, *(F.col(c).alias(f"{c}__") for c in names)), key, "left")
    return joined.select(*(F.coalesce(f"{c}__", c).alias(c) if c in names else F.col(c) for c in old.columns))


def check_schema(df: DataFrame, wanted: StructType) -> DataFrame:
    """``df``, or an error that names the difference: columns, their order and types must be as wanted."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in wanted]
    if have != want:
        raise ValueError(f"columns differ: have {[x for x in have if x not in want]}, want {[x for x in want if x not in have]}, order {[n for n, _ in have]}")
    return df


def evolve(df: DataFrame, wanted: StructType, renamed: dict[str, str] | None = None, extra: str = "fail") -> DataFrame:
    """``df`` with the wanted columns: renamed by the map, missing ones null, types cast; others fail or are dropped."""
    df = df.withColumnsRenamed(renamed or {})
    more = [c for c in df.columns if c not in wanted.names]
    if more and extra == "fail":
        raise ValueError(f"unexpected columns {more}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted))


def guarded_size(df: DataFrame, most: int = 20_000) -> DataFrame:
    """``df`` if it has at most ``most`` rows (what the target takes), else an error; rows beyond are never cut off."""
    df = written(df, "guarded")  # once, for the count and for the target
    n = df.limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} rows")
    return df


def rewrite_partitions(spark: SparkSession, path: str, schema: StructType, by: str, touched: DataFrame, plan: Callable[[DataFrame], DataFrame]) -> None:
    """Replaces the partitions of ``path`` that ``touched`` names by ``plan`` of the rows they hold; all others keep their files.

    ``plan`` may read the table itself: its result is written beside it first.
    Partitions for which it gives no rows go; rows it gives for partitions that
    aren't touched are an error, as what these hold would be lost.  If the job
    stops between two partitions, running it again gives the same, as long as
    ``plan`` replaces rows by key.  A large partition is written by several tasks.
    """
    names = written(touched.select(F.col(by).alias("by__")).distinct(), "touched")
    old = spark.read.schema(schema).parquet(path)
    same = F.col(by).eqNullSafe(F.col("by__"))
    made = written(plan(old.join(names, same, "left_semi")).select(schema.names), "partitions")
    if made.join(names, same, "left_anti").limit(1).count():
        raise ValueError(f"rows for partitions of {path} that aren't touched")
    made.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    left = names.join(made.select(by).distinct(), same, "left_anti").select(F.col("by__").cast("string").alias("v"))
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in left.collect():  # names of partitions
        delete(spark, f"{path}/{folder(by, r['v'])}")
