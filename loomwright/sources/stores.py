"""Tables in databases and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.sinks.files import exists


def read_database(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A table over JDBC; columns and filters are pushed down, and ``column`` (a number, date or time) cuts the scan into ``parts`` ranges.

    The ranges' bounds are the column's least and greatest value, which the
    database is asked for; where it has none, or nulls only, there is one range.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if column:
        low, high = reader.option("dbtable", table).load().agg(F.min(column), F.max(column)).first()
        if low is not None:
            reader = reader.option("partitionColumn", column).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts)
    return reader.option("dbtable", table).load()


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A catalog's table, or no rows of the schema where it is missing."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def folder_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet files of a folder, or no rows of the schema where it is missing; columns that the files lack are null."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]
