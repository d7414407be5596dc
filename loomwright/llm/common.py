"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: space and the controls 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    A folder of our own is made only in a local session where
    ``spark.checkpoint.dir`` is unset, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder (or one in it) and read it back."""
    path = f"{folder or shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder of intermediate tables in the shared folder, deleted once no table that is still to be read needs them."""

    def __init__(self, spark: SparkSession, within: Scratch | None = None):
        self.spark = spark
        self.folder = f"{within.folder if within else shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, name, self.folder)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
