"""Files in folders that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; one of our own only in a local session that names none, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared folder and read back: later steps don't compute it again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, rows: int = 400_000) -> int:
    """How many tasks take ``rows`` rows each; the rows of files are counted by their footers alone."""
    return -(-df.count() // rows)


def spread(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` parted by ``keys`` over so many tasks, if the session wouldn't have as many; what is grouped by these keys then isn't moved again."""
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_folder(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write beside ``path``, then swap two names; ``df`` may read ``path`` itself.

    Readers see the old files or the new, but for the moment between two
    renames, in which there are none.  If the second one fails the old files
    are put back; if the driver dies between them they are at ``path.old-*``.
    """
    spark = df.sparkSession
    beside = f"{path}.new-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(beside)
    jvm = spark._jvm
    target, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(beside)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(made, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{beside} can't be moved")
    if had:
        fs.delete(old, True)


def write_files(df: DataFrame, path: str, file_column: str, kind: str = "parquet") -> None:
    """One folder for each value of ``file_column``, each written by one task; its rows are few by construction (chunks)."""
    df.repartition(file_column).write.partitionBy(file_column).format(kind).save(path)
