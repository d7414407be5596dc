"""Exact deduplication by 128-bit content hash with a comparison of bytes.

Rows are grouped by (128-bit hash, normalised bytes): the hash leads, so that
unequal texts are told apart by 16 bytes, and the bytes settle what the hash
alone could confuse.  Partial aggregation leaves one row for each distinct
text in a task, so a group that holds a third of all rows costs no more than
any other, and only (id, two hashes) travel for the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.common import WHITE, text_of, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts form one group.  Repeated rows each
    count in group_size, and rows that share the surviving id are all kept (they
    are one document).  A null id never survives a group that has another id; a
    group of null ids alone has a null keep_id and is kept.  Other columns of
    ``docs`` are not read.  An empty table gives an empty result.
    """
    norm = F.regexp_replace(text_of(text_col), WHITE, " ")
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", "norm", F.unhex(F.md5("norm")).alias("h128"), F.sha2("norm", 256).alias("text_sha256")
    )
    classes = (
        rows.groupBy("h128", "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.first("text_sha256").alias("text_sha256"))
        .drop("norm")
    )
    # h128 and sha256 together name a class; were two classes ever to share both,
    # the job stops rather than merge unequal bytes.
    named = (
        classes.groupBy("h128", "text_sha256")
        .agg(F.count(F.lit(1)).alias("n"), F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
        .withColumn("group_size", F.when(F.col("n") == 1, F.col("group_size")).otherwise(F.raise_error("unequal texts share both hashes").cast("long")))
        .drop("n")
    )
    # Read back, the classes share no stage with their aggregation, so a large group's
    # side of the join can be split (and its class repeated) at run time.
    named = written(named, "classes")
    return rows.drop("norm").join(named, ["h128", "text_sha256"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of equal texts one row, with all its columns: that with the smallest id.

    One aggregation by (128-bit hash, bytes) without a join.  Null text counts
    as empty; null ids come after all others; rows that share the smallest id
    go by a hash of their text and then by their other columns as JSON.
    """
    norm = F.regexp_replace(text_of(text_col), WHITE, " ")
    rows = docs.select(F.struct(*docs.columns).alias("row"), norm.alias("norm"))
    of_row = lambda c: F.col("row")[c]
    rest = F.to_json(F.struct(*(of_row(c).alias(c) for c in docs.columns if c != text_col)))
    first = F.min_by("row", F.struct(of_row(id_col).isNull().alias("no_id"), of_row(id_col).alias("id"), F.xxhash64(of_row(text_col)).alias("text"), rest.alias("rest")))
    return rows.groupBy(F.unhex(F.md5("norm")).alias("h128"), "norm").agg(first.alias("row")).select("row.*")
