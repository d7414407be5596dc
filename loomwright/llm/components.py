"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.common import Scratch


def connected_components(edges: DataFrame, within: Scratch | None = None) -> DataFrame:
    """From edges (a, b) to (id, component): the smallest id that each end reaches.

    Every round hooks each end to its smallest neighbour, follows the pointers
    four steps, and contracts the edges, until none is left.  Pointers always
    lead to smaller ids, so there are no circles; a star takes one round and a
    chain of n ends about log4(n).  Edges with a null end and loops are
    ignored; ends that are on no edge aren't in the result.  A round's tables
    are deleted once the next has written its own; the last stay in ``within``.
    """
    before = Scratch(edges.sparkSession, within)
    left = before.written(
        edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    found = left.select(F.col("a").alias("id")).union(left.select("b")).distinct().withColumn("component", F.col("id"))
    while not left.isEmpty():
        now = Scratch(edges.sparkSession, within)
        up = now.written(left.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "pointers")
        for _ in range(2):
            # Many pointers may lead to one hub; as both sides are read back, that side can be split.
            above = up.select(F.col("v").alias("w"), F.col("p").alias("q"))
            up = now.written(up.join(above, up["p"] == above["w"], "left").select("v", F.coalesce("q", "p").alias("p")), "pointers")
        to = lambda df, c: df.join(up, df[c] == up["v"], "left").withColumn(c, F.coalesce("p", c)).drop("v", "p")
        found = now.written(to(found, "component"), "components")
        moved = to(to(left, "a"), "b").where(F.col("a") != F.col("b"))
        left = now.written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        before.clear()
        before = now
    return found
