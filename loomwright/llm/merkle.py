"""A Merkle manifest of a dataset: a tree for each group of rows, and one over their roots.

Leaves are numbered in order within their tree, and the number of a tree's
leaves is known; so is then how many members each run of siblings has.  The
monoid is a sparse forest: nodes whose run isn't complete yet, keyed by tree,
level and run.  Adding a node to it completes its run or leaves it open; a
complete run becomes one node of the next level, a tree's root one leaf of the
tree over all trees.  The order of additions doesn't matter, so partitions fold
their leaves by themselves, and what they leave open (a few nodes a level at
the edges of a partition's range) is merged ``fan`` partitions at a time, in
rounds, until one forest is left, whose only node is the root.  Nodes made on
the way are rows of a table, from which proofs are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.common import written

#: The tree over the roots of all others.
TOP = -1
Node = tuple[int, int, int, int, str]  # tree, leaves of the tree, level, index, digest
NODE = "tree long, n long, level int, idx long, digest string"
#: Levels that one group of rows spans when proofs are read (arity**STRIDE leaves).
STRIDE = 8


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row: each value as ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


class Forest:
    """The monoid: open runs of siblings, and how many trees there are."""

    def __init__(self, trees: int, arity: int):
        self.trees, self.arity = trees, arity
        self.open: dict[tuple[int, int, int], tuple[int, dict[int, str]]] = {}

    def add(self, node: Node) -> Iterator[Node]:
        """Takes a node in; the nodes that are complete with it are returned, the lowest first."""
        tree, n, level, idx, digest = node
        while True:
            if -(-n // self.arity**level) == 1:  # a root
                if tree == TOP:
                    return
                tree, n, level, idx = TOP, self.trees, 0, tree
                yield tree, n, level, idx, digest
                continue
            run = idx // self.arity
            members = self.open.setdefault((tree, level, run), (n, {}))[1]
            members[idx] = digest
            if len(members) < min(self.arity, -(-n // self.arity**level) - run * self.arity):
                return
            del self.open[tree, level, run]
            level, idx, digest = level + 1, run, digest_of(members[k] for k in sorted(members))
            yield tree, n, level, idx, digest

    def nodes(self) -> Iterator[Node]:
        """What is open."""
        for (tree, level, _), (n, members) in self.open.items():
            for idx, digest in members.items():
                yield tree, n, level, idx, digest


def _batch(rows: list[Node], made: bool, fragment: int) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([made] * len(rows), pa.bool_()), pa.array([fragment] * len(rows), pa.int64())], ["tree", "n", "level", "idx", "digest", "made", "fragment"])


_FOLDED = f"{NODE}, made boolean, fragment long"


def _fold(nodes: DataFrame, trees: int, arity: int) -> DataFrame:
    """Each partition of ``nodes`` as one fragment: the nodes made in it, and those it leaves open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, fragment = Forest(trees, arity), TaskContext.get().partitionId()
        for batch in batches:
            made: list[Node] = []
            for node in zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "level", "idx", "digest")), strict=True):
                made += forest.add(node)
            yield _batch(made, True, fragment)
        yield _batch(list(forest.nodes()), False, fragment)

    return nodes.select("tree", "n", "level", "idx", "digest").mapInArrow(work, _FOLDED)


@dataclass
class Manifest:
    """``leaves``: tree, n, idx, digest and the columns kept; ``nodes``: tree, n, level (from 1; from 0 in the tree over all), idx, digest."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None
    arity: int


def place_leaves(leaves: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Adds tree (the group's number in order, null first), n (its leaves) and idx (the leaf's number), and counts the trees.

    Rows are range-partitioned by group and order; what partitions hold of a
    group says where each goes on, so a group of any size is over many tasks.
    """
    by = [group, *order]
    numbered = written(leaves, "digests").repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(numbered.withColumn("part__", F.spark_partition_id()).withColumn("pos__", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "leaves")
    runs = written(placed.groupBy(F.col(group).alias("g"), F.col("part__").alias("p")).agg(F.min("pos__").alias("first"), F.count(F.lit(1)).alias("size")), "runs")
    # A tree's number: trees that begin in partitions before (a row for each of these), then those before it in its own.
    trees = runs.groupBy("g").agg(F.min("p").alias("home"), F.sum("size").alias("n"))
    homes = trees.groupBy("home").agg(F.count(F.lit(1)).alias("k"))
    before = Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    homes = homes.select("home", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("trees_before"))
    number = F.col("trees_before") + F.row_number().over(Window.partitionBy("home").orderBy("g")) - 1
    trees = written(trees.join(F.broadcast(homes), "home").select("g", "n", number.cast("long").alias("tree")), "trees")
    earlier = F.sum("size").over(Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.withColumn("start", F.coalesce(earlier, F.lit(0)) - F.col("first")).join(trees.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2"))).select("g", "p", "start", "n", "tree")
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("g")) & (F.col("part__") == F.col("p")))
    return joined.withColumn("idx", F.col("start") + F.col("pos__")).drop("part__", "pos__", "g", "p", "start"), trees.count()


def build(leaves: DataFrame, group: str = "source", order: Sequence[str] = ("doc_id",), arity: int = 3, fan: int = 16) -> Manifest:
    """The manifest of leaves (``digest``, the group and order columns, and others that are kept)."""
    indexed, trees = place_leaves(leaves, group, [*order, "digest"])
    placed = written(indexed.withColumn("level", F.lit(0)), "placed")
    # Fragments are ranges of leaves in order, so that they leave only their edges open.
    made = _fold(placed.repartitionByRange("tree", "idx").sortWithinPartitions("tree", "idx"), trees, arity)
    rounds = [written(made, "forest")]
    while True:
        left = rounds[-1].where(~F.col("made"))
        most = left.agg(F.max("fragment").alias("m")).first()["m"]
        if most is None:
            break
        if most == 0 and len(rounds) > 1:
            raise AssertionError("leaves are missing or repeated")
        groups = left.withColumn("fragment", F.floor(F.col("fragment") / fan))
        rounds.append(written(_merge(groups, trees, arity), "forest"))
    nodes = rounds[0]
    for r in rounds[1:]:
        nodes = nodes.unionByName(r)
    nodes = nodes.where("made").select("tree", "n", "level", "idx", "digest")
    top = nodes.where(F.col("tree") == TOP).orderBy(F.col("level").desc()).first()
    return Manifest(placed, nodes, trees, top["digest"] if top else None, arity)


def _merge(groups: DataFrame, trees: int, arity: int) -> DataFrame:
    """Fragments of a group become one."""

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        forest = Forest(trees, arity)
        made: list[Node] = []
        for node in zip(*(table.column(c).to_pylist() for c in ("tree", "n", "level", "idx", "digest")), strict=True):
            made += forest.add(node)
        return pa.Table.from_batches([_batch(made, True, key[0].as_py()), _batch(list(forest.nodes()), False, key[0].as_py())])

    return groups.groupBy("fragment").applyInArrow(work, _FOLDED)


# Proofs


def fold_proof(leaf: str, proof: str, shape: str) -> str:
    """The root that a leaf and its siblings give: ``shape`` says for each level how many stand left and right of it."""
    at = 0
    for k in range(0, len(shape), 2):
        left, right = int(shape[k]), int(shape[k + 1])
        middle, end = at + 64 * left, at + 64 * (left + right)
        leaf = digest_of((proof[at:middle], leaf, proof[middle:end]))
        at = end
    return leaf


def _descend(rows: DataFrame, low: int, arity: int, out: str, finish) -> DataFrame:
    """Rows of one stride, a block at a time: the proof of every node at level ``low``.

    A block is a node ``STRIDE`` levels up (or a root) with all that is under
    it down to ``low``; its row at level -1 brings the proof from there on.
    ``finish`` makes output rows of (node, proof, shape, row of the block, row).
    """

    def of_block(block: list[dict]) -> list[dict]:
        upper = next(r for r in block if r["level"] < 0)
        found = {(r["level"], r["idx"]): r["digest"] for r in block if r["level"] >= 0}
        rows = []
        for r in block:
            if r["level"] != low:
                continue
            idx, proof, shape = r["idx"], [], []
            for level in range(low, low + STRIDE):
                size = -(-r["n"] // arity**level)
                if size == 1:
                    break
                first = idx - idx % arity
                others = [k for k in range(first, min(first + arity, size)) if k != idx]
                proof += [found[level, k] for k in others]
                shape.append(f"{idx - first}{len(others) - (idx - first)}")
                idx //= arity
            rows.append(finish(r, "".join(proof) + upper["path"], "".join(shape) + upper["shape"], upper))
        return rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[dict] = []
        ready: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if block and (block[0]["tree"], block[0]["block"]) != (r["tree"], r["block"]):
                    ready += of_block(block)
                    block = []
                    if len(ready) >= 4096:
                        yield from _dicts(ready, out)
                        ready = []
                block.append(r)
        if block:
            ready += of_block(block)
        yield from _dicts(ready, out)

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "level").mapInArrow(work, out)


def _dicts(rows: list[dict], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])
    for a in range(0, len(rows), 2048):
        yield pa.RecordBatch.from_pylist(rows[a : a + 2048], fields)


_PATH = "tree long, block long, path string, shape string, subroot string"


def _paths(spark: SparkSession, nodes: DataFrame, upper: DataFrame, most: int, arity: int, leaves: DataFrame | None = None) -> DataFrame:
    """Proofs of all nodes of level 0 of the trees in ``nodes``, from strides of levels, the highest first.

    ``upper`` (tree, path, shape, subroot) holds the proofs of the trees' roots;
    ``most`` is the number of leaves of the largest tree.
    """
    heights = 0
    while arity ** (heights * STRIDE) < most:
        heights += 1
    strides = max(heights, 1)
    down = None  # (tree, block, ...): the proofs of the nodes that are the next stride's blocks
    for s in range(strides - 1, -1, -1):
        low, high = s * STRIDE, (s + 1) * STRIDE
        inside = nodes.where((F.col("level") >= low) & (F.col("level") < high))
        if s:  # trees that end below have no block here
            inside = inside.where(F.col("n") > arity**low)
        spans = ", ".join(f"{arity**k}L" for k in range(STRIDE, 0, -1))
        inside = inside.withColumn("block", F.expr(f"idx div element_at(array({spans}), level - {low} + 1)"))
        # The blocks of trees whose roots are at this stride's top or under it are these roots.
        ends = upper.where((F.col("n") <= arity**high) & ((F.col("n") > arity**low) if s else F.lit(True)))
        starts = ends.select("tree", F.lit(0).cast("long").alias("block"), "path", "shape", "subroot")
        if down is not None:
            starts = starts.unionByName(down)
        none = lambda *names: {c: F.lit(None).cast("string") for c in names}
        columns = ["tree", "n", "level", "idx", "digest", "block", "path", "shape", "subroot"]
        above = starts.withColumns({"n": F.lit(0).cast("long"), "level": F.lit(-1), "idx": F.lit(0).cast("long"), "digest": F.lit(None).cast("string")}).select(columns)
        rows = inside.withColumns(none("path", "shape", "subroot"))
        if s == 0 and leaves is not None:
            extra = [c for c in leaves.columns if c not in columns]
            rows = rows.select(*columns, *extra)
            above = above.select(*columns, *(F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in extra))
            return _descend(rows.unionByName(above), low, arity, "doc_id long, leaf string, received string, subroot string, proof string, shape string, folded string", _document)
        down = written(_descend(rows.select(columns).unionByName(above), low, arity, _PATH, _border), "paths")
    return down


def _border(r: dict, proof: str, shape: str, upper: dict) -> dict:
    return {"tree": r["tree"], "block": r["idx"], "path": proof, "shape": shape, "subroot": upper["subroot"]}


def _document(r: dict, proof: str, shape: str, upper: dict) -> dict:
    folded = fold_proof(r["received"], proof, shape)
    return {"doc_id": r["doc_id"], "leaf": r["digest"], "received": r["received"], "subroot": upper["subroot"], "proof": proof, "shape": shape, "folded": folded}


def prove(manifest: Manifest) -> DataFrame:
    """For each leaf: doc_id, leaf, received, subroot, proof, shape, folded.

    ``proof`` holds the siblings' digests, from the leaf's level to the root,
    left to right, and ``shape`` two digits a level (so ``arity`` is 10 at
    most); ``folded`` is the root that it gives with the digest that was
    ``received``.
    """
    spark, arity = manifest.leaves.sparkSession, manifest.arity
    over = manifest.nodes.where(F.col("tree") == TOP)
    whole = spark.createDataFrame([(TOP, max(manifest.trees, 1), "", "", "")], "tree long, n long, path string, shape string, subroot string")
    tops = _paths(spark, over, whole, manifest.trees, arity)
    roots = over.where("level = 0").select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"))
    sizes = manifest.leaves.where("idx = 0").select("tree", "n")
    upper = tops.drop("tree", "subroot").withColumnRenamed("block", "tree").join(roots, "tree").join(sizes, "tree").select("tree", "n", "path", "shape", "subroot")
    upper = written(upper, "upper")
    most = manifest.leaves.agg(F.max("n").alias("m")).first()["m"] or 1
    extra = [c for c in manifest.leaves.columns if c in ("doc_id", "received")]
    leaves = manifest.leaves.select("tree", "n", "level", "idx", "digest", *extra)
    inner = manifest.nodes.where(F.col("tree") != TOP).select("tree", "n", "level", "idx", "digest", *(F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in extra))
    return _paths(spark, leaves.unionByName(inner), upper, most, arity, leaves)


def merkle_manifest(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", group_col: str = "source", received: dict[str, Column] | None = None, arity: int = 3, fan: int = 16) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, received, subroot, root, proof, shape, folded_root, verified.

    A leaf is the digest of ``columns``.  Groups are ordered by their column
    (null first, then by bytes), leaves by their id (null first), then by
    digest, so repeated rows are leaves of their own.  ``received`` replaces
    columns by what came back: the leaf is made again from them, folded with the
    original siblings, and verified if that gives the root.  Texts of any length
    are hashed whole and never shuffled.  An empty table has no root and gives
    no rows.  Other columns aren't read.
    """
    got = {c: (received or {}).get(c, F.col(c)) for c in columns}
    leaves = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("source"), leaf_digest([F.col(c) for c in columns]).alias("digest"), leaf_digest(list(got.values())).alias("received"))
    manifest = build(leaves, "source", ["doc_id"], arity, fan)
    root = F.lit(manifest.root).cast("string")
    return prove(manifest).select("doc_id", "leaf", "received", "subroot", root.alias("root"), "proof", "shape", F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))
