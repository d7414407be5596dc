"""Near-duplicates by banded HyperMinHash registers and verified shingle sets.

1. Texts with equal shingle sets form one class, named by the set's fingerprint.
2. Registers of each class are banded.  Of the classes that share the key of a
   band the one that shares most keys is the hub; each of the others is compared
   with it on full sets.
3. Verified links collapse.  A key whose classes are now connected is done; of
   the others the classes are dealt out in blocks of bounded size: a pair of
   blocks is one group, and sets whose sizes rule a link out are in no common
   group.
4. Inside a group the corrected estimate of the Jaccard similarity settles most
   pairs; the others are compared on their full sets, unless they are already
   connected.  A group returns the links that connect its members, no others.
5. The components of the verified links are the result.

Only classes that share a key are ever compared, a hub's members are dealt out
to salted copies of it, and a group of near copies costs one comparison a class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.arrow import as_text, slices
from loomwright.llm.common import written
from loomwright.llm.components import connected_components
from loomwright.llm.hyperminhash import PLACES, REGISTERS, ShingleSets, band_keys, estimated_jaccard, mix, shingle_sets, sketches


@dataclass(frozen=True)
class NearDedup:
    """Similarity is a fraction of integers; a band has ``band_rows`` registers.

    With 64 bands of 8 a pair at 0.85 shares no key with probability 1e-9.
    """

    width: int = 5
    similar: int = 85
    of: int = 100
    band_rows: int = 8
    block_sets: int = 1024
    block_shingles: int = 1 << 19
    #: About how many classes of a key a copy of its hub is compared with.
    star_sets: int = 128
    #: Standard deviations below the threshold at which an estimate settles a pair.
    sure: float = 6.0


def _fingerprint(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums of its mixed hashes."""
    out = np.zeros((len(sizes), 2), np.uint64)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(starts):
        for k in range(2):
            out[full, k] = np.add.reduceat(mix(hashes + PLACES[5 + k]), starts)
    out[:, 0] += sizes.astype(np.uint64)
    return [row.tobytes() for row in out]


def _described(docs: DataFrame, id_col: str, text_col: str, p: NearDedup) -> DataFrame:
    """id, n (set size), node (fingerprint of the set), keys (of its bands)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # Sets of so few shingles are linked with equal sets only.
    alone = math.ceil(p.similar / (p.of - p.similar)) - 1 if p.similar < p.of else 1 << 62

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(as_text(part.column("text")), p.width)
                many = sets.sizes > alone
                chosen = ShingleSets(sets.hashes[np.repeat(many, sets.sizes)], sets.sizes[many])
                keys = band_keys(sketches(chosen), p.band_rows)
                offsets = np.r_[0, np.cumsum(many * keys.shape[1])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(sets.sizes, pa.int64()),
                        pa.array(_fingerprint(sets.hashes, sets.sizes), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
                    ],
                    ["id", "n", "node", "keys"],
                )

    return rows.mapInArrow(work, f"id {kind}, n long, node binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, p: NearDedup) -> DataFrame:
    """node, hashes of the classes (id, node) that are wanted, from a text of each."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(as_text(part.column("text")), p.width)
                # A row of the same id whose text is another isn't the class meant.
                meant = [a == b for a, b in zip(_fingerprint(sets.hashes, sets.sizes), part.column("node").to_pylist(), strict=True)]
                each = [sets.hashes[a : a + n].tobytes() for a, n in zip(sets.starts, sets.sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(each, pa.binary())], ["node", "hashes"]).filter(pa.array(meant))

    return rows.join(wanted, "id").select("text", "node").mapInArrow(hashed, "node binary, hashes binary").dropDuplicates(["node"])


def _star_links(pairs: DataFrame, sets: DataFrame, p: NearDedup) -> DataFrame:
    """The pairs (a, b, salt) of hub and class that are similar; a hub is copied for each of its salts."""
    hubs = pairs.select("a", "salt").distinct()
    hubs = hubs.join(sets, hubs["a"] == sets["node"]).select("a", "salt", F.lit(None).cast("binary").alias("b"), "hashes")
    others = pairs.join(sets, pairs["b"] == sets["node"]).select("a", "salt", "b", "hashes")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for row, (other, hashes) in enumerate(zip(batch.column("b"), batch.column("hashes"), strict=True)):
                part = np.frombuffer(hashes.as_buffer(), np.uint64)
                if not other.is_valid:  # the hub, before its classes
                    own = part.copy()
                elif p.similar * max(len(own), len(part)) <= p.of * min(len(own), len(part)):
                    at = np.minimum(np.searchsorted(own, part), len(own) - 1)
                    common = int((own[at] == part).sum())
                    linked[row] = common * p.of >= p.similar * (len(own) + len(part) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked))

    rows = hubs.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(compared, "a binary, b binary")


def _groups(members: DataFrame, p: NearDedup) -> DataFrame:
    """From (key, node, n, root) to the same with ``place`` (of a group) and ``side`` (0, 1, or 2 for both).

    The classes of a key that fit into a block are one group.  More are cut by
    size class (sets in classes that aren't neighbours can't be similar) and by
    a hash of the node; every pair of blocks that may hold a link is a group.
    """
    fits = (F.col("sets") <= 2 * p.block_sets) & (F.col("shingles") <= 2 * p.block_shingles)
    totals = members.groupBy("key").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    members = members.join(totals, "key")
    names = ["key", "node", "n", "root"]
    whole = members.where(fits).select(*names, F.expr("named_struct('s', -1L, 'u', 0L, 't', -1L, 'v', 0L)").alias("place"), F.lit(2).alias("side"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(p.similar / p.of * 0.999)))
    large = members.where(~fits).drop("sets", "shingles").withColumn("s", size_class)
    blocks = large.groupBy("key", "s").agg(F.greatest(F.ceil(F.count(F.lit(1)) / p.block_sets), F.ceil(F.sum("n") / p.block_shingles)).alias("blocks"))
    for name, step in (("here", 0), ("above", -1), ("below", 1)):
        large = large.join(blocks.select("key", (F.col("s") + step).alias("s"), F.col("blocks").alias(name)), ["key", "s"], "left")
    large = large.withColumn("u", F.pmod(F.xxhash64("node"), F.col("here")))
    place = lambda n, s, u, t, v, side: F.transform(
        F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>")),
        lambda x: F.struct(F.struct(s.alias("s"), u(x).alias("u"), t.alias("t"), v(x).alias("v")).alias("place"), side(x).alias("side")),
    )
    s, u = F.col("s"), F.col("u")
    places = F.concat(
        place(F.col("here"), s, lambda x: F.least(x, u), s, lambda x: F.greatest(x, u), lambda x: F.when(x == u, 2).when(x > u, 0).otherwise(1)),
        place(F.coalesce("above", F.lit(0)), s, lambda x: u, s + 1, lambda x: x, lambda x: F.lit(0)),
        place(F.coalesce("below", F.lit(0)), s - 1, lambda x: x, s, lambda x: u, lambda x: F.lit(1)),
    )
    dealt = large.select(*names, F.explode(places).alias("x")).select(*names, "x.place", "x.side")
    return whole.unionByName(dealt)


def connecting_links(sets: list[np.ndarray], side: list[int], roots: list[bytes], p: NearDedup, few: int = 16) -> list[tuple[int, int]]:
    """Verified links that connect whatever links connect, between rows of side 0 and 1 or among rows of side 2.

    Rows with equal ``roots`` are connected already.  ``few`` sets are compared without estimates.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    side = np.asarray(side)[order]
    flat = np.concatenate([sets[i] for i in order])
    ends = np.cumsum(sizes)
    registers = sketches(ShingleSets(flat, sizes)) if len(sets) > few else None
    numbers: dict[bytes, int] = {}
    root = np.array([numbers.setdefault(roots[i], len(numbers)) for i in order])
    links = []
    for x in range(len(order)):
        # Smaller sets come first; of those after x only some are small enough.
        stop = int(np.searchsorted(sizes * p.similar, sizes[x] * p.of, "right"))
        others = np.arange(x + 1, stop)
        others = others[(root[others] != root[x]) & ((side[others] == 2) | (side[others] != side[x]))]
        if len(others) and registers is not None:
            guess = estimated_jaccard(registers[others], registers[x], sizes[others], sizes[x])
            least = p.similar / p.of - p.sure * np.sqrt(p.similar / p.of * (1 - p.similar / p.of) / min(sizes[x], REGISTERS))
            others, guess = others[guess >= least], guess[guess >= least]
            others = others[np.argsort(-guess, kind="stable")]
        own = flat[ends[x] - sizes[x] : ends[x]]
        while len(others):
            some, others = others[:64], others[64:]
            parts = np.concatenate([flat[ends[y] - sizes[y] : ends[y]] for y in some])
            at = np.minimum(np.searchsorted(own, parts), len(own) - 1)
            common = np.add.reduceat((own[at] == parts).astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
            linked = some[common * p.of >= p.similar * (sizes[some] + sizes[x] - common)]
            for y in linked:
                if root[y] != root[x]:
                    root[root == root[y]] = root[x]
                    links.append((order[x], order[y]))
            others = others[root[others] != root[x]]
    return links


def _block_links(grouped: DataFrame, sets: DataFrame, p: NearDedup) -> DataFrame:
    """Edges (a, b) of similar classes of a group, as far as they connect."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def links() -> pa.RecordBatch:
            found = connecting_links([np.frombuffer(r[3], np.uint64) for r in rows], [r[1] for r in rows], [r[2] for r in rows], p) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([rows[link[k]][0] for link in found], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "place", "node", "side", "root"))
            for key, place, node, side, root, hashes in zip(*columns, batch.column("hashes"), strict=True):
                now = (key, *place.values())
                if now != group:
                    if rows:
                        yield links()
                    group, rows = now, []
                rows.append((node, side, root, hashes.as_py()))
        if rows:
            yield links()

    joined = grouped.join(sets, "node").select("key", "place", "node", "side", "root", "hashes")
    return joined.repartition("key", "place").sortWithinPartitions("key", "place", "node").mapInArrow(compared, "a binary, b binary")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: NearDedup = NearDedup()) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept.

    A document's set has its distinct ``width``-word shingles (fewer words: the
    whole sequence); null and empty texts have none and are linked with
    nothing.  ``component_id`` is the smallest id that links reach.  Repeated
    rows get the same answer; rows that share an id and differ in text are each
    placed by their own.  Null ids name nothing: such a row has the component of
    an equal set with an id, else null, and is kept only in the latter case.  Other columns aren't read.  An empty table gives an empty
    result.
    """
    told = written(_described(docs, id_col, text_col, p), "shingles")
    classes = written(told.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "classes")
    keyed = classes.where(F.col("id").isNotNull()).select(F.explode("keys").alias("key"), "node", "id", "n")
    common = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # Read back, the classes of a very common key can be split in the joins that follow.
    shared = written(keyed.join(common, "key"), "shared-keys")
    # A text that others were copied from shares more keys than the copies share: it is the hub.
    weights = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    hubs = shared.join(weights, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    pairs = shared.join(hubs, "key").where("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.max("members").alias("members"))
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / p.star_sets)).alias("salt"))
    sets = written(_sets(docs, shared.select("id", "node").distinct(), id_col, text_col, p), "sets")
    stars = written(_star_links(written(pairs, "stars"), sets, p), "star-links")
    connected = connected_components(stars)
    members = shared.where("members > 2").join(connected, F.col("node") == connected["id"], "left").select("key", "node", "n", F.coalesce("component", "node").alias("root"))
    members = written(members, "members")
    parted = members.groupBy("key").agg((F.min("root") != F.max("root")).alias("parted")).where("parted")
    rest = written(members.join(parted, "key").select("key", "node", "n", "root"), "parted")
    links = connected_components(stars.unionByName(_block_links(_groups(rest, p), sets, p)))
    ids = classes.select("node", "id")
    linked = ids.join(links.select(F.col("id").alias("node"), "component"), "node")
    least = linked.join(linked.groupBy("component").agg(F.min("id").alias("least")), "component").select("node", "least")
    # Read back, the classes share no stage with their aggregation: a large class can be split in the join.
    named = written(ids.join(least, "node", "left").select("node", F.coalesce("least", "id").alias("of_node")), "named")
    component = F.when(F.col("n") > 0, F.col("of_node")).otherwise(F.col("id"))
    return told.join(named, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: NearDedup = NearDedup()) -> DataFrame:
    """The rows of ``docs`` whose id names its component, whole and unchanged."""
    kept = near_dedup(docs, id_col, text_col, p).where("kept").select(F.col(id_col).alias("kept__")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["kept__"]), "left_semi")
