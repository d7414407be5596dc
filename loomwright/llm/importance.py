"""Resampling a corpus towards a target by hashed word features.

Two passes over Arrow batches.  The first counts features by bucket with
``np.bincount``: one vector of all buckets for each partition, which a tree of
tasks adds up.  The logarithms of the ratios of target and corpus are the
buckets' gains.  The second pass gathers the broadcast gains (a vector of
``buckets`` numbers) and sums them by document with weights of ``bincount``.
Noise from a hash of the id is added, and the highest scores are drawn, which is
sampling without replacement by the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.arrow import as_text, slices
from loomwright.llm.common import written

#: Letters A-Z become a-z; bytes outside a-z, 0-9 and UTF-8's lead and continuation bytes part words.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
PIECE = 1 << 20


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of several texts, whose bytes follow each other and end at ``ends``, and the text that each is in."""
    low = LOWER[data]
    inside = IN_WORD[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = ends[ends < len(data)]
    begins[cuts] |= inside[cuts]  # a text's first byte begins a word
    at = np.flatnonzero(begins)
    letters = low[inside]
    offsets = np.r_[np.cumsum(inside)[at] - 1, len(letters)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.searchsorted(ends, at, side="right")


def _features(words: pa.Array, owner: np.ndarray, longest: int, buckets: int, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and the text of every run of 1 to ``longest`` words that ends behind the first ``known`` ones."""
    coded = words.dictionary_encode()
    spelt: list[bytes] = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    crc = lambda runs: np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets
    found, owners = [crc(spelt)[codes[known:]] if len(spelt) else np.zeros(0, np.int64)], [owner[known:]]
    grams, names = codes, spelt
    for n in range(2, longest + 1):
        if len(codes) < n:
            break
        # A run is its first n - 1 words and its last one; runs that cross texts go.
        pairs, which = np.unique(grams[: len(codes) - n + 1] * len(spelt) + codes[n - 1 :], return_inverse=True)
        names = [names[p // len(spelt)] + b" " + spelt[p % len(spelt)] for p in pairs.tolist()]
        grams = which
        keep = (owner[: len(codes) - n + 1] == owner[n - 1 :]) & (np.arange(n - 1, len(codes)) >= known)
        found.append(crc(names)[which[keep]])
        owners.append(owner[n - 1 :][keep])
    return np.concatenate(found), np.concatenate(owners)


def _pieces(data: np.ndarray, longest: int) -> Iterator[tuple[pa.Array, int]]:
    """The words of one text of any length, a piece at a time, each after the last words of the one before (their number follows)."""
    start, carry = 0, pa.array([], pa.large_binary())
    while start < len(data):
        stop = min(start + PIECE, len(data))
        while stop < len(data):  # up to the next byte that parts words
            gaps = np.flatnonzero(~IN_WORD[LOWER[data[stop : stop + PIECE]]])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop = min(stop + PIECE, len(data))
        words, _ = _words(data[start:stop], np.array([stop - start]))
        both = pa.concat_arrays([carry, words])
        yield both, len(carry)
        carry = both.slice(max(len(both) - longest + 1, 0)) if longest > 1 else carry
        start = stop


def _by_text(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows (or pieces of one long row): the slice, features' buckets, the rows they are in, and words by row."""
    for batch in batches:
        for part in slices(batch, "text", PIECE):
            texts = as_text(part.column("text"))
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = texts.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
            if len(texts) == 1 and len(data) > 2 * PIECE:
                for words, known in _pieces(data, longest):
                    found, owner = _features(words, np.zeros(len(words), np.int64), longest, buckets, known)
                    yield part, found, owner, np.array([len(words) - known])
            else:
                words, owner = _words(data, offsets[1:] - offsets[0])
                found, owners = _features(words, owner, longest, buckets)
                yield part, found, owners, np.bincount(owner, minlength=len(texts))


def feature_counts(texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How often features fall into each bucket, over all rows: vectors of partitions, added up in a tree of tasks."""
    rows = texts.select(F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, found, _, _ in _by_text(batches, longest, buckets):
            total += np.bincount(found, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    vectors = rows.mapInArrow(work, "counts binary").rdd.map(lambda r: np.frombuffer(r["counts"], np.int64))
    return vectors.treeReduce(np.add, depth=3) if vectors.getNumPartitions() else np.zeros(buckets, np.int64)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over that in the corpus, one feature added to every bucket."""
    s, t, more = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + more)) / ((s + 1) * (t.sum() + more)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = 1) -> DataFrame:
    """For each row: doc_id, n_features, n_words, weight (the sum of the gains of its features)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value.astype(float)  # sums of integers below 2**53 are exact
        last, sums = None, None

        def rows_of(part: pa.RecordBatch, sums: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(s.astype(np.int64)) for s in sums)], ["doc_id", "n_features", "n_words", "weight"])

        for part, found, owner, words in _by_text(batches, longest, len(value)):
            n = part.num_rows
            now = [np.bincount(owner, minlength=n), words, np.bincount(owner, weights=value[found], minlength=n)]
            if part is last:  # another piece of one long text
                sums = [a + b for a, b in zip(sums, now, strict=True)]
                continue
            if last is not None:
                yield rows_of(last, sums)
            last, sums = part, now
        if last is not None:
            yield rows_of(last, sums)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_features long, n_words long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 times) a Gumbel variate, from the first 32 bits of a hash of seed and id (null: an empty one)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def drawn(rows: DataFrame, percent: int) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 by falling score, then rising id, for the first ``percent`` of the rows; null for others.

    Rows are range-partitioned, numbered within their partition, and moved on by
    what the partitions before hold, so that no task has them all.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # in the partition
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part__", F.spark_partition_id()).withColumn("place__", place), "scores")
    sizes = placed.groupBy("part__").agg(F.count(F.lit(1)).alias("n"))
    # From here a row for each partition.
    before = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    rank = F.col("start") + F.col("place__") + 1
    return placed.join(F.broadcast(starts), "part__").withColumn("rank", F.when(rank <= F.expr(f"total * {percent} div 100"), rank)).drop("part__", "place__", "start", "total")


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", longest: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_features, weight, score, rank (null: not drawn).

    Features are all runs of 1 to ``longest`` consecutive words.  Rows of fewer
    than ``least_words`` words have a score, but are neither drawn nor counted
    among those of which ``percent`` are.  Null text has no words and a weight
    of 0; a null id takes part after equal scores.  Repeated rows each have a
    score (the same one) and a rank of their own.  Texts of any length are read
    in pieces.  Empty tables give no rows; an empty target is as good as one in
    which all buckets are alike.  Other columns aren't read.
    """
    gain = gains(feature_counts(docs, text_col, longest, buckets), feature_counts(target, target_col, longest, buckets))
    scored = weigh(docs, gain, id_col, text_col, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored, "weights")
    long_enough = F.col("n_words") >= least_words
    found = drawn(scored.where(long_enough), percent).unionByName(scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
