"""Token counts of flat, unindexed token files by a separator scan.

A token file is a sequence of unsigned 16-bit ids, little-endian, where an
end-of-document id closes each document; nothing says where documents begin.
Files are cut into byte ranges, which all tasks share out, and ranges into
blocks.  A vectorised search finds the separators of a block, and a range
reports the documents inside it, its first separator and the document it leaves
open.  A prefix scan over a file's ranges then gives every range what the ones
before it left open, which stitches documents that cross borders.

The writer puts a document's integer id in front of its tokens as digits from a
reserved range of ids, so that counts can be named; readers of other files
leave that off.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.arrow import as_text, slices
from loomwright.llm.common import written


@dataclass(frozen=True)
class TokenFormat:
    """Ids below ``end`` are the vocabulary's; ``digit`` is the first of 2**13 reserved for the digits of document ids.

    A document begins with ``header`` digits, the first the highest, or with
    none; an id that is null has the one that follows the digits in each place.
    """

    end: int = 50_257
    digit: int = 50_258
    header: int = 5
    bits: int = 13


def header_tokens(ids: pa.Array, f: TokenFormat) -> np.ndarray:
    """The digits of each id, most significant first (rows by ``header``)."""
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    value = ids.cast(pa.int64()).fill_null(0).to_numpy().view(np.uint64)
    shifts = np.arange(f.header - 1, -1, -1, dtype=np.uint64) * np.uint64(f.bits)
    digits = (value[:, None] >> shifts[None, :]) & np.uint64((1 << f.bits) - 1)
    digits[missing] = 1 << f.bits
    return (digits + np.uint64(f.digit)).astype("<u2")


def write_token_files(docs: DataFrame, path: str, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", f: TokenFormat = TokenFormat()) -> None:
    """Encode each text by a byte-level vocabulary (ranks file) and write flat token files of some MB.

    Null text counts as empty (no tokens, one separator); an id that is no
    integer is written as null.  Rows are written in the order of their
    partitions; a task's rows may be over several files.
    """
    rows = docs.select(F.col(id_col).try_cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary, pattern).encode_ordinary
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                heads = header_tokens(part.column("id"), f)
                pieces = []
                for head, text in zip(heads, as_text(part.column("text")).to_pylist(), strict=True):
                    pieces += [head.tobytes(), np.array(encode(text), "<u2").tobytes(), np.uint16(f.end).astype("<u2").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(pieces)[:-2]], pa.binary())], ["raw"])

    # A row's bytes are written as they are; the line separator is the last separator's two bytes.
    separator = int(f.end).to_bytes(2, "little").decode("latin-1")
    raw = rows.mapInArrow(work, "raw binary").select(F.col("raw").cast("string").alias("value"))
    raw.write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 256).text(path)


_encodings: dict[str, object] = {}


def _encoding(vocabulary: str, pattern: str):
    """The encoder, made once in a Python worker."""
    if vocabulary not in _encodings:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[vocabulary] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[vocabulary]


KIND = "struct<begin:bigint,doc_id:bigint,stop:bigint>"
DOCUMENT = pa.struct([("begin", pa.int64()), ("doc_id", pa.int64()), ("stop", pa.int64())])


def byte_ranges(spark: SparkSession, path: str, range_tokens: int) -> DataFrame:
    """path, tokens (of the file), k: a row for each range of a file, dealt over all tasks.  Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.expr("length div 2").alias("tokens")).where("tokens > 0")
    ranges = files.select("path", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {range_tokens}"))).alias("k"))
    return ranges.repartition("path", "k")


def scan_ranges(ranges: DataFrame, range_tokens: int, block_tokens: int, f: TokenFormat) -> DataFrame:
    """From (path, tokens, k) to what each range holds: path, tokens, k, inner, first_cut, opened.

    Each task reads its range (and the header that may follow it) and searches
    it block by block.  ``inner`` are the documents with both ends in the
    range, ``first_cut`` the place of its first separator, ``opened`` the
    document that begins last in it (a file opens one at 0).  Places are those
    in the file.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, total, k in zip(*(batch.column(c).to_pylist() for c in ("path", "tokens", "k")), strict=True):
                first = k * range_tokens
                size = min(range_tokens, total - first)
                system, name = FileSystem.from_uri(quote(path, safe="/:"))
                with system.open_input_file(name) as file:
                    tokens = np.frombuffer(file.read_at(2 * min(size + f.header, total - first), 2 * first), "<u2")
                found = [a + np.flatnonzero(tokens[a : min(a + block_tokens, size)] == f.end) for a in range(0, size, block_tokens)]
                cuts = np.concatenate(found)
                begins = cuts + 1 if k else np.r_[0, cuts + 1]
                # What begins with the next range is its file's end, or is named here by the header behind the range.
                ids = _document_ids(tokens, begins, f)
                n = max(len(begins) - 1, 0)
                columns = [pa.array(begins[:n] + first, pa.int64()), ids.slice(0, n), pa.array(begins[1:] - 1 + first, pa.int64())]
                inner = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.StructArray.from_arrays(columns, fields=list(DOCUMENT)))
                opened = {"begin": int(begins[-1]) + first, "doc_id": ids[-1].as_py(), "stop": None} if len(begins) else None
                cut = int(cuts[0]) + first if len(cuts) and k else None
                arrays = [pa.array([path]), pa.array([total], pa.int64()), pa.array([k], pa.int64()), inner, pa.array([cut], pa.int64()), pa.array([opened], DOCUMENT)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "tokens", "k", "inner", "first_cut", "opened"])

    return ranges.mapInArrow(work, f"path string, tokens long, k long, inner array<{KIND}>, first_cut long, opened {KIND}")


def _document_ids(tokens: np.ndarray, begins: np.ndarray, f: TokenFormat) -> pa.Array:
    """The ids whose digits stand at ``begins`` (null: none, cut off, or not digits)."""
    value, known = np.zeros(len(begins), np.uint64), np.full(len(begins), f.header > 0)
    for k in range(f.header):
        at = begins + k
        digit = tokens[np.minimum(at, len(tokens) - 1)].astype(np.int64) - f.digit
        known &= (at < len(tokens)) & (digit >= 0) & (digit < 1 << f.bits)
        value = (value << np.uint64(f.bits)) | digit.clip(0).astype(np.uint64)
    return pa.array(value.view(np.int64), mask=~known)


def carried(ranges: DataFrame, stretch: int = 1024) -> DataFrame:
    """Adds ``carry``, the document that the ranges before leave open: a prefix scan over each file.

    Ranges are taken in stretches.  The last document opened in a stretch is an
    aggregate; a scan over a file's stretches gives each what it starts with,
    and a scan inside the stretch the rest, so a file of any size is spread.
    """
    rows = ranges.withColumn("part", F.expr(f"k div {stretch}"))
    opened = F.when(F.col("opened").isNotNull(), F.col("k"))
    ends = rows.groupBy("path", "part").agg(F.max_by("opened", opened).alias("last"))
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("path", "part", F.last("last", ignorenulls=True).over(before).alias("start"))
    inside = Window.partitionBy("path", "part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(starts, ["path", "part"]).withColumn("carry", F.coalesce(F.last("opened", ignorenulls=True).over(inside), "start")).drop("part", "start")


def count_tokens(spark: SparkSession, path: str, f: TokenFormat = TokenFormat(), range_tokens: int = 1 << 22, block_tokens: int = 1 << 16) -> DataFrame:
    """One row for each document of the token files under ``path``: doc_id, n_tokens, closed, path, begin.

    ``n_tokens`` counts what is between separators, without the id's digits.
    Tokens after a file's last separator are a document that isn't ``closed``;
    files without tokens have none, and half a token at a file's end isn't read.
    Without a header doc_id is null.  Files of any size are read in ranges by
    all tasks; ``path`` must be on a file system that pyarrow opens by its URI.
    """
    found = written(scan_ranges(byte_ranges(spark, path, range_tokens), range_tokens, block_tokens, f), "token-ranges")
    ended = lambda d, stop, closed: F.struct(d["begin"].alias("begin"), d["doc_id"].alias("doc_id"), stop.alias("stop"), F.lit(closed).alias("closed"))
    none = F.array().cast("array<struct<begin:bigint,doc_id:bigint,stop:bigint,closed:boolean>>")
    inner = found.select("path", F.explode("inner").alias("d")).select("path", ended(F.col("d"), F.col("d.stop"), True).alias("d"))
    # Only what crosses the borders of ranges is scanned.
    left = F.coalesce("opened", "carry")
    is_last = F.col("k") == F.expr(f"(tokens - 1) div {range_tokens}")
    crossing = F.concat(
        F.when(F.col("first_cut").isNotNull(), F.array(ended(F.col("carry"), F.col("first_cut"), True))).otherwise(none),
        F.when(is_last & (F.col("tokens") > left["begin"]), F.array(ended(left, F.col("tokens"), False))).otherwise(none),
    )
    docs = inner.unionByName(carried(found.select("path", "tokens", "k", "first_cut", "opened")).select("path", F.explode(crossing).alias("d")))
    size = F.greatest(F.col("d.stop") - F.col("d.begin") - f.header, F.lit(0).cast("long"))
    return docs.select("d.doc_id", size.alias("n_tokens"), "d.closed", "path", "d.begin")
