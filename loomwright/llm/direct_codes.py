"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits.  Level 0 holds the lowest chunk of every
id, level k the k-th chunk of those that have one.  A bitmap at each level says
which ids go on, and a directory of how many do before every 512th bit turns a
place at one level into that at the next: any token is found from a few bytes,
without decoding what stands around it, and a run of tokens is a run of bytes at
each level.

A file holds whole documents in order of their ids, and a table beside the files
(``manifest``) names those that count: a task that is lost and tried again leaves
files that no row names.

File, little-endian, every section on a multiple of eight bytes: magic, number
of levels, documents and tokens, the entries of each level; document ids,
bitmap of missing ids, starts of documents; for each level its chunks and, but
for the last, its bitmap and its directory.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.arrow import as_text, slices

MAGIC = b"DACTOK01"
STEP = 512
MANIFEST = "part int, seq int, file string, n_docs long, n_tokens long"


# Files


@dataclass
class Builder:
    """What a file holds so far."""

    ids: list[int | None] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    chunks: list[list[np.ndarray]] = field(default_factory=lambda: [[]])
    goes_on: list[list[np.ndarray]] = field(default_factory=lambda: [[]])
    n_tokens: int = 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(tokens))
        self.n_tokens += len(tokens)
        level = 0
        while True:
            self.chunks[level].append(tokens.astype(np.uint8))
            more = tokens > 255
            self.goes_on[level].append(more)
            if not more.any():
                return
            tokens, level = tokens[more] >> 8, level + 1
            if level == len(self.chunks):
                self.chunks.append([])
                self.goes_on.append([])

    def sections(self) -> Iterator[bytes]:
        levels = len(self.chunks)
        counts = [sum(map(len, c)) for c in self.chunks]
        yield MAGIC + np.array([levels, len(self.ids), self.n_tokens, *counts], "<u8").tobytes()
        yield np.array([i or 0 for i in self.ids], "<i8").tobytes()
        yield np.packbits([i is None for i in self.ids], bitorder="little").tobytes() if self.ids else b""
        yield np.r_[0, np.cumsum(self.sizes, dtype=np.int64)].astype("<u8").tobytes()
        for k in range(levels):
            yield np.concatenate(self.chunks[k] or [np.zeros(0, np.uint8)]).tobytes()
            if k < levels - 1:
                bits = np.concatenate(self.goes_on[k])
                yield np.packbits(bits, bitorder="little").tobytes()
                yield np.r_[0, np.cumsum(np.add.reduceat(bits, np.arange(0, len(bits), STEP), dtype=np.int64))].astype("<u8").tobytes()

    def write(self, system: FileSystem, name: str) -> None:
        with system.open_output_stream(name) as out:
            for section in self.sections():
                out.write(section + bytes(-len(section) % 8))


class CodeFile:
    """Reads a file of codes by places; only what is asked for is read."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(32, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a file of token codes")
        levels, self.n_docs, self.n_tokens = np.frombuffer(head[8:], "<u8").tolist()
        counts = np.frombuffer(file.read_at(8 * levels, 32), "<u8").tolist()
        at = 32 + 8 * levels

        def section(size: int) -> int:
            nonlocal at
            here, at = at, at + size + -size % 8
            return here

        self.ids_at, self.missing_at, self.starts_at = section(8 * self.n_docs), section((self.n_docs + 7) // 8), section(8 * self.n_docs + 8)
        self.levels: list[tuple[int, int, int]] = []
        for k, n in enumerate(counts):
            last = k == levels - 1
            self.levels.append((section(n), -1 if last else section((n + 7) // 8), -1 if last else section(8 * ((n + STEP - 1) // STEP + 1))))

    def _array(self, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), kind)

    def _bits(self, at: int, a: int, b: int) -> np.ndarray:
        raw = self._array(at + a // 8, (b + 7) // 8 - a // 8, "u1")
        return np.unpackbits(raw, bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)

    def rank(self, level: int, i: int) -> int:
        """How many entries of a level before ``i`` go on."""
        _, bits, directory = self.levels[level]
        block = i // STEP
        return int(self._array(directory + 8 * block, 1, "<u8")[0]) + int(self._bits(bits, block * STEP, i).sum())

    def token(self, i: int) -> int:
        """Any one token."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, _) in enumerate(self.levels):
            value |= int(self._array(chunks + i, 1, "u1")[0]) << 8 * k
            if bits < 0 or not self._bits(bits, i, i + 1)[0]:
                break
            i = self.rank(k, i)
        return value

    def run(self, a: int, b: int) -> np.ndarray:
        """The tokens from ``a`` up to ``b``."""
        out, at = np.zeros(b - a, "<u4"), np.arange(b - a)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= self._array(chunks + a, b - a, "u1").astype("<u4") << np.uint32(8 * k)
            if bits < 0:
                break
            more = self._bits(bits, a, b)
            at = at[more]
            if not len(at):
                break
            a = self.rank(k, a)
            b = a + len(at)
        return out

    def documents(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, which of them are missing, and starts (with the end of the last) of documents ``a`` up to ``b``."""
        return self._array(self.ids_at + 8 * a, b - a, "<i8"), self._bits(self.missing_at, a, b), self._array(self.starts_at + 8 * a, b - a + 1, "<u8").astype(np.int64)


def _open(path: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(quote(path, safe="/:"))


# Encoding


#: Characters of plain words: printable ASCII, white space, and letters whose lower case is one letter and which compose with nothing before them.
PLAIN = "\t-\r -~\u00c0-\u012f\u0132-\u017f"
LETTER = "a-z\u00df-\u00f6\u00f8-\u012f\u0132-\u017f"


class WordEncoder:
    """The ids of a vocabulary that cuts texts at white space and then by ``words``, each cut being encoded by itself.

    Plain texts, lower-cased, are cut here, and the library encodes each
    distinct cut once; words with other characters or with ``special`` strings
    are given to the library whole.  Cuts of up to ``short`` characters are
    remembered, two generations of at most ``remembered`` each.
    """

    short, remembered = 64, 500_000
    gap = re.compile(r"[ \t-\r]")
    words = re.compile(f"[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \\t-\\r0-9{LETTER}]+")
    odd = re.compile(f"[^{PLAIN}]")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        words = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.whole: set[str] = set()  # words for the library as they are
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, cuts: Iterable[str]) -> list[str]:
        """Afterwards ``young`` knows all of these; those too long to be remembered are returned."""
        plain, other = [], []
        missing = set(cuts).difference(self.young)
        for c in missing:
            x = self.old.get(c)
            if x is not None:
                self.young[c] = x
            elif c in self.whole:
                other.append(c)
            else:
                plain.append(c)
        self.whole.clear()
        # A plain cut is one word of the vocabulary's: its last id, and no other, ends a word.
        runs = [plain[a : a + 256] for a in range(0, len(plain), 256)]
        for run, e in zip(runs, self.library.encode_batch_fast(list(map(" ".join, runs)), add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(run):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                self.young.update((c, raw[a:b]) for c, a, b in zip(run, [0, *ends[:-1]], ends, strict=True))
            else:
                other += run
        for c, e in zip(other, self.library.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.young[c] = np.array(e.ids, "<u4").tobytes()
        return [c for c in missing if len(c) > self.short]

    def _forget(self, long: list[str]) -> None:
        for c in long:
            del self.young[c]
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}

    def _is_other(self, text: str) -> bool:
        return self.odd.search(text) is not None or any(s in text for s in self.special)

    def _cuts(self, text: str) -> list[str]:
        if not self._is_other(text):
            return self.words.findall(text.lower())
        cuts: list[str] = []
        for word in self.gap.split(text):
            if self._is_other(word):
                cuts.append(word)
                self.whole.add(word)
            else:
                cuts += self.words.findall(word.lower())
        return cuts

    def encode(self, texts: pa.Array, piece: int = 1 << 20) -> list[np.ndarray]:
        """The ids of each text; long texts are cut at white space."""
        found: list[list[bytes]] = []
        held: list[tuple[list[bytes], list[str]]] = []  # cuts of about ``piece`` characters are looked up at once
        size = 0

        def look_up() -> None:
            nonlocal held, size
            long = self._learn(chain.from_iterable(cuts for _, cuts in held))
            for parts, cuts in held:
                parts.append(b"".join(map(self.young.__getitem__, cuts)))
            self._forget(long)
            held, size = [], 0

        for text in texts.to_pylist():
            found.append([])
            at = 0
            while at < len(text):
                cut = self.gap.search(text, at + piece) if len(text) > at + piece else None
                stop = cut.start() if cut else len(text)
                held.append((found[-1], self._cuts(text[at:stop])))
                size += stop - at
                at = stop
                if size >= piece:
                    look_up()
        look_up()
        return [np.frombuffer(b"".join(parts), "<u4") for parts in found]


_encoders: dict[str, WordEncoder] = {}


# Tables


def write_codes(docs: DataFrame, path: str, tokenizer: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = 1 << 23) -> None:
    """Encode each text, append ``end``, and write files of codes in ascending order of ids under ``path``.

    ``tokenizer`` is a file of the tokenizers library, readable on every
    executor, whose pre-tokenizer cuts at white space.  Null text counts as
    empty (``end`` alone); an id that is no integer is written as missing, and
    missing ids come first.  Repeated rows are written each, by their texts.
    Rows are range-partitioned and sorted; a task's rows go to files of about
    ``file_tokens``, or of one longer document.  Other columns aren't read.  An
    empty table gives an empty manifest.
    """
    rows = docs.select(F.col(id_col).try_cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # A text's hash parts the rows of an id that many have.
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = WordEncoder(tokenizer)
        encode = _encoders[tokenizer].encode
        system, folder = _open(path)
        part, seq, file = TaskContext.get().partitionId(), 0, Builder()

        def finished() -> pa.RecordBatch:
            name = f"{part:07d}-{seq:05d}-{uuid.uuid4().hex}.codes"
            system.create_dir(folder, recursive=True)
            file.write(system, f"{folder}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]), pa.array([len(file.ids)], pa.int64()), pa.array([file.n_tokens], pa.int64())], ["part", "seq", "file", "n_docs", "n_tokens"])

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc_id, tokens in zip(piece.column("id").to_pylist(), encode(as_text(piece.column("text"))), strict=True):
                    file.add(doc_id, np.append(tokens, np.uint32(end)))
                    if file.n_tokens >= file_tokens:
                        yield finished()
                        seq, file = seq + 1, Builder()
        if file.ids:
            yield finished()

    rows.mapInArrow(work, MANIFEST).write.parquet(f"{path}/manifest")


def code_files(spark: SparkSession, path: str) -> DataFrame:
    """The files that count, with ``before``: the tokens of all files before each.  A row for each file."""
    before = F.sum("n_tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("before", F.coalesce(before, F.lit(0)))


def read_codes(spark: SparkSession, path: str, run_tokens: int = 1 << 20) -> DataFrame:
    """One row for each document in the files: doc_id, start (tokens of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with system.open_input_file(f"{folder}/{name}") as opened:
                    file = CodeFile(opened)
                    ids, missing, starts = file.documents(0, file.n_docs)
                    a = 0
                    while a < file.n_docs:
                        # As many documents as run_tokens hold, or one.
                        b = max(int(np.searchsorted(starts, starts[a] + run_tokens, side="right")) - 1, a + 1)
                        raw = pa.py_buffer(file.run(int(starts[a]), int(starts[b])).tobytes())
                        tokens = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(4 * (starts[a : b + 1] - starts[a])), raw])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[a:b], mask=missing[a:b]), pa.array(starts[a:b] + before), pa.array(np.diff(starts[a : b + 1])), tokens.cast(pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                        a = b

    files = code_files(spark, path).select("file", "before")
    n = files.count()  # few small rows, which would else be put together in one task
    tasks = max(1, min(n, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 64)))
    return files.repartition(tasks, "file").mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place_col: str = "place", stretch: int = 1 << 23) -> DataFrame:
    """``places`` (of tokens among all) with ``token``; null outside the files.  Each is read from its file by itself.

    Places meet files by equal stretches of places, of which a file lies in few.
    """
    files = code_files(spark, path).where("n_tokens > 0").withColumn("after", F.col("before") + F.col("n_tokens"))
    files = files.select("file", "before", "after", F.explode(F.sequence(F.expr(f"before div {stretch}"), F.expr(f"(after - 1) div {stretch}"))).alias("stretch"))
    asked = places.select(F.col(place_col).cast("long").alias("place")).withColumn("stretch", F.floor(F.col("place") / stretch))
    met = asked.join(files, [asked["stretch"] == files["stretch"], asked["place"] >= files["before"], asked["place"] < files["after"]], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(path)
        opened: tuple[str | None, CodeFile | None] = (None, None)
        for batch in batches:
            found = []
            for name, at in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), strict=True):
                if name is not None and name != opened[0]:
                    opened = (name, CodeFile(system.open_input_file(f"{folder}/{name}")))
                found.append(None if name is None else opened[1].token(at))
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(found, pa.int64())], ["place", "token"])

    return met.select("place", "file", (F.col("place") - F.col("before")).alias("at")).sortWithinPartitions("file", "at").mapInArrow(work, "place long, token long")
