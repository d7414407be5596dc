"""Paged remote collections as a Spark data source, and lookups in batches.

``spark.read.format("paged")`` reads pages of records through a fetch function
named by an option (``module:function``).  Slices, and ranges or strides of
pages within them, are partitions, so pages are fetched in parallel; a task
retries a page with growing pauses, and paces its requests by what it meets.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from loomwright.operators import ranking
from loomwright.sinks.files import fresh_path, spread, tasks_for, written


class Busy(Exception):
    """What a fetch function raises where the remote side asks to wait."""


def function_named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def with_retries(call: Callable[[], object], tries: int = 5, pause: float = 10.0, sleep: Callable[[float], None] = time.sleep, refused: Callable[[], None] = lambda: None):
    """The call's result; after ``Busy`` (told to ``refused``) it is tried again, each time after twice the pause."""
    for k in range(tries):
        try:
            return call()
        except Busy:
            refused()
            if k == tries - 1:
                raise
            sleep(pause * 2**k)
    raise AssertionError


@dataclass
class Pace:
    """The pause before the next request: longer by ``step`` for each request in a row that was refused, up to ``most``; shorter once after every third success in a row."""

    base: float = 2.0
    step: float = 1.0
    less: float = 0.5
    least: float = 1.0
    most: float = 5.0
    refusals: int = 0
    successes: int = 0

    def after(self, was_refused: bool) -> float:
        if was_refused:
            self.refusals, self.successes = self.refusals + 1, 0
            return min(self.base + self.step * self.refusals, self.most)
        self.refusals, self.successes = 0, self.successes + 1
        if self.successes < 3:
            return self.base
        self.successes = 0
        return max(self.base - self.less, self.least)


class Range(InputPartition):
    def __init__(self, slice_name: str, first: int, last: int | None, step: int):
        self.slice_name, self.first, self.last, self.step = slice_name, first, last, step


class PagedReader(DataSourceReader):
    """Options: fetch, page (rows of one), total (of a slice's rows), pages_per_task, strides, slices (comma-joined: days, shops, flags), pause, interval, folder.

    ``fetch`` is called with slice, offset and length (after ``folder``, if that
    is given) and returns records, or records and the total of its slice.
    ``total`` parts a slice into ranges and is no limit: the last of them, or
    the only one, reads until a short page.  Where the total isn't known, a
    slice is read by ``strides`` tasks, each of which takes every so-manieth
    page until a short one.  A task waits about ``interval`` seconds between
    requests (0: not at all), as :class:`Pace` says.  Columns ``_slice`` and
    ``_total``, if asked for, are the slice and what its page told.
    """

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.names
        self.options = dict(options)

    def partitions(self) -> list[Range]:
        o = self.options
        page, total, strides = int(o.get("page", 1000)), int(o.get("total", 0)), int(o.get("strides", 1))
        slices = o.get("slices", "").split(",")
        if not total:
            return [Range(s, k * page, None, strides * page) for s in slices for k in range(strides)]
        firsts = list(range(0, total, page * int(o.get("pages_per_task", 10))))
        return [Range(s, a, b, page) for s in slices for a, b in zip(firsts, [*firsts[1:], None], strict=True)]

    def read(self, partition: Range) -> Iterator[tuple]:
        o = self.options
        fetch, page = function_named(o["fetch"]), int(o.get("page", 1000))
        before = (o["folder"],) if "folder" in o else ()
        pause, interval = float(o.get("pause", 10)), float(o.get("interval", 0))
        pace = Pace(interval, least=interval / 2, step=interval / 2, less=interval / 4, most=2.5 * interval)
        offset = partition.first
        while partition.last is None or offset < partition.last:
            met: list[bool] = []
            found = with_retries(lambda offset=offset: fetch(*before, partition.slice_name, offset, page), pause=pause, refused=lambda met=met: met.append(True))
            rows, told = found if isinstance(found, tuple) else (found, None)
            for row in rows:
                more = {"_slice": partition.slice_name, "_total": told}
                yield tuple(more[n] if n in more else row.get(n) for n in self.names)
            if len(rows) < page:  # a short page is the last
                return
            offset += partition.step
            if interval:
                time.sleep(pace.after(bool(met)))


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, self.options)


def read_paged(spark: SparkSession, schema: str, **options: object) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").schema(schema).options(**{k: str(v) for k, v in options.items()}).load()


def read_cursor_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed pages of a cursor scan ({"items": [...], "page_token": ...} a line) as their items."""
    pages = spark.read.schema(f"items array<{schema}>, page_token string").json(path)
    return pages.select(F.explode("items").alias("x")).select("x.*")


# Landed pages


def land_pages(rows: DataFrame, key: Sequence[str], page: int, slice_of: Column | None = None) -> str:
    """Rows as pages of up to ``page`` records in order of ``key``, as a remote collection gives them: a file each, with the slice's total.  Returns the folder.

    A slice's name must be one that stands in a path.  Tasks move their pages
    into place by themselves: there is a file for each, too many for the driver
    to rename one by one.
    """
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "landed-pages")
    named = written(rows.withColumn("slice", slice_of if slice_of is not None else F.lit("all")), "pages-rows")
    tasks = tasks_for(named)
    placed = ranking.chunked(named, ["slice"], list(key), page, "page")
    totals = named.groupBy(F.col("slice").alias("of")).agg(F.count(F.lit(1)).alias("total"))
    records = F.sort_array(F.collect_list(F.struct(*key, *(c for c in rows.columns if c not in key))))  # at most ``page``
    pages = spread(placed, tasks, "slice", "page").groupBy("slice", "page").agg(records.alias("records")).join(F.broadcast(totals), F.col("slice") == F.col("of"))  # a row for each slice, whose names a scan's options hold
    pages.select("slice", F.col("page").cast("long").alias("page"), "total", "records").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("slice", "page").json(path)
    return path


def landed_page(folder: str, slice_name: str, offset: int, length: int) -> tuple[list[dict], int | None]:
    """A page of what :func:`land_pages` has landed, and its slice's total; beyond the last page there are no records."""
    system, path = FileSystem.from_uri(quote(folder, safe="/:"))
    files = system.get_file_info(FileSelector(f"{path}/slice={slice_name}/page={offset // length}", allow_not_found=True))
    for file in files:
        if file.base_name.startswith("part-"):
            with system.open_input_stream(file.path) as page:
                told = json.loads(page.read())
            return told["records"], told["total"]
    return [], None


# Completeness


class Incomplete(ValueError):
    pass


def complete_scan(rows: DataFrame, slices: Sequence[str], left_out: Column | None = None) -> DataFrame:
    """Reads ``rows`` once (with ``_slice`` and ``_total``) and returns those that aren't left out, if the pages gave as many as they told.

    Metrics observed on the way count what was fetched and what is left out,
    and gather the totals (one for each slice).  A slice of which no page came
    is missing as well.
    """
    seen = Observation("scan")
    out = F.coalesce(left_out, F.lit(False)) if left_out is not None else F.lit(False)
    observed = rows.observe(seen, F.count(F.lit(1)).alias("fetched"), F.count_if(out).alias("left_out"), F.collect_set(F.struct("_slice", "_total")).alias("told"))
    kept = written(observed.where(~out).drop("_slice", "_total"), "complete")
    told: dict[str, set[int]] = {}
    for r in seen.get["told"]:
        told.setdefault(r["_slice"], set()).add(r["_total"])
    silent = [s for s in slices if s not in told]
    total = sum(max(t, default=0) for t in told.values())
    if silent or any(len(t) != 1 for t in told.values()) or seen.get["fetched"] != total:
        raise Incomplete(f"{seen.get['fetched']} of {total} rows ({seen.get['left_out']} left out), no page of {silent}")
    return kept


# Lookups


def batched_lookup(keys: DataFrame, key: str, path: str, schema: str, batch: int = 100) -> DataFrame:
    """Rows of a Parquet table at ``path`` (in order of ``key``) for the keys, ``batch`` of them a call.

    Keys are sorted into ranges, so a call's keys lie close together, and the
    statistics of row groups leave all groups out that hold none of them.  A key
    that the table doesn't have gives no row; null keys are left out.
    """
    names = [f.strip().split()[0] for f in schema.split(",")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = FileSystem.from_uri(quote(path, safe="/:"))
        table = pads.dataset(folder, format="parquet", filesystem=system)
        for found in batches:
            for a in range(0, found.num_rows, batch):
                asked = found.column(0).slice(a, batch)
                field = pads.field(key)
                wanted = (field >= asked[0]) & (field <= asked[len(asked) - 1]) & field.isin(asked)
                yield from table.to_table(columns=names, filter=wanted).to_batches()

    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return distinct.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(work, schema)
