"""Egress to remote tables as a Spark data source: batches, cells in their shape, refused rows by name.

``df.write.format("outbox")`` sends each task's rows in batches through a
function (option ``send``: ``module:function``, called with records and all
options, raising :class:`Refused` where the remote side takes none of them).
A refused batch is halved until the refused rows are alone; these don't stop the
job.  What was sent and what was refused lies in files below ``path``; a task
writes files of its own, and the commit of the job names those that count, so
a task that is tried again leaves nothing that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from loomwright.sources.paged import function_named


class Refused(Exception):
    """What a send function raises where the remote side refuses a batch."""


def cell(value: object, kind: str) -> object:
    """A value in the shape of a remote field: ``text``, ``number``, ``link`` (an address with its text) or ``person`` (a list of ids).

    An empty link or person, and a number that is none, is null.
    """
    if value is None:
        return None
    if kind == "link":
        return {"link": str(value), "text": str(value)} if str(value).strip() else None
    if kind == "person":
        people = value if isinstance(value, list | tuple) else str(value).split(",")
        return [{"id": str(p).strip()} for p in people if p is not None and str(p).strip()] or None
    if kind == "number":
        try:
            number = float(value)
        except (TypeError, ValueError):
            return None
        return int(number) if number.is_integer() else number
    return str(value)


def record(row: dict[str, object], fields: dict[str, str]) -> dict[str, object]:
    """The row's known fields in their shape; fields that the remote table doesn't have are dropped."""
    return {name: cell(row[name], kind) for name, kind in fields.items() if name in row}


def send_halving(rows: list[dict], send: Callable[[list[dict]], None]) -> tuple[list[dict], list[dict]]:
    """Which rows were taken and which refused: a refused batch is sent again as two halves, down to single rows."""
    taken, refused, waiting = [], [], [rows]
    while waiting:
        batch = waiting.pop()
        if not batch:
            continue
        try:
            send(batch)
            taken += batch
        except Refused as why:
            if len(batch) == 1:
                refused.append({**batch[0], "why": str(why)})
            else:
                waiting += [batch[len(batch) // 2 :], batch[: len(batch) // 2]]
    return taken, refused


@dataclass
class Sent(WriterCommitMessage):
    files: list[str]
    n_taken: int
    n_refused: int


class OutboxWriter(DataSourceWriter):
    """Options: path, send, fields (``name:kind,...``), batch (500 rows), keep (columns kept with each record, comma-joined)."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names, self.options = schema.names, dict(options)
        self.fields = dict(f.split(":") for f in self.options["fields"].split(","))
        self.keep = [k for k in self.options.get("keep", "").split(",") if k]

    def _folder(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(quote(self.options["path"], safe="/:"))

    def write(self, iterator: Iterator[Row]) -> Sent:
        function, size = function_named(self.options["send"]), int(self.options.get("batch", 500))
        send = lambda batch: function([r["record"] for r in batch], self.options)
        system, folder = self._folder()
        system.create_dir(folder, recursive=True)
        message = Sent([], 0, 0)

        def sent(batch: list[dict]) -> None:
            taken, refused = send_halving(batch, send)
            for kind, rows in (("taken", taken), ("refused", refused)):
                if rows:
                    name = f"{kind}-{uuid.uuid4().hex}.jsonl"
                    with system.open_output_stream(f"{folder}/{name}") as out:
                        out.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode())
                    message.files.append(name)
            message.n_taken += len(taken)
            message.n_refused += len(refused)

        batch: list[dict] = []
        for row in iterator:
            values = row.asDict(recursive=True)
            batch.append({"record": record(values, self.fields), **{k: values[k] for k in self.keep}})
            if len(batch) == size:
                sent(batch)
                batch = []
        sent(batch)
        return message

    def commit(self, messages: list[Sent | None]) -> None:
        """Names the files of the tasks that ended (a message a task)."""
        system, folder = self._folder()
        system.create_dir(f"{folder}/commits", recursive=True)
        with system.open_output_stream(f"{folder}/commits/{uuid.uuid4().hex}.jsonl") as out:
            for m in messages:
                for name in m.files if m else []:
                    out.write(json.dumps({"file": name}).encode() + b"\n")

    def abort(self, messages: list[Sent | None]) -> None:
        system, folder = self._folder()
        for m in messages:
            for name in m.files if m else []:
                system.delete_file(f"{folder}/{name}")


class OutboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "outbox"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return OutboxWriter(schema, self.options)


def write_outbox(df: DataFrame, path: str, send: str, fields: dict[str, str], keep: tuple[str, ...] = (), batch: int = 500, **options: object) -> None:
    spark = df.sparkSession
    spark.dataSource.register(OutboxSource)
    more = {"path": path, "send": send, "fields": ",".join(f"{n}:{k}" for n, k in fields.items()), "keep": ",".join(keep), "batch": batch} | options
    df.write.format("outbox").mode("append").options(**{k: str(v) for k, v in more.items()}).save()


def read_outbox(spark: SparkSession, path: str, record: str, keep: str = "", refused: bool = False) -> DataFrame:
    """The committed rows that were taken, or those refused with ``why``: the record's fields, and the kept columns."""
    kind = "refused" if refused else "taken"
    schema = f"record struct<{record}>" + (f", {keep}" if keep else "") + (", why string" if refused else "")
    files = spark.read.schema("file string").json(f"{path}/commits")
    names = files.select("file").where(f"file LIKE '{kind}-%'").distinct()
    rows = spark.read.schema(schema).option("pathGlobFilter", f"{kind}-*.jsonl").json(path).selectExpr("*", "element_at(split(_metadata.file_path, '/'), -1) AS file")
    return rows.join(names, "file", "left_semi").drop("file").select("record.*", *[c for c in rows.columns if c not in ("record", "file")])


def check_required(records: list[dict], options: dict[str, str]) -> None:
    """A remote table that takes a batch only if all its records have the fields that option ``required`` names; the files of the outbox are its content."""
    for name in options["required"].split(","):
        if lacking := [r for r in records if r.get(name) in (None, "")]:
            raise Refused(f"{len(lacking)} without {name}" if len(records) > 1 else f"no {name}")
