"""Chat formatting by a finite-state machine and a declarative template.

A template says how a turn opens and closes, which roles the loss covers, and
which role may follow which.  The machine reads a conversation's rows in turn
order, one at a time, and emits its text as segments, each under the loss or
not; a role that may not follow is noted, and the machine goes on from it.
Rows stream through sorted partitions, so a conversation of any length takes
the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``follows`` maps a role (``""``: the start) to the roles that may come next; ``ends`` may come last.

    Control strings start with ``<|``.  Inside texts and roles a backslash is
    put before the bar of ``<|`` (one more where backslashes are there), so the
    marks of the template are the only control strings, and taking one away
    restores the text.
    """

    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    ends: frozenset[str] = frozenset({"user", "assistant"})

    def escape(self, text: str) -> str:
        return re.sub(r"<(\\*)\|", r"<\1\\|", text)

    def unescape(self, text: str) -> str:
        return re.sub(r"<(\\*)\\\|", r"<\1|", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def unescape_role(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))


CHATML = Template()


def in_turn_order(conversations: DataFrame) -> DataFrame:
    """Rows of one conversation in one partition, by turn, then role and text."""
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


SEGMENTS = "segment long, text string, loss boolean, role string, error string"


def format_segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Segments of every conversation: conv_id, segment, text, loss, role, error.

    A turn has three segments: its opening, its text, and its close; only the
    text of a role in ``loss_roles`` is under the loss.  ``error`` (on the first
    segment of a turn) says that the role may not stand there, or (on the last
    segment of a conversation) that it may not end there; such conversations
    are formatted all the same.  Null texts and roles count as empty, rows with
    a null conv_id form a conversation, rows without a turn come first, and
    repeated rows are turns of their own.  Rows come out sorted by
    conversation and segment within a partition.  Other columns aren't read.
    An empty table gives an empty result.
    """
    rows = in_turn_order(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(6)]
        conv, state, n, size = None, None, 0, 0

        def emit(*values) -> None:
            for column, value in zip(out, values, strict=True):
                column.append(value)

        def close() -> None:
            if state is not None and state not in template.ends:
                out[5][-1] = f"a conversation may not end with {state or 'nothing'}"

        def batch_out() -> pa.RecordBatch:
            # The last segment stays, as the next row decides whether it ends a conversation.
            kept = [column[-1:] for column in out]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c[:-1], t) for c, t in zip(out, (id_type, pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string()), strict=True)],
                ["conv_id", "segment", "text", "loss", "role", "error"],
            )
            for column, rest in zip(out, kept, strict=True):
                column[:] = rest
            return made

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for c, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if state is None or c != conv:
                    close()
                    conv, state, n = c, "", 0
                error = None if role in template.follows.get(state, ()) else f"{role or 'no role'} may not follow {state or 'the start'}"
                written = template.escape(text)
                emit(c, n, template.turn_open + template.escape_role(role) + template.role_end, False, role, error)
                emit(c, n + 1, written, role in template.loss_roles, role, None)
                emit(c, n + 2, template.turn_close, False, role, None)
                state, n, size = role, n + 3, size + len(written)
                if size > 1 << 20 or len(out[0]) > 6000:
                    size = 0
                    yield batch_out()
        close()
        if out[0]:
            for column in out:
                column.append(None)
            yield batch_out()

    return rows.mapInArrow(work, f"conv_id {kind}, {SEGMENTS}")


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_errors long"


def read_back(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the segments say when they are read again: a row for each conversation.

    ``segments`` are those of :func:`format_segments` with no exchange between
    (its order is relied upon).  Marks, roles and texts are taken from the
    segments' text alone: n_turns, turns_sha256 (role, line end, text, line end
    for each turn), loss_chars and loss_sha256 (unescaped text under the loss),
    formatted_chars (of all segments), n_errors.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *(part.split(" ")[0] for part in DIGESTS.split(", "))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh(c) -> dict:
            return {"conv_id": c, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0, "n_errors": 0, "open": None, "inside": []}

        def result(s: dict) -> tuple:
            return (s["conv_id"], s["n_turns"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["formatted_chars"], s["n_errors"])

        def feed(s: dict, text: str, loss: bool) -> None:
            s["formatted_chars"] += len(text)
            if loss:
                plain = template.unescape(text)
                s["loss_chars"] += len(plain)
                s["loss"].update(plain.encode())
            if text.startswith(template.turn_open):
                head, _, rest = text[len(template.turn_open) :].partition(template.role_end)
                s["open"], s["inside"] = template.unescape_role(head), [rest]
            elif text == template.turn_close:
                s["turns"].update(f"{s['open']}\n{template.unescape(''.join(s['inside']))}\n".encode())
                s["n_turns"] += 1
            else:
                s["inside"].append(text)

        state, id_type = None, None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            done = []
            for c, text, loss, error in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "text", "loss", "error")), strict=True):
                if state is None or state["conv_id"] != c:
                    if state is not None:
                        done.append(result(state))
                    state = fresh(c)
                feed(state, text, loss)
                state["n_errors"] += error is not None
            if done:
                yield _rows(done, id_type, names)
        if state is not None:
            yield _rows([result(state)], id_type, names)

    return segments.mapInArrow(work, f"conv_id {kind}, {DIGESTS}")


def _rows(rows: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
