"""Remote tables' fields in order, and a view for each owner."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Change:
    """``add`` or ``move`` a field to behind another one (None: to the front)."""

    kind: str
    field: str
    after: str | None


def fewest_changes(have: Sequence[str], wanted: Sequence[str]) -> list[Change]:
    """Fields that are missing are added, and as few as possible moved, so that the wanted ones stand in order.

    Those that stay are a longest run of fields that is in order already.  Other
    fields of the table are left where they are, behind those moved in front of
    them.
    """
    if len(set(wanted)) < len(wanted) or len(set(have)) < len(have):
        raise ValueError("a field is named twice")
    place = {f: i for i, f in enumerate(wanted)}
    known = [f for f in have if f in place]
    ends: list[int] = []  # the least last place of a run of each length
    before: dict[str, str | None] = {}
    last: list[str] = []
    for f in known:
        k = bisect_left(ends, place[f])
        ends[k : k + 1], last[k : k + 1] = [place[f]], [f]
        before[f] = last[k - 1] if k else None
    stays, f = set(), last[-1] if last else None
    while f is not None:
        stays.add(f)
        f = before[f]
    changes, previous = [], None
    for f in wanted:
        if f not in stays:
            changes.append(Change("move" if f in before else "add", f, previous))
        previous = f
    return changes


def apply_changes(have: Sequence[str], changes: Sequence[Change]) -> list[str]:
    """The order of fields after the changes, made one after the other."""
    fields = list(have)
    for c in changes:
        if c.kind == "move":
            fields.remove(c.field)
        fields.insert(fields.index(c.after) + 1 if c.after is not None else 0, c.field)
    return fields


def write_views(rows: DataFrame, owner: str, path: str, wanted: Sequence[str]) -> None:
    """One folder for each owner, with the wanted fields in order; rows without an owner are in no view.

    An owner's rows may be many, so they aren't brought into one task.
    """
    named = rows.where(F.coalesce(F.col(owner), F.lit("")) != "")
    named.select(*[c for c in wanted if c != owner], owner).write.partitionBy(owner).parquet(path)
