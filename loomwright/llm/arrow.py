"""Walking Arrow batches in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_text(column: pa.Array) -> pa.Array:
    """The column as ``large_string`` without nulls (null: empty)."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, text: str | int, most: int = 1 << 20, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` of at most ``rows`` rows whose ``text`` has about ``most`` bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // most
    cuts = np.union1d(np.flatnonzero(np.diff(group)) + 1, np.arange(rows, len(sizes), rows))
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))
