"""Missing values: null, empty text, zero and the sentinel for "none"."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ingested text has where nothing is known.
NONE = "无"


def present(c: Column, sentinel: bool = True) -> Column:
    """Neither null, nor blank, nor (with ``sentinel``) the word for "none"; never null itself."""
    missing = F.trim(c).isin("", NONE) if sentinel else F.trim(c) == ""
    return F.coalesce(~missing, F.lit(False))


def or_default(c: Column, default: Column | str | float) -> Column:
    """``c``, but the default for null, '' and 0 alike."""
    default = default if isinstance(default, Column) else F.lit(default)
    text = c.cast("string")
    empty = c.isNull() | (text == "") | F.coalesce(F.try_to_number(text, F.lit("S999999999999D99999")) == 0, F.lit(False))
    return F.when(empty, default).otherwise(c)


def text_or(c: Column, default: str = "") -> Column:
    """Trimmed text; the default for null and blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def first_present(*columns: Column) -> Column:
    """The first that is neither null nor blank, trimmed; null if none is."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def any_nonzero(*columns: Column) -> Column:
    """Whether any is neither null nor 0."""
    return reduce(lambda a, b: a | b, (F.coalesce(c != 0, F.lit(False)) for c in columns))


def sum_of(*columns: Column) -> Column:
    """The sum along a row; nulls count as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0).cast("bigint")) for c in columns))
