"""Numbers: coercion, rounding, guarded division.

Session-wide ANSI mode makes unguarded casts and divisions fail, so each of
these says what happens to bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(c: Column) -> Column:
    """decimal(28,10); 0 for null and text that is no number."""
    return F.coalesce(c.cast("string").try_cast("decimal(28,10)"), F.lit(0).cast("decimal(28,10)"))


def round_half_up(c: Column, places: int = 10) -> Column:
    return F.round(c, places)


def round_half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)


def ratio(a: Column, b: Column, places: int = 4) -> Column:
    """a / b rounded to ``places`` (ties up); null unless b is other than 0."""
    scale = float(10**places)
    return F.when(b != 0, F.floor(a.cast("double") / b.cast("double") * scale + 0.5).cast("double") / scale)


def guarded(a: Column, b: Column, otherwise: float = 0.0) -> Column:
    """a / b where b > 0, else ``otherwise``."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(otherwise))


def truncated(c: Column) -> Column:
    """Towards 0."""
    return c.cast("bigint")


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def not_negative(c: Column) -> Column:
    return F.greatest(c, F.lit(0).cast("bigint"))


def int_of_number_text(c: Column) -> Column:
    """'12.5' gives 12; 0 for anything that is no number."""
    return F.coalesce(F.trim(c).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def int_of_integer_text(c: Column) -> Column:
    """'12' gives 12, '12.5' gives 0."""
    whole = F.when(F.trim(c).rlike(r"^[+-]?[0-9]{1,18}$"), F.trim(c))
    return F.coalesce(whole.try_cast("bigint"), F.lit(0).cast("bigint"))


def number_or_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit("")).try_cast("double")


#: Centimetres in an inch, kilograms in a pound (fixed values).
INCH, POUND = 2.54, 0.45359237


def centimetres(length: Column, unit: Column) -> Column:
    return F.when(F.lower(unit) == "in", length * INCH).otherwise(length)


def kilograms(weight: Column, unit: Column) -> Column:
    return F.when(F.lower(unit) == "lb", weight * POUND).otherwise(weight)


def cubic_metres(a: Column, b: Column, c: Column) -> Column:
    return a * b * c / 1_000_000


def volumetric_weight(a: Column, b: Column, c: Column, divisor: int = 6000) -> Column:
    return a * b * c / divisor
