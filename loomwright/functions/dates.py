"""Months, labels and tolerant date parsing; the day of a run is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(d: Column) -> Column:
    return F.trunc(d, "MM").cast("date")


def month_offset(d: Column, months: int) -> Column:
    return F.add_months(F.trunc(d, "MM"), months)


def month_label(d: Column, suffix: str = "销量") -> Column:
    return F.concat(F.date_format(d, "yy"), F.lit("年"), F.month(d).cast("string"), F.lit(f"月{suffix}"))


def month_of_label(label: Column) -> Column:
    """The month that a label names; two-digit years below 50 are in this century."""
    year = F.regexp_extract(label, r"([0-9]{2})年", 1).try_cast("int")
    month = F.regexp_extract(label, r"年([0-9]{1,2})月", 1).try_cast("int")
    return F.when(month.between(1, 12), F.make_date(F.when(year < 50, year + 2000).otherwise(year + 1900), month, F.lit(1)))


def month_ends(d: Column) -> tuple[Column, Column]:
    return month_of(d), F.last_day(d)


def months_between_dates(first: Column, last: Column) -> Column:
    """An array of the months that a range touches."""
    return F.sequence(month_of(first), month_of(last), F.expr("interval 1 month"))


def month_slices(first: Column, last: Column) -> Column:
    """An array of (first day, last day) for each month of a range, cut to the range."""
    return F.transform(months_between_dates(first, last), lambda m: F.struct(F.greatest(m, first).alias("first"), F.least(F.last_day(m), last).alias("last")))


def tolerant_date(text: Column) -> Column:
    """yyyy-MM-dd (a time may follow) or yyyy/MM/dd; else null."""
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(text, 1, 10), "yyyy/MM/dd"))


def epoch_time(x: Column) -> Column:
    """Seconds, or milliseconds where the number is too large for seconds."""
    return F.timestamp_seconds(F.when(x > 10_000_000_000, F.floor(x / 1000)).otherwise(x))


def epoch_millis(text: Column) -> Column:
    found = [F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")]
    return F.unix_millis(F.coalesce(*found))


def beijing_time(text: Column) -> Column:
    """Times with a Z or UTC, an offset, PST, PDT or no zone, as text in UTC+8.

    Offsets are read with their sign (also the minutes); times without a zone
    and dates alone stay as they are; other text gives null.
    """
    stamp = F.replace(F.regexp_extract(text, r"^([0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2})", 1), F.lit("T"), F.lit(" "))
    local = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss"))
    zone = F.trim(F.substring(text, 20, 100))
    sign = F.when(F.regexp_extract(zone, r"([+-])", 1) == "-", -1).otherwise(1)
    offset = sign * (F.regexp_extract(zone, r"([0-9]{2}):?([0-9]{2})$", 1).try_cast("int") * 60 + F.regexp_extract(zone, r"([0-9]{2}):?([0-9]{2})$", 2).try_cast("int"))
    minutes = F.when(zone.isin("Z", "UTC"), 480).when(zone == "PST", 960).when(zone == "PDT", 900).when(zone.rlike(r"^(UTC)?[+-][0-9]{2}:?[0-9]{2}$"), 480 - offset).when(zone == "", 0)
    moved = F.timestamp_seconds(F.unix_seconds(local) + minutes * 60)
    day = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text)
    return F.coalesce(F.date_format(moved, "yyyy-MM-dd HH:mm:ss"), day)
