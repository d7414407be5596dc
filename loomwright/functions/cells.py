"""Cells that are text, numbers, lists or objects, read through VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_variant(raw: Column) -> Column:
    """JSON text as a variant; null where it isn't JSON."""
    return F.try_parse_json(raw)


def text_list(raw: Column) -> Column:
    """A JSON list of texts, or a bare text, as an array (null and '' give none)."""
    listed = F.when(F.ltrim(raw).startswith("["), F.from_json(raw, "array<string>"))
    return F.coalesce(listed, F.when(F.trim(raw) != "", F.array(raw)), F.array().cast("array<string>"))


def joined_list(raw: Column) -> Column:
    return F.array_join(text_list(raw), ",")


def field(raw: Column, name: str) -> Column:
    """A field of an object, or of the first object in a list."""
    v = as_variant(raw)
    return F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.try_variant_get(v, f"$[0].{name}", "string"))


def cell_text(raw: Column) -> Column:
    """The text of a cell: that of the first element or of the object, else the text itself."""
    v = as_variant(raw)
    return F.coalesce(F.try_variant_get(v, "$[0].text", "string"), F.try_variant_get(v, "$.text", "string"), F.try_variant_get(v, "$[0]", "string"), raw, F.lit(""))


def cell_number(raw: Column) -> Column:
    return F.coalesce(cell_text(raw).try_cast("double"), F.lit(0.0))


def cell_texts(raw: Column) -> Column:
    """All elements' text joined by commas; text comes before users' names before a name."""
    quoted = F.when(F.ltrim(raw).startswith("{'"), F.replace(raw, F.lit("'"), F.lit('"'))).otherwise(raw)
    v = as_variant(quoted)
    one = lambda x: F.coalesce(
        F.try_variant_get(x, "$.text", "string"),
        F.array_join(F.transform(F.try_variant_get(x, "$.users", "array<variant>"), lambda u: F.try_variant_get(u, "$.name", "string")), ","),
        F.try_variant_get(x, "$.name", "string"),
        F.try_variant_get(x, "$", "string"),
    )
    many = F.array_join(F.transform(F.try_variant_get(v, "$", "array<variant>"), one), ",")
    return F.coalesce(many, one(v), raw, F.lit(""))


def cell_link(raw: Column) -> Column:
    """The URL of a link cell: its link, else its text, else the cell itself."""
    return F.coalesce(field(raw, "link"), field(raw, "text"), raw)


def last_value(pairs: Column, key: str, key_field: str, value_field: str) -> Column:
    """The value of the last struct of an array that has the key."""
    chosen = F.filter(pairs, lambda p: p[key_field] == key)
    return F.try_element_at(chosen, F.lit(-1))[value_field]


def position(array: Column, i: int) -> Column:
    return F.get(array, F.lit(i))
