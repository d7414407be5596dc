"""Parsing of product codes (SPU-COLOUR-SIZE) and shop names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.nulls import NONE


def without_pack(code: Column) -> Column:
    """A code without pack counts such as 4PCS; dashes are squeezed and stripped."""
    bare = F.regexp_replace(F.trim(code), r"(?i)[0-9]+(?:PSC|PCS)", "")
    return F.regexp_replace(F.regexp_replace(bare, "-+", "-"), "^-|-$", "")


def before_dash(code: Column) -> Column:
    """What stands before the first dash; the whole code if that is nothing."""
    head = F.split_part(code, F.lit("-"), F.lit(1))
    return F.when(head == "", code).otherwise(head)


def spu_of(sku: Column) -> Column:
    """The style, after pack counts are removed."""
    return before_dash(without_pack(sku))


def product_spu(sku: Column) -> Column:
    """The style as product records have it: plainly the first part."""
    return F.split_part(without_pack(sku), F.lit("-"), F.lit(1))


def profit_spu(sku: Column, whole: bool) -> Column:
    """The style as profit reports have it: pack counts stay; without a dash the code itself, or null."""
    head = F.split_part(sku, F.lit("-"), F.lit(1))
    return F.when(F.instr(sku, "-") > 1, head).otherwise(sku if whole else F.lit(None).cast("string"))


def _parts(sku: Column) -> Column:
    return F.split(without_pack(sku), "-")


def spu_and_colour(sku: Column) -> Column:
    """struct(spu, spu_colour): two parts give the bare colour, one gives the sentinel."""
    p = _parts(sku)
    colour = F.when(F.size(p) >= 3, F.concat_ws("-", F.get(p, F.lit(0)), F.get(p, F.lit(1)))).when(F.size(p) == 2, F.get(p, F.lit(1))).otherwise(F.lit(NONE))
    return F.struct(F.get(p, F.lit(0)).alias("spu"), colour.alias("spu_colour"))


def colour_of(sku: Column, least_parts: int = 4) -> Column:
    """The colour: the second part, or the third where the second is LONG or SHORT and there are ``least_parts``.

    Orders skip a length with four parts or more, fabric plans with three.
    """
    p = _parts(sku)
    skip = (F.size(p) >= least_parts) & F.upper(F.get(p, F.lit(1))).isin("LONG", "SHORT")
    return F.coalesce(F.when(skip, F.get(p, F.lit(2))).otherwise(F.get(p, F.lit(1))), F.lit(""))


def sku_of_msku(msku: Column) -> Column:
    """A marketplace code without its two leading letters and from -FBA or -FBM on; null if nothing is left."""
    return F.nullif(F.regexp_extract(msku, r"^..(.+?)-FB[AM]", 1), F.lit(""))


def brand_of(shop: Column) -> Column:
    """The prefix with its dash; null without one."""
    return F.when(F.instr(shop, "-") > 1, F.concat(F.substring_index(shop, "-", 1), F.lit("-")))


def shop_name(shop: Column) -> Column:
    """Marketplaces of one seller share a name."""
    return F.when(shop.rlike("^RR[-_]"), F.lit("RR-EU")).otherwise(shop)


def spu_of_msku(msku: Column) -> Column:
    head = F.split_part(msku, F.lit("-"), F.lit(1))
    return F.when(F.length(head) > 2, F.substring(head, 3, 1000)).otherwise(head)


def first_name(names: Column) -> Column:
    """Before the first separator of a list that occurs (in the list's order, not the text's)."""
    found = names
    for mark in reversed([",", ";", "，", "；", "|", "/"]):
        found = F.when(F.contains(names, F.lit(mark)), F.split_part(names, F.lit(mark), F.lit(1))).otherwise(found)
    return F.trim(found)


def full_size_image(url: Column) -> Column:
    return F.regexp_replace(url, r"\._SL[0-9]+_", "")


def normal(text: Column) -> Column:
    return F.upper(F.trim(F.coalesce(text, F.lit(""))))


def box_number(box: Column) -> Column:
    """After the last U, without leading zeros ('0' if there is nothing else)."""
    digits = F.ltrim(F.element_at(F.split(box, "U"), -1), F.lit("0"))
    return F.when(digits == "", F.lit("0")).otherwise(digits)


def padded(number: Column, width: int = 6) -> Column:
    return F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))


def before_last_dash(code: Column) -> Column:
    return F.regexp_replace(code, "-[^-]*$", "")


def first_token(text: Column) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(1))
