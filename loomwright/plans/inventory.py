"""The inventory estimate: two stocks with wildcard shops, and the inventory sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.codes import spu_and_colour
from loomwright.functions.nulls import NONE
from loomwright.operators.reshape import unpivot_named

STATES = {"sellable": "fba_sellable", "in_transit": "fba_in_transit", "available": "local_available", "pending": "local_pending"}


def stock_cells(fba: DataFrame, local: DataFrame) -> DataFrame:
    """sku, shop, sellable, in_transit (null without FBA stock), available, pending (null without local stock)."""
    f = fba.groupBy("sku", "shop").agg(F.sum("sellable").alias("sellable"), F.sum("in_transit").alias("in_transit"))
    l = local.groupBy("sku", "shop").agg(F.sum("available").alias("available"), F.sum("pending").alias("pending"))  # noqa: E741
    return f.join(l, ["sku", "shop"], "full_outer")


def estimate_cells(fba: DataFrame, local: DataFrame) -> DataFrame:
    """The stocks that :func:`estimate` sums, from two tables."""
    return estimate(stock_cells(fba, local))


def estimate(cells: DataFrame) -> DataFrame:
    """sku, shop, and the four stocks: what each cell (see :func:`stock_cells`) contributes, summed.

    Stock without a shop (the sentinel) goes to shops.  Local stock goes to one
    shop of the product, preferably a US one: of the FBA's shops, else of the
    local ones.  FBA stock goes to every local shop in full.  FBA stock of a
    shop without local stock is lost if the product has local stock without a
    shop, unless it is the shop that stock goes to.
    """
    zero = F.lit(0).cast("bigint")
    in_f, in_l, none = F.col("sellable").isNotNull(), F.col("available").isNotNull(), F.col("shop") == NONE
    place = F.struct((~F.endswith("shop", F.lit("US"))).alias("other"), F.col("shop").alias("shop"))
    cells = cells.select("*", in_f.alias("in_f"), in_l.alias("in_l"))
    facts = cells.groupBy("sku").agg(
        F.min(F.when(F.col("in_f") & ~none, place))["shop"].alias("f_target"),
        F.min(F.when(F.col("in_l") & ~none, place))["shop"].alias("l_target"),
        F.bool_or("in_f").alias("any_f"),
        F.bool_or(F.col("in_f") & none).alias("f_none"),
        F.bool_or(F.col("in_l") & none).alias("l_none"),
        F.max(F.when(F.col("in_f") & none, F.col("sellable"))).alias("wild_sellable"),
        F.max(F.when(F.col("in_f") & none, F.col("in_transit"))).alias("wild_in_transit"),
    )
    cells = cells.join(facts, "sku")
    part = lambda to, when, fba_part, local_part: F.when(
        F.coalesce(when, F.lit(False)),
        F.struct(
            to.alias("shop"),
            (F.coalesce(F.col("sellable"), zero) if fba_part == 1 else F.coalesce(F.col("wild_sellable"), zero) if fba_part == 2 else zero).alias("sellable"),
            (F.coalesce(F.col("in_transit"), zero) if fba_part == 1 else F.coalesce(F.col("wild_in_transit"), zero) if fba_part == 2 else zero).alias("in_transit"),
            (F.coalesce(F.col("available"), zero) if local_part else zero).alias("available"),
            (F.coalesce(F.col("pending"), zero) if local_part else zero).alias("pending"),
        ),
    )
    shop, c_f, c_l = F.col("shop"), F.col("in_f"), F.col("in_l")
    to_f = F.col("f_target").isNotNull()
    to_l = ~F.col("any_f") & F.col("l_target").isNotNull()
    stays = F.col("f_none") | (~F.col("any_f") & F.col("l_target").isNull())
    parts = F.array(
        part(shop, c_l & ~none, 0, True),
        part(F.col("f_target"), c_l & none & to_f, 0, True),
        part(F.col("l_target"), c_l & none & ~to_f & to_l, 0, True),
        part(shop, c_l & none & stays, 0, True),
        part(shop, c_f & ~none & (c_l | (shop == F.col("f_target")) | ~F.col("l_none")), 1, False),
        part(shop, c_l & ~none & F.col("f_none"), 2, False),
        part(shop, c_f & none & F.col("l_none"), 1, False),
    )
    out = cells.select("sku", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p")).select("sku", "p.*")
    return out.groupBy("sku", "shop").agg(*(F.sum(c).alias(c) for c in STATES))


def inventory_estimate(cells: DataFrame) -> DataFrame:
    """sku, spu, spu_colour, shop, state, qty (above 0)."""
    rows = unpivot_named(estimate(cells), ["sku", "shop"], STATES, "state", "qty", "> 0")
    return rows.select("sku", spu_and_colour(F.col("sku"))["spu"].alias("spu"), spu_and_colour(F.col("sku"))["spu_colour"].alias("spu_colour"), "shop", "state", "qty")


def inventory_sheet(local: DataFrame, products: DataFrame) -> DataFrame:
    """Local stock with product names; rows without any stock go."""
    names = products.groupBy("sku").agg(F.min_by("name", "part_id").alias("name"))
    rows = local.where("available <> 0 or pending <> 0").join(names, "sku", "left")
    return rows.select("sku", "shop", "available", "pending", F.coalesce("name", F.lit("")).alias("name"))
