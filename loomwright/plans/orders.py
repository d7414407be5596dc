"""Orders against plans, and the capture of operators' plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.codes import colour_of, spu_of
from loomwright.functions.dates import month_of
from loomwright.functions.numbers import ratio
from loomwright.operators.ranking import first_wins


def colour_names(colours: DataFrame) -> DataFrame:
    """abbr, colour_name: of records with both, the last new one, else the first old one."""
    rows = colours.select(F.trim("abbr").alias("abbr"), F.trim("name").alias("name"), "state", "ordinal").where("abbr <> '' AND name <> ''")
    new = F.max_by("name", F.when(F.col("state") == "new", F.col("ordinal")))
    old = F.min_by("name", F.when(F.col("state") == "old", F.col("ordinal")))
    return rows.groupBy("abbr").agg(F.coalesce(new, old).alias("colour_name"))


def order_comparison(purchases: DataFrame, planned: DataFrame, owners: DataFrame, pricing: DataFrame, colours: DataFrame, as_of: dt.date) -> DataFrame:
    """sku, spu, colour, colour_name, shop, month, fabrics, owner, ordered_qty, planned_qty, has_plan, difference, ratio; from the month of ``as_of`` on."""
    start = F.lit(as_of.replace(day=1))
    ordered = purchases.where((F.col("shop") != "无") & (F.col("ordered") >= start)).groupBy("sku", "shop", month_of(F.col("ordered")).alias("month")).agg(F.sum("qty").alias("ordered_qty"))
    plan = planned.where(F.col("month") >= start).groupBy("sku", "shop", "month").agg(F.sum("qty").alias("planned_qty"), F.max("owner").alias("plan_owner"))
    both = ordered.join(plan, ["sku", "shop", "month"], "full_outer").na.fill(0, ["ordered_qty", "planned_qty"])
    both = both.withColumn("has_plan", F.when(F.col("planned_qty") > 0, "yes").otherwise("no")).withColumn("spu", spu_of(F.col("sku")))
    of_plan = plan.where("plan_owner <> ''").withColumn("spu", spu_of(F.col("sku"))).groupBy("spu", "shop").agg(F.min_by("plan_owner", F.struct("month", "sku")).alias("style_owner"))
    listed = first_wins(owners.where("owner <> ''").withColumn("spu", spu_of(F.col("sku"))), ["spu", "shop"], ["ordinal", "owner"], ["owner"]).withColumnRenamed("owner", "listed_owner")
    fabrics = pricing.groupBy("spu").agg(F.array_join(F.array_sort(F.collect_set("fabric")), ",").alias("fabrics"))
    both = both.withColumn("colour", colour_of(F.col("sku"), 4))
    both = both.join(colour_names(colours).withColumnRenamed("abbr", "colour"), "colour", "left")
    out = both.join(of_plan, ["spu", "shop"], "left").join(listed, ["spu", "shop"], "left").join(fabrics, "spu", "left")
    return out.select(
        "sku",
        "spu",
        "colour",
        F.coalesce("colour_name", F.lit("")).alias("colour_name"),
        "shop",
        "month",
        F.coalesce("fabrics", F.lit("")).alias("fabrics"),
        F.coalesce("style_owner", "listed_owner", F.lit("")).alias("owner"),
        "ordered_qty",
        "planned_qty",
        "has_plan",
        (F.col("ordered_qty") - F.col("planned_qty")).alias("difference"),
        ratio(F.col("ordered_qty"), F.col("planned_qty")).alias("fulfilled"),
    )


def comparison_sheet(compared: DataFrame) -> DataFrame:
    """The comparison by style, shop, month, colour and fabrics; planned rows only."""
    rows = compared.groupBy("spu", "shop", "month", "colour", "colour_name", "fabrics").agg(F.sum("ordered_qty").alias("ordered_qty"), F.sum("planned_qty").alias("planned_qty"), F.min(F.nullif("owner", F.lit(""))).alias("owner"))
    rows = rows.where("planned_qty > 0")
    return rows.select("*", (F.col("ordered_qty") - F.col("planned_qty")).alias("difference"), ratio(F.col("ordered_qty"), F.col("planned_qty")).alias("fulfilled"))


def plan_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """sku, shop, month, qty, before, delta: rows of a snapshot that differ from the one before."""
    was = old.select("sku", "shop", "month", F.col("qty").alias("before"))
    both = new.select("sku", "shop", "month", "qty").join(was, ["sku", "shop", "month"], "left").na.fill(0, ["before"])
    return both.withColumn("delta", F.col("qty") - F.col("before")).where("delta <> 0")
