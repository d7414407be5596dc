"""Fabric demand from planned and forecast pieces, in total and by colour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.codes import colour_of, spu_of
from loomwright.functions.nulls import NONE
from loomwright.plans.procurement import primary_fabric


def usage_with_average(pricing: DataFrame) -> DataFrame:
    """spu, fabric, per_piece (ten-millionths of a metre), missing: usage times loss; missing usage is the fabric's average."""
    mean = pricing.where("usage > 0").groupBy("fabric").agg(F.sum("usage").alias("all"), F.count(F.lit(1)).alias("n"))
    rows = pricing.join(mean, "fabric", "left")
    missing = F.coalesce(F.col("usage"), F.lit(0).cast("bigint")) == 0
    usage = F.when(missing, F.coalesce(F.expr("(all * 1000) div n"), F.lit(0).cast("bigint"))).otherwise(F.col("usage") * 1000)
    loss = F.when(F.coalesce(F.col("loss"), F.lit(0).cast("bigint")) == 0, 100).otherwise(F.col("loss"))
    return rows.select("spu", "fabric", (usage * loss).alias("per_piece"), missing.alias("missing"))


def pieces(planned: DataFrame, forecasts: DataFrame) -> DataFrame:
    """sku, month, planned_qty, system_qty: rows with either above 0."""
    plan = planned.groupBy("sku", "month").agg(F.sum("qty").alias("planned_qty"))
    system = forecasts.groupBy("sku", "month").agg(F.sum("qty").alias("system_qty"))
    return plan.join(system, ["sku", "month"], "full_outer").na.fill(0, ["planned_qty", "system_qty"]).where("planned_qty > 0 or system_qty > 0")


def fabric_demand(planned: DataFrame, forecasts: DataFrame, pricing: DataFrame, custom: DataFrame, stock: DataFrame, colours: DataFrame) -> DataFrame:
    """kind, fabric, code, colour, month, pieces, metres, rolls, stock and the styles whose usage is missing.

    ``total`` rows take every fabric of a style; ``colour`` rows its primary
    fabric where that is made to order and has a code, by merged colour.
    ``stock`` is (sku, available) by code: a total has all whose code starts
    with the fabric's, a colour the one whose code is fabric-colour.
    """
    made = pieces(planned, forecasts).withColumn("spu", spu_of(F.col("sku"))).withColumn("colour", F.upper(colour_of(F.col("sku"), 3)))
    used = made.join(usage_with_average(pricing), "spu")
    measures = [
        F.sum("planned_qty").alias("planned_qty"),
        F.sum("system_qty").alias("system_qty"),
        F.sum(F.col("planned_qty") * F.col("per_piece")).alias("planned_usage"),
        F.sum(F.col("system_qty") * F.col("per_piece")).alias("system_usage"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("missing"), F.col("spu")))), ",").alias("missing"),
    ]
    total = used.groupBy("fabric", "month").agg(*measures).select(F.lit("total").alias("kind"), "*", F.lit("").alias("colour"))
    chosen = used.join(primary_fabric(pricing), ["spu", "fabric"], "left_semi").join(custom.where("code <> ''").select("fabric", "code"), "fabric").where("colour <> ''")
    merged = chosen.join(colours.select("code", F.col("colour"), "merged"), ["code", "colour"], "left").withColumn("colour", F.coalesce("merged", "colour"))
    coloured = merged.groupBy("fabric", "colour", "month").agg(*measures).select(F.lit("colour").alias("kind"), "*")
    rows = total.unionByName(coloured).join(custom, "fabric", "left")
    rows = rows.withColumn("code", F.coalesce("code", F.lit(""))).withColumn("roll", F.coalesce("roll", F.lit(0).cast("bigint")))
    by_code = stock.groupBy(F.upper(F.split_part("sku", F.lit("-"), F.lit(1))).alias("code"), F.lit("").alias("colour")).agg(F.sum("available").alias("stock"))
    by_colour = stock.where(F.size(F.split("sku", "-")) == 2).groupBy(F.split_part("sku", F.lit("-"), F.lit(1)).alias("code"), F.split_part("sku", F.lit("-"), F.lit(2)).alias("colour")).agg(F.sum("available").alias("stock"))
    rows = rows.withColumn("key", F.upper("code")).join(by_code.unionByName(by_colour.where("colour <> ''")).withColumnRenamed("code", "key"), ["key", "colour"], "left")
    metres = lambda c: F.floor(F.col(c) / 100_000 + 0.5).cast("bigint")  # noqa: E731  hundredths
    rows = rows.withColumn("planned_cm", metres("planned_usage")).withColumn("system_cm", metres("system_usage"))
    rolls = lambda c: F.when(F.col("roll") > 0, F.floor(F.col(c).cast("double") / F.col("roll") + 0.5) / 100).otherwise(0.0)
    stock_rolls = F.coalesce("stock", F.lit(0).cast("bigint"))
    return rows.select(
        "kind", "fabric", "code", "colour", "month", "planned_qty", "system_qty",
        (F.col("planned_cm") / 100).alias("planned_metres"), (F.col("system_cm") / 100).alias("system_metres"),
        rolls("planned_cm").alias("planned_rolls"), rolls("system_cm").alias("system_rolls"),
        stock_rolls.alias("stock_rolls"), (stock_rolls * F.col("roll")).alias("stock_metres"), "missing",
    )


def product_demand(planned: DataFrame, pricing: DataFrame, custom: DataFrame) -> DataFrame:
    """sku, fabric, month, fabric_colour, planned_qty, metres: the older report, by product, for fabrics made to order."""
    made = planned.groupBy("sku", "month").agg(F.sum("qty").alias("planned_qty")).where("planned_qty <> 0")
    made = made.withColumn("spu", spu_of(F.col("sku"))).withColumn("colour", F.upper(colour_of(F.col("sku"), 3))).where("colour <> ''")
    used = made.join(usage_with_average(pricing), "spu").join(custom.where("code <> ''").select("fabric", "code"), "fabric")
    metres = F.floor(F.col("planned_qty") * F.col("per_piece") / 100_000 + 0.5) / 100
    return used.select("sku", "fabric", "month", F.concat_ws("-", "code", "colour").alias("fabric_colour"), "planned_qty", metres.alias("metres"))


def latest_pricing(records: DataFrame) -> DataFrame:
    """Records with repeated fabric columns as rows; of each style all rows of its latest time."""
    from loomwright.operators.ranking import latest_with_ties
    from loomwright.operators.reshape import unpivot_groups

    rows = unpivot_groups(records, ["spu", "made"], [{"fabric": f"fabric{i}", "usage": f"usage{i}"} for i in (1, 2, 3)])
    return latest_with_ties(rows.where(F.coalesce(F.trim("fabric"), F.lit("")).isin("", NONE) == F.lit(False)), ["spu"], "made")
