"""Purchase suggestions by style and shop, dealt out over months, and the fabric they need."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.numbers import not_negative
from loomwright.operators.lookup import wildcard_additive
from loomwright.operators.ranking import first_wins
from loomwright.operators.reshape import allocate

#: Tenths by which the forecasts of successive months count; later ones count 5.
DECAY = (15, 12, 9, 6)
COVER_CUSTOM, COVER_STOCK = 3, 2


def primary_fabric(pricing: DataFrame) -> DataFrame:
    """spu, fabric: the one with the largest usage (ties: the first by name)."""
    return first_wins(pricing, ["spu"], [-F.coalesce("usage", F.lit(0).cast("bigint")), "fabric"], ["fabric"])


def suggestions(forecasts: DataFrame, stock: DataFrame, pricing: DataFrame, custom: DataFrame, factories: DataFrame, planned: DataFrame, first: dt.date) -> DataFrame:
    """spu, shop, factory, fabric_type, cover, suggested, planned_total, stock, pending, total.

    The suggestion is what all forecast months need beyond stock and arrivals;
    the months covered (from ``first`` on) only limit the planned total.  Stock
    without a shop counts for every shop.
    """
    total = forecasts.groupBy("spu", "shop").agg(F.sum("qty").alias("total"))
    kind = primary_fabric(pricing).join(custom.select("fabric", F.lit(True).alias("custom")), "fabric", "left").select("spu", F.coalesce("custom", F.lit(False)).alias("custom"))
    rows = total.join(kind, "spu", "left").na.fill(False, ["custom"])
    rows = rows.withColumn("cover", F.when(F.col("custom"), COVER_CUSTOM).otherwise(COVER_STOCK).cast("bigint"))
    rows = wildcard_additive(rows, stock, "spu", "shop", ["stock", "pending"])
    rows = rows.join(factories, ["spu", "shop"], "left").withColumn("factory", F.coalesce("factory", F.lit("")))
    ordinal = F.months_between("month", F.lit(first)).cast("int")
    plan = planned.where(F.col("month") >= F.lit(first)).withColumn("ordinal", ordinal)
    ahead = plan.groupBy("spu", "shop").agg(*(F.sum(F.when(F.col("ordinal") < n, F.col("qty"))).alias(f"p{n}") for n in (COVER_STOCK, COVER_CUSTOM)))
    rows = rows.join(ahead, ["spu", "shop"], "left")
    chosen = F.when(F.col("custom"), F.col(f"p{COVER_CUSTOM}")).otherwise(F.col(f"p{COVER_STOCK}"))
    return rows.select(
        "spu",
        "shop",
        "factory",
        F.when(F.col("custom"), "custom").otherwise("stock").alias("fabric_type"),
        "cover",
        not_negative(F.col("total") - F.col("stock") - F.col("pending")).alias("suggested"),
        F.coalesce(chosen, F.lit(0).cast("bigint")).alias("planned_total"),
        "stock",
        "pending",
        "total",
    )


def monthly_suggestions(forecasts: DataFrame, suggested: DataFrame, first: dt.date) -> DataFrame:
    """spu, shop, month, suggested, share: the suggestion over months, earlier ones (from ``first`` on) first."""
    by_month = forecasts.groupBy("spu", "shop", "month").agg(F.sum("qty").alias("qty"))
    rows = by_month.join(suggested.select("spu", "shop", "suggested"), ["spu", "shop"])
    place = F.months_between("month", F.lit(first)).cast("int")
    decay = F.coalesce(F.get(F.array(*[F.lit(d) for d in DECAY]), place), F.lit(5)).cast("bigint")
    rows = rows.withColumn("weight", F.col("qty") * decay)
    return allocate(rows, ["spu", "shop"], "month", "suggested", "weight", "share").select("spu", "shop", "month", "suggested", "share")


def fabric_need(suggested: DataFrame, pricing: DataFrame) -> DataFrame:
    """fabric, styles, suggested, usage, metres: for styles on custom fabric; the usage is that of the last style and shop."""
    rows = suggested.where("fabric_type = 'custom' and suggested > 0").join(pricing.select("spu", "fabric", F.coalesce("usage", F.lit(0).cast("bigint")).alias("usage")), "spu")
    need = rows.groupBy("fabric").agg(F.countDistinct("spu").alias("styles"), F.sum("suggested").alias("suggested"), F.max_by("usage", F.struct("spu", "shop")).alias("usage"))
    return need.withColumn("metres", (F.col("suggested") * F.col("usage")).cast("double") / 100)
