"""Calculated fields of the profit report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.codes import brand_of, profit_spu, sku_of_msku
from loomwright.operators.lookup import fallback_lookup
from loomwright.operators.ranking import first_wins


#: Weights and prices in the exact part of the calculation, and money.
EXACT, MONEY = "decimal(18,12)", "decimal(28,10)"


def exact_mean(values: Column) -> Column:
    """The mean of integers over a group, rounded half up to 12 places."""
    scaled = F.sum(values).cast("decimal(12,0)") * F.lit("1000000000000").cast("decimal(13,0)")
    return (F.round(scaled / F.count(F.lit(1)).cast("decimal(8,0)"), 0).cast("decimal(24,0)") * F.lit("0.000000000001").cast("decimal(12,12)")).cast(EXACT)


def weights(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sku, weight) of the first product with one, and (spu, spu_weight): the mean over the style's products with one.

    Both are structs: the number as a double, and exact.
    """
    known = products.where("weight > 0")
    both = lambda number, exact, name: F.struct(number.cast("double").alias("number"), exact.cast(EXACT).alias("exact")).alias(name)
    by_sku = first_wins(known, ["sku"], ["part_id"], ["weight"]).select("sku", both(F.col("weight"), F.col("weight"), "weight"))
    mean = F.sum(F.col("weight").cast("double")) / F.count(F.lit(1))
    return by_sku, known.groupBy("spu").agg(mean.alias("m"), exact_mean(F.col("weight")).alias("e")).select("spu", both(F.col("m"), F.col("e"), "spu_weight"))


def freight_levels(freight: DataFrame, back: int = 2) -> DataFrame:
    """level, shop, owner, brand, month, price, exact, matched: what each level offers for a month, the nearest month (``matched``) first.

    Owners: the first record of (shop, owner); shops and brands: the mean over
    records.  A month takes from itself or from up to ``back`` before it.
    """
    rows = freight.where("price > 0").withColumn("whole", F.col("price")).withColumn("price", F.col("price").cast("double")).withColumn("brand", brand_of(F.col("shop")))
    none = F.lit("")
    owner = first_wins(rows, ["shop", "owner", "month"], ["ordinal"], ["price", "whole"]).withColumn("exact", F.col("whole").cast(EXACT)).select(F.lit(0).alias("level"), "shop", "owner", none.alias("brand"), "month", "price", "exact")
    mean = ((F.sum("price") / F.count(F.lit(1))).alias("price"), exact_mean(F.col("whole")).alias("exact"))
    shop = rows.groupBy("shop", "month").agg(*mean).select(F.lit(1).alias("level"), "shop", none.alias("owner"), none.alias("brand"), "month", "price", "exact")
    brand = rows.groupBy("brand", "month").agg(*mean).select(F.lit(2).alias("level"), none.alias("shop"), none.alias("owner"), "brand", "month", "price", "exact")
    offered = owner.unionByName(shop).unionByName(brand).withColumn("lag", F.explode(F.array(*[F.lit(k) for k in range(back + 1)])))
    offered = offered.withColumn("matched", F.col("month")).withColumn("month", F.add_months("month", F.col("lag")))
    return offered.groupBy("level", "shop", "owner", "brand", "month").agg(F.min_by("price", "lag").alias("price"), F.min_by("exact", "lag").alias("exact"), F.min_by("matched", "lag").alias("matched"))


def freight_price(records: DataFrame, freight: DataFrame) -> DataFrame:
    """Adds price, price_exact, price_level and price_month by owner, shop, brand (each over the months) in turn; records have shop, owner, month."""
    levels = freight_levels(freight).withColumn("found", F.struct("price", "exact", "matched"))
    of = lambda n: levels.where(F.col("level") == n)
    records = records.withColumn("brand", brand_of(F.col("shop")))
    found = fallback_lookup(records, [(of(0), ["shop", "owner", "month"], "found", "owner"), (of(1), ["shop", "month"], "found", "shop"), (of(2), ["brand", "month"], "found", "brand")], "price")
    return found.withColumns({"price_month": F.col("price.matched"), "price_exact": F.col("price.exact"), "price": F.col("price.price")})


def calculated(records: DataFrame, products: DataFrame, freight: DataFrame, fees: list[str], revenue: list[str], ads: list[str]) -> DataFrame:
    """Adds the calculated fields; records hold money in cents, results are decimals of ten places, each rounded half up.

    A record without a code has that of its marketplace code; the style is what
    stands before the code's first dash, and codes without one have no style.
    records: id, sku, msku, shop, owner, month, cost, freight_cost, sold, reshipped,
    returned, and the columns that the three lists name.  Weights are grams,
    prices are for a kilogram; a fee without one of them is 0.
    """
    from loomwright.functions.nulls import sum_of

    by_sku, by_spu = weights(products)
    code = F.coalesce(F.nullif(F.trim("sku"), F.lit("")), sku_of_msku(F.col("msku")))
    rows = records.withColumn("sku", code).withColumn("spu", profit_spu(F.col("sku"), whole=False))
    rows = fallback_lookup(rows, [(by_sku, ["sku"], "weight", "sku"), (by_spu, ["spu"], "spu_weight", "spu")], "weight")
    rows = rows.withColumns({"weight_exact": F.col("weight.exact"), "weight": F.col("weight.number")})
    rows = freight_price(rows, freight)
    actual = F.col("sold") + F.col("reshipped") - F.col("returned")
    share = lambda c, part, places: F.round(c * F.lit(part).cast(f"decimal({places},{places})"), 10).cast(MONEY)
    money = lambda c: share(c.cast("decimal(16,0)"), "0.01", 2)
    # Grams times pieces times the price to seven places are kilograms' to ten.
    grams = F.round(F.col("weight_exact") * F.col("price_exact") * F.col("actual").cast("decimal(6,0)"), 7).cast("decimal(24,7)")
    fee = -F.coalesce(share(grams, "0.001", 3), F.lit(0).cast(MONEY))
    sums: dict[str, Column] = {"platform": money(sum_of(*map(F.col, fees))), "revenue": money(sum_of(*map(F.col, revenue))), "advertising": money(sum_of(*map(F.col, ads)))}
    short = lambda c: c.cast("decimal(24,10)")
    return (
        rows.withColumn("actual", actual)
        .withColumn("freight_fee", fee.cast(MONEY))
        .withColumns(sums)
        .select(
            "id", "sku", "weight", "weight_level", "price", "price_level", "price_month", "actual",
            share(short(money(F.col("cost"))), "0.15", 2).alias("cost_addition"),
            "freight_fee",
            share(short(F.col("freight_fee")), "0.15", 2).alias("freight_addition"),
            (F.col("freight_fee") - money(F.coalesce("freight_cost", F.lit(0)))).cast(MONEY).alias("recorded_freight"),
            "platform", "revenue", "advertising",
            (-share(short(F.col("revenue") + F.col("platform") + F.col("advertising")), "0.01", 2)).cast(MONEY).alias("exchange_loss"),
        )
    )
