"""Picks within groups, series, allocation, and reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.functions import cells, codes, dates
from loomwright.functions.nulls import NONE
from loomwright.operators import ranking, reshape
from loomwright.plans.procurement import DECAY, primary_fabric
from loomwright.queries.base import query
from loomwright.sources import business as b
from loomwright.sources.business import table


@query("SELECT spu, part_id, weight FROM b_products QUALIFY rank() OVER (PARTITION BY spu ORDER BY weight DESC) = 1")
def win_01_latest_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.latest_with_ties(b.products(spark, folder).select("spu", "part_id", "weight"), ["spu"], "weight")


@query("SELECT spu, shop, arg_max(supplier_id, (shipped, order_id, line, supplier_id)) AS factory FROM b_lines GROUP BY ALL")
def win_02_latest_factory(spark: SparkSession, folder: str) -> DataFrame:
    latest = F.max_by("supplier_id", F.struct("shipped", "order_id", "line", "supplier_id"))
    return b.lines(spark, folder).groupBy("spu", "shop").agg(latest.alias("factory"))


@query("SELECT user_id, arg_max(event_id, (ts, -event_id)) AS event_id FROM events GROUP BY user_id")
def win_03_latest_tie_first(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", (-F.col("event_id")).alias("e"))).alias("event_id"))


@query("SELECT sku, arg_min(name, part_id) AS name FROM b_products GROUP BY sku")
def win_04_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_wins(b.products(spark, folder), ["sku"], ["part_id"], ["name"])


@query("SELECT sku, shop, arg_min(owner, (owner = '', deleted, ordinal, owner)) AS owner FROM b_owners GROUP BY ALL")
def win_05_priority(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_wins(b.owners(spark, folder), ["sku", "shop"], [F.col("owner") == "", "deleted", "ordinal", "owner"], ["owner"])


@query("SELECT fabric, arg_min(name, (part_id % 2 = 1, part_id)) AS name FROM b_products GROUP BY fabric")
def win_06_new_over_old(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_wins(b.products(spark, folder), ["fabric"], [F.col("part_id") % 2 == 1, "part_id"], ["name"])


@query("SELECT spu, arg_min(fabric, (-coalesce(usage, 0), fabric)) AS fabric FROM b_pricing GROUP BY spu")
def win_07_primary_fabric(spark: SparkSession, folder: str) -> DataFrame:
    return primary_fabric(b.fabric_pricing(spark, folder))


@query("SELECT order_id, arg_min(spu, (-q, spu)) AS spu FROM (SELECT order_id, spu, sum(qty) AS q FROM b_lines GROUP BY ALL) GROUP BY order_id")
def win_08_main_style(spark: SparkSession, folder: str) -> DataFrame:
    held = b.lines(spark, folder).groupBy("order_id", "spu").agg(F.sum("qty").alias("q"))
    return ranking.first_wins(held.withColumn("s", F.col("spu")), ["order_id"], [-F.col("q"), "spu"], ["spu"])


@query("SELECT sku, arg_min(shop, (NOT shop LIKE '%US', shop)) AS shop FROM b_fba WHERE shop <> '无' GROUP BY sku")
def win_09_preferred_shop(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_wins(b.fba_stock(spark, folder).where(F.col("shop") != NONE), ["sku"], [~F.endswith("shop", F.lit("US")), "shop"], ["shop"])


@query("SELECT sku, month, qty, coalesce(max(qty) OVER (PARTITION BY sku ORDER BY month RANGE BETWEEN INTERVAL 1 MONTH PRECEDING AND INTERVAL 1 MONTH PRECEDING), 0) AS last_month FROM (SELECT sku, month, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY ALL)")
def win_10_lags(spark: SparkSession, folder: str) -> DataFrame:
    """The month before by an equality on months: gaps in a series stay gaps."""
    sales = b.monthly_sales(spark, folder, by=["sku"])
    before = sales.select("sku", F.add_months("month", 1).alias("month"), F.col("qty").alias("last_month"))
    return sales.join(before, ["sku", "month"], "left").na.fill(0, ["last_month"])


_SPLIT = """WITH w AS (SELECT spu, shop, month, qty, sum(qty) OVER g AS total, qty * [15, 12, 9, 6, 5][least(datediff('month', DATE '2000-06-01', month) + 1, 5)] AS weight, row_number() OVER (PARTITION BY spu, shop ORDER BY month DESC) AS back
    FROM (SELECT spu, shop, month, sum(qty)::BIGINT AS qty FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-12-01' GROUP BY ALL) WINDOW g AS (PARTITION BY spu, shop)),
s AS (SELECT *, CASE WHEN sum(weight) OVER g > 0 THEN greatest(0, round_even((total::DECIMAL(18,0) * weight) / (sum(weight) OVER g), 0)) ELSE 0 END AS share FROM w WINDOW g AS (PARTITION BY spu, shop))
SELECT spu, shop, month, total::BIGINT AS total, CASE WHEN back = 1 THEN greatest(0, total - coalesce(sum(share) OVER (PARTITION BY spu, shop ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) ELSE share END::BIGINT AS share FROM s"""


@query(_SPLIT)
def win_11_allocation(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.planned_orders(spark, folder, by=["spu", "shop"]).where(F.col("month").between(F.lit(dt.date(2000, 6, 1)), F.lit(dt.date(2000, 12, 1))))
    n = F.least(F.months_between("month", F.lit(dt.date(2000, 6, 1))).cast("int"), F.lit(4))
    rows = rows.withColumn("total", F.sum("qty").over(Window.partitionBy("spu", "shop"))).withColumn("weight", F.col("qty") * F.get(F.array(*map(F.lit, (*DECAY, 5))), n))
    return reshape.allocate(rows, ["spu", "shop"], "month", "total", "weight", "share").select("spu", "shop", "month", "total", "share")


@query("SELECT month, dense_rank() OVER (ORDER BY month) AS place, coalesce([15, 12, 9, 6][dense_rank() OVER (ORDER BY month)], 5) AS weight FROM b_month")
def win_12_month_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights by place in the list of months (one row for each month of the data)."""
    months = b.monthly_sales(spark, folder).select("month").distinct()
    place = F.dense_rank().over(Window.orderBy("month"))
    return months.select("month", place.cast("bigint").alias("place")).select("month", "place", F.coalesce(F.get(F.array(*map(F.lit, DECAY)), (F.col("place") - 1).cast("int")), F.lit(5)).alias("weight"))


@query("SELECT order_id, line, count(*) AS copies FROM b_lines GROUP BY ALL HAVING count(*) > 1")
def win_13_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.duplicates(b.lines(spark, folder), ["order_id", "line"])


@query("SELECT fabric, part_id, (row_number() OVER (PARTITION BY fabric ORDER BY part_id) - 1) // 50 AS chunk FROM b_products")
def win_14_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.chunked(b.products(spark, folder).select("fabric", "part_id"), ["fabric"], ["part_id"], 50)


@query("SELECT part_id, floor(size * (1.0::DOUBLE + 0.5::DOUBLE * 1.0::DOUBLE) * (1.0::DOUBLE + 0.5::DOUBLE * 0.6::DOUBLE) * (1.0::DOUBLE + 0.5::DOUBLE * 0.36::DOUBLE))::BIGINT AS value FROM b_products")
def win_15_damped_product(spark: SparkSession, folder: str) -> DataFrame:
    value = F.aggregate(F.array(*map(F.lit, (1.0, 0.6, 0.36))), F.col("size").cast("double"), lambda acc, d: acc * (F.lit(1.0) + F.lit(0.5) * d))
    return b.products(spark, folder).select("part_id", F.floor(value).alias("value"))


# ---------------------------------------------------------------- reshaping


@query("SELECT o_orderkey AS order_id, unnest([1, 2, 3]) AS item FROM orders")
def exp_01_explode_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("item"))


@query("SELECT sku, shop, state, qty FROM (SELECT sku, shop, unnest(['sellable', 'in_transit']) AS state, unnest([sellable, in_transit]) AS qty FROM b_fba) WHERE qty > 0")
def exp_02_unpivot_positive(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.unpivot_named(b.fba_stock(spark, folder), ["sku", "shop"], {"sellable": "sellable", "in_transit": "in_transit"}, "state", "qty", "> 0")


@query("SELECT order_id, line, part_id, fee, rate FROM (SELECT order_id, line, part_id, unnest(['promotion', 'duty']) AS fee, unnest([discount, tax]) AS rate FROM b_lines) WHERE rate <> 0")
def exp_03_unpivot_fees(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.unpivot_named(b.lines(spark, folder), ["order_id", "line", "part_id"], {"discount": "promotion", "tax": "duty"}, "fee", "rate")


@query("SELECT sku, count(*) AS items, sum(rate)::BIGINT AS rate FROM (SELECT sku, unnest([discount, tax]) AS rate FROM b_lines) WHERE rate <> 0 GROUP BY sku")
def exp_04_fee_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = reshape.unpivot_named(b.lines(spark, folder), ["sku"], {"discount": "promotion", "tax": "duty"}, "fee", "rate")
    return rows.groupBy("sku").agg(F.count(F.lit(1)).alias("items"), F.sum("rate").alias("rate"))


@query("SELECT part_id, fabric, usage FROM (SELECT part_id, unnest([fabric, CASE WHEN size > 20 THEN name END]) AS fabric, unnest([size, CASE WHEN size > 30 THEN weight END]) AS usage FROM b_products) WHERE fabric IS NOT NULL OR usage IS NOT NULL")
def exp_05_unpivot_groups(spark: SparkSession, folder: str) -> DataFrame:
    wide = b.products(spark, folder).select("part_id", F.col("fabric").alias("f1"), F.col("size").alias("u1"), F.when(F.col("size") > 20, F.col("name")).alias("f2"), F.when(F.col("size") > 30, F.col("weight")).alias("u2"))
    return reshape.unpivot_groups(wide, ["part_id"], [{"fabric": "f1", "usage": "u1"}, {"fabric": "f2", "usage": "u2"}])


@query("SELECT sku, shop, month, sum(qty)::BIGINT AS qty FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-08-01' GROUP BY ALL HAVING sum(qty) <> 0")
def exp_06_unpivot_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Month columns by the pattern of their names, back to months."""
    planned = b.planned_orders(spark, folder).withColumn("label", dates.month_label(F.col("month")))
    wide = reshape.pivot_months(planned, ["sku", "shop"], "label", [f"00年{m}月销量" for m in (6, 7, 8)], "qty")
    columns = {c: c for c in wide.columns if "年" in c and c.endswith("月销量")}
    return reshape.unpivot_named(wide, ["sku", "shop"], columns, "label", "qty").select("sku", "shop", dates.month_of_label(F.col("label")).alias("month"), "qty")


@query("SELECT shop, " + ", ".join(f"sum(CASE WHEN month = DATE '2000-{m:02}-01' THEN qty ELSE 0 END)::BIGINT AS m{m}" for m in (4, 5, 6)) + " FROM b_sales GROUP BY shop")
def exp_07_pivot(spark: SparkSession, folder: str) -> DataFrame:
    sales = b.monthly_sales(spark, folder, by=["shop"]).withColumn("label", F.when(F.year("month") == 2000, F.concat(F.lit("m"), F.month("month").cast("string"))))
    return reshape.pivot_months(sales, ["shop"], "label", ["m4", "m5", "m6"], "qty")


@query("SELECT part_id, CASE WHEN size % 2 = 0 THEN weight ELSE size END AS promo, cost FROM b_products")
def exp_08_key_values(spark: SparkSession, folder: str) -> DataFrame:
    pair = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    last = F.when(F.col("size") % 2 == 0, F.lit("promo")).otherwise(F.lit("other"))
    pairs = F.array(pair(F.lit("promo"), F.col("size")), pair(F.lit("cost"), F.col("cost")), pair(last, F.col("weight")))
    return reshape.key_value_columns(b.products(spark, folder).withColumn("pairs", pairs), ["part_id"], "pairs", "k", "v", {"promo": "promo", "cost": "cost"})


@query("SELECT part_id, size AS a0, weight AS a1, NULL::BIGINT AS a7 FROM b_products")
def exp_09_positions(spark: SparkSession, folder: str) -> DataFrame:
    ages = F.array("size", "weight", "cost")
    return b.products(spark, folder).select("part_id", *(cells.position(ages, i).alias(f"a{i}") for i in (0, 1, 7)))


@query("SELECT part_id, box, item, qty FROM (SELECT part_id, box, item, size % (box + item + 1) AS qty FROM b_products, range(0, 2) x(box), range(0, 2) y(item)) WHERE qty > 0")
def exp_10_nested_boxes(spark: SparkSession, folder: str) -> DataFrame:
    boxes = F.transform(F.array(F.lit(0), F.lit(1)), lambda box: F.transform(F.array(F.lit(0), F.lit(1)), lambda item: F.col("size") % (box + item + 1)))
    rows = b.products(spark, folder).select("part_id", F.posexplode(boxes).alias("box", "items")).select("part_id", F.col("box").cast("bigint").alias("box"), F.posexplode("items").alias("item", "qty"))
    return rows.select("part_id", "box", F.col("item").cast("bigint").alias("item"), "qty").where("qty > 0")


@query("SELECT sku, unnest(generate_series(f, l, INTERVAL 1 MONTH))::DATE AS month FROM (SELECT sku, min(month) AS f, max(month) AS l FROM b_sales GROUP BY sku)")
def exp_11_calendar(spark: SparkSession, folder: str) -> DataFrame:
    spans = b.monthly_sales(spark, folder).groupBy("sku").agg(F.min("month").alias("f"), F.max("month").alias("l"))
    return reshape.calendar(spans, F.col("f"), F.col("l"), "month", "month").select("sku", "month")
