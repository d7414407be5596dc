"""Filters, projections, joins, aggregations, orders and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import codes, dates, numbers
from loomwright.functions.nulls import NONE, any_nonzero, or_default, present, sum_of
from loomwright.operators import lookup, ranking, reshape
from loomwright.queries.base import colour, query, ratio, spu
from loomwright.sources import business as b
from loomwright.sources.business import AS_OF, table

# ---------------------------------------------------------------- filters


@query("SELECT part_id, shop, qty FROM b_lines WHERE trim(shop) NOT IN ('', '无')")
def flt_01_present(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).where(present(F.col("shop"))).select("part_id", "shop", "qty")


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS qty FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_shipdate <= TIMESTAMP '2000-03-31'")
def flt_02_date_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").where(F.col("l_shipdate").between(F.lit(dt.datetime(2000, 1, 1)), F.lit(dt.datetime(2000, 3, 31))))
    return rows.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"))


@query("SELECT o_orderkey AS order_id FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'")
def flt_03_from_month(spark: SparkSession, folder: str) -> DataFrame:
    """The month of a time at or after a month: a plain comparison, which reaches the scan."""
    return table(spark, folder, "orders").where(F.col("o_orderdate") >= F.lit(dt.datetime(AS_OF.year, AS_OF.month, 1))).select(F.col("o_orderkey").alias("order_id"))


@query("SELECT c_custkey AS customer_id FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')")
def flt_04_in_list(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE")).select(F.col("c_custkey").alias("customer_id"))


@query("SELECT count(*) AS n, sum(cents)::BIGINT AS cents FROM b_lines WHERE discount <> 0 OR tax <> 0")
def flt_05_any_nonzero(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).where(any_nonzero(F.col("discount"), F.col("tax"))).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query("SELECT shop, count(*) AS n FROM b_lines WHERE shop NOT IN ('N1-US', 'N2-EU') GROUP BY shop")
def flt_06_excluded_shops(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).where(~F.col("shop").isin("N1-US", "N2-EU")).groupBy("shop").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS order_id FROM orders WHERE o_orderstatus <> 'F'")
def flt_07_status(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("order_id"))


@query("SELECT sku, shop, month, qty FROM b_planned WHERE qty > 0")
def flt_08_positive(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder).where("qty > 0").select("sku", "shop", "month", "qty")


@query("SELECT sku, shop, sellable, in_transit FROM b_fba WHERE sellable <> 0 OR in_transit <> 0")
def flt_09_all_zero_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder).where("sellable <> 0 or in_transit <> 0")


@query("SELECT part_id FROM b_products WHERE weight = 0")
def flt_10_weight_missing(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).where(F.coalesce(F.col("weight").cast("string").try_cast("double"), F.lit(0.0)) == 0).select("part_id")


@query("SELECT shop, sku FROM (SELECT shop, sku, sum(sum(CASE WHEN month >= DATE '2000-01-01' THEN qty ELSE 0 END)) OVER (PARTITION BY shop, spu) AS s FROM b_sales GROUP BY shop, spu, sku) WHERE s > 0")
def flt_11_style_sells(spark: SparkSession, folder: str) -> DataFrame:
    """All products of a style that sells in the shop."""
    recent = F.sum(F.when(F.col("month") >= F.lit(dt.date(2000, 1, 1)), F.col("qty")).otherwise(0))
    sales = b.monthly_sales(spark, folder)
    selling = sales.groupBy("shop", "spu").agg(recent.alias("s")).where("s > 0")
    return sales.select("shop", "spu", "sku").distinct().join(selling, ["shop", "spu"], "left_semi").select("shop", "sku")


@query("SELECT shop, sku, sum(qty)::BIGINT AS recent FROM b_sales WHERE month IN (DATE '2000-05-01', DATE '2000-04-01', DATE '2000-03-01') GROUP BY shop, sku HAVING sum(qty) > 0")
def flt_12_recent_sales(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder, dt.date(2000, 3, 1), dt.date(2000, 6, 1)).groupBy("shop", "sku").agg(F.sum("qty").alias("recent")).where("recent > 0")


@query("SELECT CASE WHEN shop = '无' THEN 'no shop' WHEN qty < 5 THEN 'too few' WHEN discount = 0 THEN 'no discount' ELSE 'ok' END AS reason, count(*) AS n FROM b_lines GROUP BY 1")
def flt_13_skip_reasons(spark: SparkSession, folder: str) -> DataFrame:
    reason = F.when(F.col("shop") == NONE, "no shop").when(F.col("qty") < 5, "too few").when(F.col("discount") == 0, "no discount").otherwise("ok")
    return b.lines(spark, folder).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM (SELECT event_id, user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events) WHERE was <> event_type")
def flt_15_changed(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql.window import Window

    was = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, folder, "events").select("event_id", "event_type", was.alias("was")).where("was <> event_type").select("event_id")


@query("SELECT sku, shop, qty FROM b_planned WHERE month = (SELECT max(month) FROM b_planned)")
def flt_16_latest_month(spark: SparkSession, folder: str) -> DataFrame:
    planned = b.planned_orders(spark, folder)
    latest = planned.agg(F.max("month").alias("month"))  # one row
    return planned.join(F.broadcast(latest), "month").select("sku", "shop", "qty")


@query("SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def flt_17_limit(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))


# ---------------------------------------------------------------- projections


@query("SELECT part_id, CASE WHEN part_id % 3 = 0 THEN '无' ELSE name END AS name, CASE WHEN weight = 0 THEN -1 ELSE weight END AS weight FROM b_products")
def prj_01_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Fields with defaults for null, '' and 0."""
    blank = F.when(F.col("part_id") % 3 == 0, F.lit("")).otherwise(F.col("name"))
    return b.products(spark, folder).select("part_id", or_default(blank, NONE).alias("name"), or_default(F.col("weight"), F.lit(-1).cast("bigint")).alias("weight"))


@query("SELECT order_id, line, part_id, sku, cents, discount + tax AS rates FROM b_lines")
def prj_02_profit_record(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).select("order_id", "line", "part_id", "sku", "cents", (F.col("discount") + F.col("tax")).alias("rates"))


@query("SELECT sku, shop, owner, deleted FROM b_owners")
def prj_03_listing(spark: SparkSession, folder: str) -> DataFrame:
    return b.owners(spark, folder).select("sku", "shop", "owner", "deleted")


@query("SELECT part_id, sku, CASE WHEN part_id % 3 = 0 THEN NULL ELSE size::DOUBLE END AS size FROM b_products")
def prj_04_number_or_null(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("part_id") % 3 == 0, F.lit(" ")).otherwise(F.col("size").cast("string"))
    return b.products(spark, folder).select("part_id", "sku", numbers.number_or_null(raw).alias("size"))


@query("SELECT sku, shop, strftime(month, '%Y-%m') AS month, qty FROM b_sales")
def prj_05_monthly_record(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder).select("sku", "shop", F.date_format("month", "yyyy-MM").alias("month"), "qty")


@query("SELECT sku, shop, available, pending FROM b_local WHERE available + pending <> 0")
def prj_06_inventory_record(spark: SparkSession, folder: str) -> DataFrame:
    return b.local_stock(spark, folder).where("available + pending <> 0")


@query("SELECT l_orderkey AS order_id, l_tax AS tax FROM lineitem")
def prj_07_pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_tax").alias("tax"))


@query("SELECT sku, shop, CASE WHEN n = 0 THEN 'T' ELSE 'T+' || n END AS label, qty FROM (SELECT *, datediff('month', DATE '2000-06-01', month) AS n FROM b_planned) WHERE n BETWEEN 0 AND 3")
def prj_08_relative_months(spark: SparkSession, folder: str) -> DataFrame:
    n = F.months_between("month", F.lit(dt.date(2000, 6, 1))).cast("int")
    rows = b.planned_orders(spark, folder).withColumn("n", n).where("n between 0 and 3")
    return rows.select("sku", "shop", F.when(F.col("n") == 0, "T").otherwise(F.concat(F.lit("T+"), F.col("n").cast("string"))).alias("label"), "qty")


# ---------------------------------------------------------------- joins


@query("SELECT fabric, sum(qty)::BIGINT AS qty, max(usage) AS usage FROM (SELECT spu, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY spu) JOIN b_pricing USING (spu) GROUP BY fabric")
def jn_01_inner_then_sum(spark: SparkSession, folder: str) -> DataFrame:
    styles = b.monthly_sales(spark, folder).groupBy("spu").agg(F.sum("qty").alias("qty"))
    return styles.join(b.fabric_pricing(spark, folder), "spu").groupBy("fabric").agg(F.sum("qty").alias("qty"), F.max("usage").alias("usage"))


@query("SELECT p.part_id, w.weight FROM b_products p LEFT JOIN (SELECT trim(sku) AS sku, max(weight) AS weight FROM b_products WHERE weight > 0 GROUP BY 1) w USING (sku)")
def jn_02_left_to_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    p = b.products(spark, folder)
    heaviest = p.where("weight > 0").groupBy(F.trim("sku").alias("sku")).agg(F.max("weight").alias("weight"))
    return p.select("part_id", "sku").join(heaviest, "sku", "left").select("part_id", "weight")


_RECORDS = """(SELECT order_id, line, part_id, sku, shop, 'own' || (supplier_id % 9) AS owner, date_trunc('month', shipped)::DATE AS month FROM b_lines WHERE shipped >= DATE '2000-01-01' AND shipped < DATE '2001-01-01')"""


def _records(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.lines(spark, folder, dt.date(2000, 1, 1), dt.date(2001, 1, 1))
    return rows.select("order_id", "line", "part_id", "sku", "shop", F.concat(F.lit("own"), (F.col("supplier_id") % 9).cast("string")).alias("owner"), dates.month_of(F.col("shipped")).alias("month"))


@query(f"SELECT count(*) AS n, count(f.price) AS priced, sum(f.price)::BIGINT AS price FROM {_RECORDS} r LEFT JOIN b_freight f USING (shop, owner, month)")
def jn_03_left_three_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).join(b.freight(spark, folder), ["shop", "owner", "month"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("priced"), F.sum("price").alias("price"))


@query(f"SELECT count(*) AS n, count(f.price) AS priced, count(w.weight) AS weighed FROM {_RECORDS} r LEFT JOIN b_freight f USING (shop, owner, month) LEFT JOIN (SELECT sku, max(weight) AS weight FROM b_products WHERE weight > 0 GROUP BY sku) w USING (sku)")
def jn_04_chained_left(spark: SparkSession, folder: str) -> DataFrame:
    heaviest = b.products(spark, folder).where("weight > 0").groupBy("sku").agg(F.max("weight").alias("weight"))
    rows = _records(spark, folder).join(b.freight(spark, folder), ["shop", "owner", "month"], "left").join(heaviest, "sku", "left")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("priced"), F.count("weight").alias("weighed"))


_ORDERED = "(SELECT sku, shop, date_trunc('month', ordered)::DATE AS month, sum(qty)::BIGINT AS ordered_qty FROM b_purchases WHERE shop <> '无' GROUP BY ALL)"


def _ordered(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.purchases(spark, folder).where(F.col("shop") != NONE)
    return rows.groupBy("sku", "shop", dates.month_of(F.col("ordered")).alias("month")).agg(F.sum("qty").alias("ordered_qty"))


@query(f"SELECT sku, shop, month, coalesce(ordered_qty, 0) AS ordered_qty, coalesce(qty, 0) AS planned_qty, coalesce(owner, '') AS owner FROM {_ORDERED} o FULL JOIN b_planned USING (sku, shop, month)")
def jn_05_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    planned = b.planned_orders(spark, folder).select("sku", "shop", "month", F.col("qty").alias("planned_qty"), "owner")
    return _ordered(spark, folder).join(planned, ["sku", "shop", "month"], "full_outer").na.fill(0, ["ordered_qty", "planned_qty"]).na.fill("", ["owner"])


@query("SELECT spu, shop, month, coalesce(s.qty, 0)::BIGINT AS sold, coalesce(p.qty, 0)::BIGINT AS planned FROM (SELECT spu, shop, month, sum(qty) AS qty FROM b_sales GROUP BY ALL) s FULL JOIN (SELECT spu, shop, month, sum(qty) AS qty FROM b_planned GROUP BY ALL) p USING (spu, shop, month)")
def jn_06_full_outer_styles(spark: SparkSession, folder: str) -> DataFrame:
    of = lambda table, n: table(spark, folder, by=["spu", "shop"]).select("spu", "shop", "month", F.col("qty").alias(n))
    return of(b.monthly_sales, "sold").join(of(b.planned_orders, "planned"), ["spu", "shop", "month"], "full_outer").na.fill(0)


@query("SELECT sku, month, coalesce(s.qty, 0)::BIGINT AS sold, coalesce(p.qty, 0)::BIGINT AS planned FROM (SELECT sku, month, sum(qty) AS qty FROM b_sales GROUP BY ALL) s FULL JOIN (SELECT sku, month, sum(qty) AS qty FROM b_planned GROUP BY ALL) p USING (sku, month)")
def jn_07_full_outer_products(spark: SparkSession, folder: str) -> DataFrame:
    of = lambda table, n: table(spark, folder, by=["sku"]).select("sku", "month", F.col("qty").alias(n))
    return of(b.monthly_sales, "sold").join(of(b.planned_orders, "planned"), ["sku", "month"], "full_outer").na.fill(0)


@query("SELECT sku, shop, sellable, available FROM b_fba JOIN b_local USING (sku, shop) WHERE shop <> '无'")
def jn_08_inner_stocks(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder).where(F.col("shop") != NONE).join(b.local_stock(spark, folder), ["sku", "shop"]).select("sku", "shop", "sellable", "available")


@query("SELECT sku, shop FROM b_fba f WHERE shop <> '无' AND NOT EXISTS (SELECT 1 FROM b_local l WHERE l.sku = f.sku AND l.shop = f.shop) AND NOT EXISTS (SELECT 1 FROM b_local l WHERE l.sku = f.sku AND l.shop = '无')")
def jn_09_only_left(spark: SparkSession, folder: str) -> DataFrame:
    local = b.local_stock(spark, folder)
    rows = b.fba_stock(spark, folder).where(F.col("shop") != NONE).join(local, ["sku", "shop"], "left_anti")
    return rows.join(local.where(F.col("shop") == NONE), "sku", "left_anti").select("sku", "shop")


@query("SELECT DISTINCT sku FROM b_fba SEMI JOIN b_local USING (sku)")
def jn_10_semi(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder).select("sku").distinct().join(b.local_stock(spark, folder), "sku", "left_semi")


@query("SELECT l.sku, l.shop, f.sellable FROM b_fba f JOIN b_local l USING (sku) WHERE f.shop = '无' AND l.shop <> '无'")
def jn_11_wildcard_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    wild = b.fba_stock(spark, folder).where(F.col("shop") == NONE).select("sku", "sellable")
    return b.local_stock(spark, folder).where(F.col("shop") != NONE).join(wild, "sku").select("sku", "shop", "sellable")


@query("SELECT s.sku, s.shop, coalesce(e.available, 0) + coalesce(g.available, 0) AS available FROM (SELECT DISTINCT sku, shop FROM b_sales) s LEFT JOIN b_local e ON e.sku = s.sku AND e.shop = s.shop LEFT JOIN b_local g ON g.sku = s.sku AND g.shop = '无'")
def jn_12_wildcard_additive(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.wildcard_additive(b.monthly_sales(spark, folder).select("sku", "shop").distinct(), b.local_stock(spark, folder), "sku", "shop", ["available"])


@query("WITH t AS (SELECT p.spu, shop, sum(available)::BIGINT AS available FROM b_local l JOIN (SELECT DISTINCT sku, spu FROM b_products) p USING (sku) GROUP BY ALL) SELECT s.spu, s.shop, coalesce(e.available, 0) + coalesce(g.available, 0) AS available FROM (SELECT DISTINCT spu, shop FROM b_sales) s LEFT JOIN t e ON e.spu = s.spu AND e.shop = s.shop LEFT JOIN t g ON g.spu = s.spu AND g.shop = '无'")
def jn_13_wildcard_styles(spark: SparkSession, folder: str) -> DataFrame:
    stock = b.local_stock(spark, folder).withColumn("spu", codes.spu_of(F.col("sku"))).groupBy("spu", "shop").agg(F.sum("available").alias("available"))
    return lookup.wildcard_additive(b.monthly_sales(spark, folder).select("spu", "shop").distinct(), stock, "spu", "shop", ["available"])


@query("SELECT sku, month, fabric, qty FROM (SELECT sku, spu, month, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY ALL) JOIN b_pricing USING (spu)")
def jn_14_one_to_many(spark: SparkSession, folder: str) -> DataFrame:
    planned = b.planned_orders(spark, folder).groupBy("sku", "spu", "month").agg(F.sum("qty").alias("qty"))
    return planned.join(b.fabric_pricing(spark, folder), "spu").select("sku", "month", "fabric", "qty")


@query("SELECT p.part_id, min(c.prefix) AS prefix FROM b_products p LEFT JOIN (SELECT DISTINCT spu AS prefix FROM b_products WHERE part_id % 3 = 0 UNION SELECT DISTINCT spu || '-RED' FROM b_products) c ON starts_with(p.sku, c.prefix || '-') GROUP BY p.part_id")
def jn_15_prefix(spark: SparkSession, folder: str) -> DataFrame:
    p = b.products(spark, folder)
    prefixes = p.where("part_id % 3 = 0").select(F.col("spu").alias("prefix")).union(p.select(F.concat("spu", F.lit("-RED")))).distinct()
    return lookup.prefix_lookup(p.select("part_id", "sku"), "sku", prefixes, "prefix", "prefix", "prefix").select("part_id", "prefix")


@query("SELECT shop, avg_price FROM (SELECT DISTINCT shop, split_part(shop, '-', 1) || '-' AS brand FROM b_shops WHERE shop <> '无') LEFT JOIN (SELECT split_part(shop, '-', 1) || '-' AS brand, sum(price)::DOUBLE / count(*)::DOUBLE AS avg_price FROM b_freight GROUP BY 1) USING (brand)")
def jn_16_brand_prefix(spark: SparkSession, folder: str) -> DataFrame:
    mean = b.freight(spark, folder).groupBy(codes.brand_of(F.col("shop")).alias("brand")).agg((F.sum("price").cast("double") / F.count(F.lit(1))).alias("avg_price"))
    shops = b.shops(spark, folder).where(F.col("shop") != NONE).select("shop").distinct().withColumn("brand", codes.brand_of(F.col("shop")))
    return shops.join(mean, "brand", "left").select("shop", "avg_price")


@query("""WITH f AS (SELECT shop, month, min(price) AS price FROM b_freight GROUP BY ALL), r AS (SELECT shop, make_date(2000, m::INT, 1) AS month FROM (SELECT DISTINCT shop FROM b_freight), range(1, 13) t(m))
SELECT r.shop, r.month, arg_max(f.price, f.month) AS price FROM r LEFT JOIN f ON f.shop = r.shop AND f.month BETWEEN (r.month - INTERVAL 2 MONTH)::DATE AND r.month GROUP BY ALL""")
def jn_17_as_of_months(spark: SparkSession, folder: str) -> DataFrame:
    prices = b.freight(spark, folder).groupBy("shop", "month").agg(F.min("price").alias("price"))
    probe = prices.select("shop").distinct().withColumn("month", F.explode(F.expr("sequence(date'2000-01-01', date'2000-12-01', interval 1 month)")))
    return lookup.as_of_months(probe, prices, ["shop"], "month", "price", 2, "price", ["shop", "month"]).select("shop", "month", "price")


@query("SELECT part_id, coalesce(w::DOUBLE, s) AS weight, CASE WHEN w IS NOT NULL THEN 'sku' WHEN s IS NOT NULL THEN 'spu' END AS weight_level FROM (SELECT part_id, nullif(weight, 0) AS w, spu FROM b_products) LEFT JOIN (SELECT spu, sum(weight)::DOUBLE / count(*)::DOUBLE AS s FROM b_products WHERE weight > 0 GROUP BY spu) USING (spu)")
def jn_19_two_levels(spark: SparkSession, folder: str) -> DataFrame:
    p = b.products(spark, folder)
    own = p.where("weight > 0").select("part_id", F.col("weight").cast("double").alias("weight"))
    style = p.where("weight > 0").groupBy("spu").agg((F.sum("weight").cast("double") / F.count(F.lit(1))).alias("mean"))
    return lookup.fallback_lookup(p.select("part_id", "spu"), [(own, ["part_id"], "weight", "sku"), (style, ["spu"], "mean", "spu")], "weight").select("part_id", "weight", "weight_level")


@query("""WITH po AS (SELECT spu, shop, arg_min(owner, (month, sku)) AS o FROM b_planned WHERE owner <> '' GROUP BY ALL), lo AS (SELECT spu, shop, arg_min(owner, (ordinal, owner)) AS o FROM b_owners WHERE owner <> '' GROUP BY ALL)
SELECT spu, shop, coalesce(po.o, lo.o, '') AS owner FROM (SELECT DISTINCT spu, shop FROM b_sales) LEFT JOIN po USING (spu, shop) LEFT JOIN lo USING (spu, shop)""")
def jn_20_owner_cascade(spark: SparkSession, folder: str) -> DataFrame:
    plan = ranking.first_wins(b.planned_orders(spark, folder).where("owner <> ''"), ["spu", "shop"], ["month", "sku"], ["owner"])
    listed = ranking.first_wins(b.owners(spark, folder).where("owner <> ''"), ["spu", "shop"], ["ordinal", "owner"], ["owner"])
    probe = b.monthly_sales(spark, folder).select("spu", "shop").distinct()
    found = lookup.fallback_lookup(probe, [(plan, ["spu", "shop"], "owner", "plan"), (listed, ["spu", "shop"], "owner", "listing")], "owner")
    return found.select("spu", "shop", F.coalesce("owner", F.lit("")).alias("owner"))


@query("""WITH lo AS (SELECT sku, shop, arg_min(owner, (ordinal, owner)) AS o FROM b_owners WHERE owner <> '' GROUP BY ALL)
SELECT sku, shop, coalesce(o, 'style ' || spu) AS owner FROM (SELECT DISTINCT sku, spu, shop FROM b_sales) LEFT JOIN lo USING (sku, shop)""")
def jn_21_owner_of_product(spark: SparkSession, folder: str) -> DataFrame:
    listed = ranking.first_wins(b.owners(spark, folder).where("owner <> ''"), ["sku", "shop"], ["ordinal", "owner"], ["owner"])
    return lookup.with_default(b.monthly_sales(spark, folder).select("sku", "spu", "shop").distinct(), listed, ["sku", "shop"], "owner", F.concat(F.lit("style "), F.col("spu"))).select("sku", "shop", "owner")


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, coalesce(CASE WHEN s_suppkey % 5 <> 0 THEN s_name END, '无') AS supplier, l_partkey AS part_id FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey")
def jn_22_dimension_default(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "supplier").where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier"))
    rows = lookup.with_default(table(spark, folder, "lineitem"), names, ["l_suppkey"], "supplier", F.lit(NONE))
    return rows.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), "supplier", F.col("l_partkey").alias("part_id"))


@query(f"SELECT part_id, coalesce(m.merged, c) AS colour FROM (SELECT part_id, fabric, {colour('sku', 3)} AS c FROM b_products) LEFT JOIN (SELECT fabric, 'RED' AS c, 'WARM' AS merged FROM b_custom UNION ALL SELECT fabric, 'BLUE', 'COLD' FROM b_custom) m USING (fabric, c)")
def jn_23_merged_colour(spark: SparkSession, folder: str) -> DataFrame:
    custom = b.custom_fabrics(spark, folder).select("fabric")
    merged = custom.select("fabric", F.lit("RED").alias("c"), F.lit("WARM").alias("merged")).union(custom.select("fabric", F.lit("BLUE"), F.lit("COLD")))
    rows = b.products(spark, folder).select("part_id", "fabric", codes.colour_of(F.col("sku"), 3).alias("c"))
    return rows.join(merged, ["fabric", "c"], "left").select("part_id", F.coalesce("merged", "c").alias("colour"))


@query(f"SELECT fabric || '-' || CASE WHEN c = 'RED' THEN 'WARM' ELSE c END AS code, sum(size)::BIGINT AS size FROM (SELECT fabric, {colour('sku', 3)} AS c, size FROM b_products) GROUP BY 1")
def jn_24_rewritten_key(spark: SparkSession, folder: str) -> DataFrame:
    merged = spark.createDataFrame([("RED", "WARM")], "c string, merged string")
    rows = b.products(spark, folder).select("fabric", codes.colour_of(F.col("sku"), 3).alias("c"), "size").join(F.broadcast(merged), "c", "left")
    return rows.groupBy(F.concat_ws("-", "fabric", F.coalesce("merged", "c")).alias("code")).agg(F.sum("size").alias("size"))


@query("SELECT part_id, min(CASE WHEN t.name = p.name THEN t.code END) AS exact, coalesce(min(CASE WHEN t.name = p.name THEN t.code END), min(t.code)) AS code FROM (SELECT part_id, CASE WHEN part_id % 2 = 0 THEN name ELSE upper(name) END AS name FROM b_products) p LEFT JOIN (SELECT name, min(part_id) AS code FROM b_products GROUP BY name) t ON upper(t.name) = upper(p.name) GROUP BY part_id")
def jn_25_case_fallback(spark: SparkSession, folder: str) -> DataFrame:
    p = b.products(spark, folder)
    exact = p.groupBy("name").agg(F.min("part_id").alias("exact"))
    folded = exact.groupBy(F.upper("name").alias("upper")).agg(F.min("exact").alias("any_case"))
    probe = p.select("part_id", F.when(F.col("part_id") % 2 == 0, F.col("name")).otherwise(F.upper("name")).alias("name")).withColumn("upper", F.upper("name"))
    return probe.join(exact, "name", "left").join(folded, "upper", "left").select("part_id", "exact", F.coalesce("exact", "any_case").alias("code"))


@query("SELECT p.spu, p.fabric, coalesce(usage, mean) AS usage FROM b_pricing p LEFT JOIN (SELECT fabric, sum(usage)::BIGINT // count(*) AS mean FROM b_pricing WHERE usage > 0 GROUP BY fabric) USING (fabric)")
def jn_26_average_of_others(spark: SparkSession, folder: str) -> DataFrame:
    pricing = b.fabric_pricing(spark, folder)
    mean = pricing.where("usage > 0").groupBy("fabric").agg(F.expr("sum(usage) div count(*)").alias("mean"))
    return pricing.join(mean, "fabric", "left").select("spu", "fabric", F.coalesce("usage", "mean").alias("usage"))


@query("SELECT a.shop, a.sku, a.month, a.qty, coalesce(p.qty, 0) AS year_ago FROM b_sales a LEFT JOIN b_sales p ON p.shop = a.shop AND p.sku = a.sku AND p.month = (a.month - INTERVAL 12 MONTH)::DATE")
def jn_28_year_ago(spark: SparkSession, folder: str) -> DataFrame:
    sales = b.monthly_sales(spark, folder).select("shop", "sku", "month", "qty")
    before = sales.select("shop", "sku", F.add_months("month", 12).alias("month"), F.col("qty").alias("year_ago"))
    return sales.join(before, ["shop", "sku", "month"], "left").na.fill(0, ["year_ago"])


@query("SELECT order_id, line, sku, cost FROM b_lines WHERE weight = 0")
def jn_29_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).where("weight = 0").select("order_id", "line", "sku", "cost")


@query("WITH f(id, shop) AS (VALUES (1, 'fixed one'), (3, 'fixed three')) SELECT id::BIGINT AS id, shop FROM f UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (1, 3)")
def jn_30_overlay(spark: SparkSession, folder: str) -> DataFrame:
    fixed = spark.createDataFrame([(1, "fixed one"), (3, "fixed three")], "id long, shop string")
    return lookup.overlay(fixed, table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("shop")), ["id"])


@query("SELECT part_id, c.fabric IS NOT NULL AS is_custom FROM b_products LEFT JOIN b_custom c USING (fabric)")
def jn_31_membership(spark: SparkSession, folder: str) -> DataFrame:
    custom = b.custom_fabrics(spark, folder).select("fabric", F.lit(True).alias("is_custom"))
    return lookup.with_default(b.products(spark, folder), custom, ["fabric"], "is_custom", F.lit(False)).select("part_id", "is_custom")


# ---------------------------------------------------------------- aggregations


@query("SELECT * FROM b_fba")
def agg_01_stock_by_shop(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder)


@query(f"SELECT {spu('sku')} AS spu, shop, sum(coalesce(sellable, 0))::BIGINT AS sellable FROM b_fba GROUP BY ALL")
def agg_02_styles(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder).groupBy(codes.spu_of(F.col("sku")).alias("spu"), "shop").agg(F.sum(F.coalesce("sellable", F.lit(0).cast("bigint"))).alias("sellable"))


@query("SELECT spu, shop, sum(CASE WHEN state = 'O' THEN qty ELSE 0 END)::BIGINT AS open_qty, sum(CASE WHEN state = 'F' THEN qty ELSE 0 END)::BIGINT AS filled_qty FROM b_lines GROUP BY ALL")
def agg_03_routed_by_status(spark: SparkSession, folder: str) -> DataFrame:
    by = lambda s: F.sum(F.when(F.col("state") == s, F.col("qty")).otherwise(0))
    return b.lines(spark, folder).groupBy("spu", "shop").agg(by("O").alias("open_qty"), by("F").alias("filled_qty"))


@query("SELECT sku, month, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY ALL")
def agg_04_by_product_month(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder).groupBy("sku", "month").agg(F.sum("qty").alias("qty"))


@query("SELECT spu, sum(a)::BIGINT AS available FROM (SELECT spu, sku, sum(available) AS a FROM b_local JOIN (SELECT DISTINCT sku, spu FROM b_products) USING (sku) GROUP BY ALL HAVING sum(available) > 10) GROUP BY spu")
def agg_05_two_levels(spark: SparkSession, folder: str) -> DataFrame:
    by_sku = b.local_stock(spark, folder).groupBy("sku").agg(F.sum("available").alias("a")).where("a > 10")
    return by_sku.groupBy(codes.spu_of(F.col("sku")).alias("spu")).agg(F.sum("a").alias("available"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 1")
def agg_06_by_expression(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    return rows.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


@query("SELECT shop, sku, sum(cents)::BIGINT AS cents, sum(qty)::BIGINT AS qty, sum(discount)::BIGINT AS discount, sum(tax)::BIGINT AS tax FROM b_lines WHERE shipped >= DATE '2000-05-01' AND shipped < DATE '2000-06-01' GROUP BY ALL")
def agg_07_four_sums(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.lines(spark, folder, dt.date(2000, 5, 1), dt.date(2000, 6, 1))
    return rows.groupBy("shop", "sku").agg(*(F.sum(c).alias(c) for c in ("cents", "qty", "discount", "tax")))


@query("SELECT shop, sum(CASE WHEN flag = 'A' THEN qty ELSE 0 END)::BIGINT AS a, sum(CASE WHEN flag = 'N' THEN qty ELSE 0 END)::BIGINT AS n, sum(CASE WHEN flag = 'R' THEN qty ELSE 0 END)::BIGINT AS r FROM b_lines GROUP BY shop")
def agg_08_pivot_sums(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).groupBy("shop").agg(*(F.sum(F.when(F.col("flag") == f.upper(), F.col("qty")).otherwise(0)).alias(f) for f in "anr"))


@query("SELECT shop, count(*) AS n, sum(qty)::BIGINT AS qty FROM b_lines GROUP BY shop ORDER BY n DESC, shop")
def agg_09_counts_by_size(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).groupBy("shop").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty")).orderBy(F.desc("n"), "shop")


@query("SELECT count(*) AS n, sum(qty)::BIGINT AS qty, sum(discount + tax)::BIGINT AS rates, min(shipped) AS first, max(shipped) AS last FROM b_lines")
def agg_10_global(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"), F.sum(F.col("discount") + F.col("tax")).alias("rates"), F.min("shipped").alias("first"), F.max("shipped").alias("last"))


@query("SELECT sku, max(weight) AS weight FROM b_products GROUP BY sku")
def agg_11_max_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).groupBy("sku").agg(F.max("weight").alias("weight"))


@query("SELECT max(month) AS month FROM b_planned")
def agg_12_max(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder).agg(F.max("month").alias("month"))


@query("SELECT spu, string_agg(DISTINCT fabric, ',' ORDER BY fabric) AS fabrics FROM b_products GROUP BY spu")
def agg_13_joined_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).groupBy("spu").agg(F.array_join(F.array_sort(F.collect_set("fabric")), ",").alias("fabrics"))


@query("SELECT DISTINCT spu, fabric FROM b_products")
def agg_14_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).select("spu", "fabric").distinct()


@query("SELECT spu, sum(weight)::DOUBLE / count(*) AS mean FROM b_products WHERE weight > 0 GROUP BY spu")
def agg_15_mean(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).where("weight > 0").groupBy("spu").agg((F.sum("weight").cast("double") / F.count(F.lit(1))).alias("mean"))


@query("SELECT fabric, sum(qty)::BIGINT AS qty, sum(cents)::BIGINT AS cents, string_agg(DISTINCT spu, ',' ORDER BY spu) FILTER (weight = 0) AS missing FROM b_lines GROUP BY fabric")
def agg_16_sums_and_sets(spark: SparkSession, folder: str) -> DataFrame:
    missing = F.array_join(F.array_sort(F.collect_set(F.when(F.col("weight") == 0, F.col("spu")))), ",")
    return b.lines(spark, folder).groupBy("fabric").agg(F.sum("qty").alias("qty"), F.sum("cents").alias("cents"), F.nullif(missing, F.lit("")).alias("missing"))


@query("SELECT fabric, count(DISTINCT spu) AS styles FROM b_products GROUP BY fabric")
def agg_17_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).groupBy("fabric").agg(F.countDistinct("spu").alias("styles"))


@query("SELECT spu, shop, flag, state, status, sum(qty)::BIGINT AS qty, min(priority) AS priority FROM b_lines GROUP BY ALL")
def agg_18_five_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The smallest text is taken of few rows: taken of lines, each task would sort all of its own."""
    keys = ["spu", "shop", "flag", "state", "status"]
    return b.lines(spark, folder).groupBy(*keys, "priority").agg(F.sum("qty").alias("qty")).groupBy(*keys).agg(F.sum("qty").alias("qty"), F.min("priority").alias("priority"))


@query("SELECT sku, shop, count(*) AS n, arg_max(owner, (ordinal, owner)) FILTER (owner <> '') AS owner FROM b_owners GROUP BY ALL")
def agg_19_last_present(spark: SparkSession, folder: str) -> DataFrame:
    some = F.when(F.col("owner") != "", F.struct("ordinal", "owner"))
    return b.owners(spark, folder).groupBy("sku", "shop").agg(F.count(F.lit(1)).alias("n"), F.max(some)["owner"].alias("owner"))


@query("SELECT * FROM b_sales")
def agg_20_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder)


@query("SELECT spu, shop, month, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY ALL")
def agg_21_style_roll_up(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder, by=["spu", "shop"])


@query("SELECT spu, shop, month, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY ALL")
def agg_22_planned_styles(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder, by=["spu", "shop"]).select("spu", "shop", "month", "qty")


@query("SELECT order_id AS box, spu, sum(qty)::BIGINT AS qty, min(nullif(CASE WHEN line % 2 = 0 THEN '' ELSE name END, '')) AS name FROM b_lines GROUP BY ALL")
def agg_23_box_contents(spark: SparkSession, folder: str) -> DataFrame:
    some = F.when(F.col("line") % 2 != 0, F.nullif("name", F.lit("")))
    return b.lines(spark, folder).groupBy(F.col("order_id").alias("box"), "spu").agg(F.sum("qty").alias("qty"), F.min(some).alias("name"))


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_suppkey AS supplier_id, (round(l_extendedprice * 100)::BIGINT + round(l_discount * 100)::BIGINT + round(l_tax * 100)::BIGINT) AS total FROM lineitem")
def agg_24_row_sum(spark: SparkSession, folder: str) -> DataFrame:
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("l_extendedprice", "l_discount", "l_tax")]
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"), sum_of(*cents).alias("total"))


@query(f"SELECT shop, sku, {ratio('sum(CASE WHEN month = DATE $$2000-05-01$$ THEN 6 * qty WHEN month = DATE $$2000-04-01$$ THEN 3 * qty WHEN month = DATE $$2000-03-01$$ THEN qty END)', 'sum(CASE WHEN month = DATE $$2000-05-01$$ THEN 6 WHEN month = DATE $$2000-04-01$$ THEN 3 WHEN month = DATE $$2000-03-01$$ THEN 1 END)')} AS mean FROM b_sales WHERE month BETWEEN DATE '2000-03-01' AND DATE '2000-05-01' GROUP BY ALL".replace("$$", "'"))
def agg_25_weighted_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of the months that are there, renormalised."""
    w = F.when(F.col("month") == F.lit(dt.date(2000, 5, 1)), 6).when(F.col("month") == F.lit(dt.date(2000, 4, 1)), 3).otherwise(1)
    rows = b.monthly_sales(spark, folder, dt.date(2000, 3, 1), dt.date(2000, 6, 1)).withColumn("w", w)
    return rows.groupBy("shop", "sku").agg(numbers.ratio(F.sum(F.col("w") * F.col("qty")), F.sum("w")).alias("mean"))


@query("SELECT sku, sum((cents * tax) // 100)::BIGINT AS fee FROM b_lines GROUP BY sku")
def agg_26_rounded_fees(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).groupBy("sku").agg(F.sum(F.expr("(cents * tax) div 100")).alias("fee"))


@query("SELECT count(*) AS n, count(*) FILTER (weight > 0) AS weighed, count(*) FILTER (shop = '无') AS without_shop, count(*) FILTER (discount = 0) AS undiscounted FROM b_lines")
def agg_27_match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return b.lines(spark, folder).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("weight") > 0).alias("weighed"), F.count_if(F.col("shop") == NONE).alias("without_shop"), F.count_if(F.col("discount") == 0).alias("undiscounted"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5")
def agg_28_top_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(5)


@query("SELECT month, sum(CASE WHEN shop LIKE '%US' THEN qty ELSE 0 END)::BIGINT AS us, sum(CASE WHEN shop LIKE '%EU' THEN qty ELSE 0 END)::BIGINT AS eu FROM b_sales GROUP BY month")
def agg_29_months_by_region(spark: SparkSession, folder: str) -> DataFrame:
    by = lambda x: F.sum(F.when(F.endswith("shop", F.lit(x)), F.col("qty")).otherwise(0))
    return b.monthly_sales(spark, folder, by=["shop"]).groupBy("month").agg(by("US").alias("us"), by("EU").alias("eu"))


# ---------------------------------------------------------------- order, set operations


@query("SELECT spu, shop, month, qty FROM b_sales ORDER BY shop, spu, month, qty")
def srt_01_order_by(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder).select("spu", "shop", "month", "qty").orderBy("shop", "spu", "month", "qty")


@query("SELECT fabric, spu, part_id FROM b_products ORDER BY fabric DESC, spu, part_id")
def srt_02_mixed_order(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).select("fabric", "spu", "part_id").orderBy(F.desc("fabric"), "spu", "part_id")


@query("SELECT month, sku, shop, qty FROM b_planned QUALIFY row_number() OVER (PARTITION BY month ORDER BY qty DESC, sku, shop) <= 5")
def srt_03_top_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top(b.planned_orders(spark, folder).select("month", "sku", "shop", "qty"), ["month"], [F.desc("qty"), "sku", "shop"], 5)


@query("SELECT sku, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY sku ORDER BY qty DESC, sku LIMIT 10")
def srt_04_top_ten(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder).groupBy("sku").agg(F.sum("qty").alias("qty")).orderBy(F.desc("qty"), "sku").limit(10)


@query("SELECT spu, shop, month, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY ALL ORDER BY spu, shop, month")
def srt_05_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder, by=["spu", "shop"]).select("spu", "shop", "month", "qty").orderBy("spu", "shop", "month")


@query("SELECT spu, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY spu ORDER BY qty DESC, spu")
def srt_06_by_sum(spark: SparkSession, folder: str) -> DataFrame:
    return b.monthly_sales(spark, folder).groupBy("spu").agg(F.sum("qty").alias("qty")).orderBy(F.desc("qty"), "spu")


@query("SELECT DISTINCT month, strftime(month, '%y') || '年' || month(month) || '月销量' AS label FROM b_planned ORDER BY month")
def srt_07_months(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder).select("month").distinct().select("month", dates.month_label(F.col("month")).alias("label")).orderBy("month")


@query("SELECT fabric, string_agg(DISTINCT spu, ',' ORDER BY spu) AS styles FROM b_products GROUP BY fabric")
def srt_08_sorted_sets(spark: SparkSession, folder: str) -> DataFrame:
    return b.products(spark, folder).groupBy("fabric").agg(F.array_join(F.array_sort(F.collect_set("spu")), ",").alias("styles"))


@query("SELECT part_id FROM b_products p WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = part_id AND l_quantity = 50)")
def srt_09_exists(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("part_id"))
    return b.products(spark, folder).select("part_id").join(sold, "part_id", "left_semi")


_KEYS = ("(SELECT DISTINCT sku, shop FROM b_fba)", "(SELECT DISTINCT sku, shop FROM b_local)")


def _keys(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return b.fba_stock(spark, folder).select("sku", "shop"), b.local_stock(spark, folder).select("sku", "shop")


@query(f"SELECT * FROM {_KEYS[0]} UNION SELECT * FROM {_KEYS[1]}")
def set_01_union(spark: SparkSession, folder: str) -> DataFrame:
    f, l = _keys(spark, folder)  # noqa: E741
    return f.union(l).distinct()


@query(f"SELECT * FROM {_KEYS[0]} INTERSECT SELECT * FROM {_KEYS[1]}")
def set_02_intersect(spark: SparkSession, folder: str) -> DataFrame:
    f, l = _keys(spark, folder)  # noqa: E741
    return f.intersect(l)


@query(f"SELECT * FROM {_KEYS[0]} EXCEPT SELECT * FROM {_KEYS[1]}")
def set_03_except(spark: SparkSession, folder: str) -> DataFrame:
    f, l = _keys(spark, folder)  # noqa: E741
    return f.subtract(l)


@query("SELECT sku, shop, sellable AS qty FROM b_fba UNION ALL SELECT sku, shop, available FROM b_local")
def set_04_union_all(spark: SparkSession, folder: str) -> DataFrame:
    return b.fba_stock(spark, folder).select("sku", "shop", F.col("sellable").alias("qty")).unionByName(b.local_stock(spark, folder).select("sku", "shop", F.col("available").alias("qty")))


@query("SELECT 'style' AS grain, spu AS code, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY spu UNION ALL SELECT 'product', sku, sum(qty)::BIGINT FROM b_sales GROUP BY sku")
def set_05_two_grains(spark: SparkSession, folder: str) -> DataFrame:
    sales = b.monthly_sales(spark, folder)
    grain = lambda name, c: sales.groupBy(F.col(c).alias("code")).agg(F.sum("qty").alias("qty")).select(F.lit(name).alias("grain"), "code", "qty")
    return grain("style", "spu").unionByName(grain("product", "sku"))


@query("SELECT DISTINCT (month - to_months(k))::DATE AS month FROM b_month, range(0, 3) t(k)")
def set_06_months_read(spark: SparkSession, folder: str) -> DataFrame:
    back = F.explode(F.array(*[F.add_months("month", -k) for k in range(3)]))
    return b.monthly_sales(spark, folder).select("month").distinct().select(back.alias("month")).distinct()
