"""Scans of databases, pages and landed records."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions.codes import shop_name
from loomwright.operators import ranking
from loomwright.queries.base import query
from loomwright.sinks.files import fresh_path, spread, tasks_for, written
from loomwright.sources import business as b
from loomwright.sources import paged, stores
from loomwright.sources.business import table


def _landed(spark: SparkSession, rows: DataFrame, slices: list[str], key: list[str], page: int) -> DataFrame:
    """Rows of a table, landed slice by slice as pages of up to ``page`` records, and read back from the pages."""
    path = fresh_path(spark, "pages")
    rows = written(rows, "pages-rows")
    paged_rows = spread(ranking.chunked(rows, slices, key, page, "page"), tasks_for(rows), *slices, "page")
    pages = paged_rows.groupBy(*slices, "page").agg(F.collect_list(F.struct(*rows.columns)).alias("items"))  # at most ``page`` records
    pages.select("items", F.col("page").cast("string").alias("page_token")).write.json(path)
    return paged.read_cursor_pages(spark, path, rows.schema.simpleString())


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def src_01_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01 00:00:00'").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))


@query("SELECT part_id, sku, size AS qty FROM b_products")
def src_03_paged_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Offset and length until a short page; nobody knows the total, so four tasks take every fourth page."""
    path = paged.land_pages(b.products(spark, folder).select("part_id", "sku", F.col("size").alias("qty")), ["part_id"], 500)
    return paged.read_paged(spark, "part_id long, sku string, qty long", fetch="loomwright.sources.paged:landed_page", folder=path, page=500, slices="all", strides=4)


@query("SELECT order_id, line, state FROM b_lines")
def src_05_two_passes(spark: SparkSession, folder: str) -> DataFrame:
    """A slice for each value of a flag."""
    return _landed(spark, b.lines(spark, folder).select("order_id", "line", "state"), ["state"], ["order_id", "line"], 800)


@query("SELECT ts::DATE AS day, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def src_06_days_with_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A slice for each day; some records are left out after they are read."""
    rows = table(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"), "event_type")
    kept = _landed(spark, rows, ["day"], ["event_id"], 1000).where("event_type <> 'error'")
    return kept.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT customer_id, CASE WHEN regexp_matches(shop, '^RR[-_]') THEN 'RR-EU' ELSE shop END AS shop FROM b_shops WHERE shop <> '无'")
def src_10_shop_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return b.shops(spark, folder).where("shop <> '无'").select("customer_id", shop_name(F.col("shop")).alias("shop")).distinct()


@query("SELECT part_id, (part_id * 3) % 101 AS weight FROM b_products WHERE weight = 0")
def src_12_batched_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Details of the products without a weight, 100 a call, from a table of all products' details in order of their keys."""
    path, products = fresh_path(spark, "details"), b.products(spark, folder)
    details = products.select("part_id", (F.col("part_id") * 3 % 101).alias("weight"), "name")
    details.repartitionByRange("part_id").sortWithinPartitions("part_id").write.option("parquet.block.row.count.limit", 5000).parquet(path)
    return paged.batched_lookup(products.where("weight = 0").select("part_id"), "part_id", path, "part_id long, weight long")


@query("SELECT event_id, event_type FROM events")
def src_13_cursor_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed as pages of up to 500 records, and read back."""
    path = fresh_path(spark, "pages")
    rows = table(spark, folder, "events").select("event_id", "event_type", F.floor(F.col("event_id") / 500).alias("page"))
    pages = rows.groupBy("page").agg(F.collect_list(F.struct("event_id", "event_type")).alias("items"))  # at most 500 records
    pages.select("items", F.col("page").cast("string").alias("page_token")).write.json(path)
    return paged.read_cursor_pages(spark, path, "struct<event_id:bigint,event_type:string>")


@query("SELECT event_id, event_type FROM events")
def src_15_complete_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of every day are read once, and as many rows must come as the pages say a day has."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    day = F.coalesce(F.to_date("ts").cast("string"), F.lit("none"))
    days = [r["d"] for r in events.select(day.alias("d")).distinct().orderBy("d").collect()]
    path = paged.land_pages(events.withColumn("d", day).drop("ts"), ["event_id"], 1000, F.col("d"))
    rows = paged.read_paged(spark, "event_id long, event_type string, _slice string, _total long", fetch="loomwright.sources.paged:landed_page", folder=path, page=1000, slices=",".join(days))
    return paged.complete_scan(rows, days)


@query("SELECT month, count(*) AS n, sum(qty)::BIGINT AS qty, NULL::VARCHAR AS note FROM b_sales WHERE year(month) = 2000 AND month(month) % 2 = 0 GROUP BY month")
def src_16_missing_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table for each month, where only every second one has been made; a missing table has no rows, a missing column nulls."""
    sales = b.monthly_sales(spark, folder).where("year(month) = 2000").select("month", "sku", "qty")
    path = fresh_path(spark, "months")
    sales.where("month(month) % 2 = 0").withColumn("m", F.month("month")).write.partitionBy("m").parquet(path)
    schema = "month date, sku string, qty long, note string"
    months = [stores.folder_or_empty(spark, f"{path}/m={m}", schema) for m in range(1, 13)]
    rows = reduce(DataFrame.unionByName, months)
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"), F.max("note").alias("note"))


@query("SELECT n_name AS name, code FROM nation JOIN (VALUES (0, 'A'), (1, 'B'), (2, 'C')) c(k, code) ON k = n_regionkey")
def src_17_constants(spark: SparkSession, folder: str) -> DataFrame:
    codes = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C")], "k int, code string")
    return table(spark, folder, "nation").join(F.broadcast(codes), F.col("k") == F.col("n_regionkey")).select(F.col("n_name").alias("name"), "code")


@query("SELECT event_id, event_type || ':' || CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS label FROM events")
def ingest_json_props(spark: SparkSession, folder: str) -> DataFrame:
    """JSON texts as variants, typed on reading."""
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    return table(spark, folder, "events").select("event_id", F.concat_ws(":", "event_type", k.cast("string")).alias("label"))


@query("SELECT order_id, 'created' AS slice FROM b_lines WHERE ordered >= DATE '2000-06-01' AND ordered < DATE '2000-07-01' UNION SELECT order_id, 'updated' FROM b_lines WHERE shipped >= DATE '2000-06-01' AND shipped < DATE '2000-07-01'")
def src_04_time_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Records made or changed in a range: two slices."""
    june = lambda c: (F.col(c) >= F.lit(dt.date(2000, 6, 1))) & (F.col(c) < F.lit(dt.date(2000, 7, 1)))
    rows = b.lines(spark, folder).select("order_id", F.array_compact(F.array(F.when(june("ordered"), "created"), F.when(june("shipped"), "updated"))).alias("slices"))
    return _landed(spark, rows.select("order_id", F.explode("slices").alias("slice")).distinct(), ["slice"], ["order_id"], 100)


@query("SELECT sku, sum(available)::BIGINT AS qty FROM b_local GROUP BY sku")
def src_07_stock_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = _landed(spark, b.local_stock(spark, folder).select("shop", "sku", "available"), ["shop"], ["sku"], 1000)
    return rows.groupBy("sku").agg(F.sum("available").alias("qty"))


@query("SELECT CASE WHEN available % 2 = 0 THEN 'north' ELSE '无' END AS warehouse, count(*) AS n FROM b_local GROUP BY 1")
def src_08_stock_with_warehouses(spark: SparkSession, folder: str) -> DataFrame:
    warehouses = spark.createDataFrame([(0, "north")], "w long, warehouse string")
    rows = _landed(spark, b.local_stock(spark, folder).select("shop", "sku", "available"), ["shop"], ["sku"], 500)
    rows = rows.withColumn("w", F.col("available") % 2).join(F.broadcast(warehouses), "w", "left")  # one row
    return rows.groupBy(F.coalesce("warehouse", F.lit("无")).alias("warehouse")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT month, sum(qty)::BIGINT AS qty FROM b_sales GROUP BY month")
def src_09_months(spark: SparkSession, folder: str) -> DataFrame:
    """A slice for each month, several at once; pages until all are there."""
    sales = written(b.monthly_sales(spark, folder).select(F.col("month").cast("string").alias("month"), "shop", "sku", "qty"), "sales")  # once, for the pages and the months
    path = paged.land_pages(sales, ["shop", "sku"], 1000, F.col("month"))
    months = [r["month"] for r in sales.select("month").distinct().orderBy("month").collect()]
    schema = "month string, shop string, sku string, qty long, _slice string, _total long"
    rows = paged.read_paged(spark, schema, fetch="loomwright.sources.paged:landed_page", folder=path, page=1000, slices=",".join(months), strides=2)
    return paged.complete_scan(rows, months).groupBy(F.col("month").cast("date").alias("month")).agg(F.sum("qty").alias("qty"))


@query("SELECT shop, order_id AS shipment, line AS box FROM b_lines WHERE shop <> '无'")
def src_11_shipments_and_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments of every shop with their boxes, as nested records."""
    lines = b.lines(spark, folder).where("shop <> '无'")
    shipments = lines.groupBy("shop", F.col("order_id").alias("shipment")).agg(F.collect_list("line").alias("boxes"))  # the lines of an order
    return _landed(spark, shipments, ["shop"], ["shipment"], 50).select("shop", "shipment", F.explode("boxes").alias("box"))