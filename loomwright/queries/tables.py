"""Sinks: what tables hold after writing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomwright.functions.codes import spu_of
from loomwright.operators import ranking, reshape
from loomwright.queries.base import query
from loomwright.sinks import fields, merge, outbox
from loomwright.sinks.files import fresh_path, replace_folder, write_files
from loomwright.sources import business as b
from loomwright.sources.business import table

CUT = dt.date(2000, 6, 1)


def _old_new(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A table of sales by product and month, and newer rows for some of its keys and for others."""
    sales = b.monthly_sales(spark, folder).groupBy("sku", "month").agg(F.sum("qty").alias("qty"), F.max("shop").alias("shop"))
    old = sales.where(F.month("month") != 7)
    new = sales.where((F.col("month") >= F.lit(CUT)) & (F.month("month") % 2 == 1)).select("sku", "month", (F.col("qty") + 1000).alias("qty"), F.lit("new").alias("shop"))
    return old, new


_BASE = """WITH s AS (SELECT sku, month, sum(qty)::BIGINT AS qty, max(shop) AS shop FROM b_sales GROUP BY ALL), old AS (SELECT * FROM s WHERE month(month) <> 7),
new AS (SELECT sku, month, qty + 1000 AS qty, 'new' AS shop FROM s WHERE month >= DATE '2000-06-01' AND month(month) % 2 = 1)"""


@query("SELECT sku, shop, month, qty FROM b_sales WHERE month >= DATE '2000-06-01'")
def snk_01_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice to one folder; the second write replaces the first."""
    path, sales = fresh_path(spark, "refresh"), b.monthly_sales(spark, folder).select("sku", "shop", "month", "qty")
    replace_folder(sales.where(F.col("month") < F.lit(CUT)), path)
    replace_folder(sales.where(F.col("month") >= F.lit(CUT)), path)
    return spark.read.parquet(path)


@query("SELECT spu, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY spu")
def snk_02_truncate_insert(spark: SparkSession, folder: str) -> DataFrame:
    path, rows = fresh_path(spark, "truncate"), b.planned_orders(spark, folder).groupBy("spu").agg(F.sum("qty").alias("qty"))
    rows.limit(1).write.mode("overwrite").parquet(path)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _written_twice(old: DataFrame, by: str, touched: DataFrame, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The old table, written by partitions; those touched are replaced from a plan that reads the table itself, twice: the second time changes nothing."""
    spark, path = old.sparkSession, fresh_path(old.sparkSession, "partitions")
    old.write.partitionBy(by).parquet(path)
    schema = spark.read.parquet(path).schema
    for _ in range(2):
        merge.rewrite_partitions(spark, path, schema, by, touched, plan)
    return spark.read.schema(schema).parquet(path).select(old.columns)


@query(f"{_BASE} SELECT * FROM old WHERE month < DATE '2000-06-01' UNION ALL SELECT * FROM new")
def snk_03_range_replace(spark: SparkSession, folder: str) -> DataFrame:
    old, new = map(merge.written, _old_new(spark, folder), ("old", "new"))
    later = F.col("month") >= F.lit(CUT)
    touched = old.where(later).select("month").unionByName(new.select("month"))
    return _written_twice(old, "month", touched, lambda held: merge.replace_range(held, new, later))


@query(f"{_BASE} SELECT * FROM old WHERE month NOT IN (SELECT month FROM new) UNION ALL SELECT * FROM new")
def snk_04_slice_replace(spark: SparkSession, folder: str) -> DataFrame:
    old, new = map(merge.written, _old_new(spark, folder), ("old", "new"))
    return _written_twice(old, "month", new.select("month"), lambda held: merge.replace_slices(held, new, ["month"]))


@query(f"{_BASE} SELECT * FROM old ANTI JOIN new USING (sku, month) UNION ALL SELECT * FROM new")
def snk_05_upsert(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _old_new(spark, folder)
    return merge.upsert(old, new, ["sku", "month"])


@query(f"{_BASE} SELECT sku, month, coalesce(new.qty, old.qty) AS qty, coalesce(old.shop, new.shop) AS shop FROM old FULL JOIN new USING (sku, month)")
def snk_05_upsert_some_columns(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _old_new(spark, folder)
    return merge.upsert(old, new, ["sku", "month"], keep=["shop"])


@query(f"{_BASE} SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (sku, month)")
def snk_06_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _old_new(spark, folder)
    return merge.insert_ignore(old, new, ["sku", "month"], "qty")


@query(f"{_BASE} SELECT * FROM old WHERE sku NOT IN (SELECT sku FROM new) UNION ALL SELECT * FROM new")
def snk_07_delete_insert(spark: SparkSession, folder: str) -> DataFrame:
    old, new = map(merge.written, _old_new(spark, folder), ("old", "new"))
    touched = old.join(new.select("sku"), "sku", "left_semi").select("month").unionByName(new.select("month"))
    return _written_twice(old, "month", touched, lambda held: merge.delete_then_insert(held, new, "sku"))


@query("SELECT part_id, sku, CASE WHEN weight = 0 THEN size + 1 ELSE weight END AS weight, fabric FROM b_products")
def snk_08_update_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Weights are found for some products; fabrics without such a product keep their files."""
    p = merge.written(b.products(spark, folder), "products")
    found = p.where("weight = 0").select("part_id", (F.col("size") + 1).alias("weight"))
    touched = p.join(found.select("part_id"), "part_id", "left_semi").select("fabric")
    return _written_twice(p.select("part_id", "sku", "weight", "fabric"), "fabric", touched, lambda held: merge.update_columns(held, found, "part_id"))


@query("SELECT part_id AS id, sku, NULL::VARCHAR AS note FROM b_products")
def snk_09_schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    wanted = StructType([StructField("id", LongType()), StructField("sku", StringType()), StructField("note", StringType())])
    return merge.check_schema(merge.evolve(b.products(spark, folder), wanted, {"part_id": "id"}, extra="drop"), wanted)


@query("SELECT sku, nullif(shop, '无') AS shop, available, pending, CASE WHEN available > 20 THEN 'many' ELSE 'few' END AS view, (row_number() OVER (PARTITION BY shop ORDER BY sku) - 1) // 20000 AS outbox, shop <> '无' AS taken FROM b_local")
def snk_10_guarded_outbox(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every shop, sent in batches of 500 to targets that take 20,000 rows at most: beyond that a shop has more outboxes.

    The targets have no field for the fabric; a row without a shop is refused and named.
    """
    path = fresh_path(spark, "outbox")
    rows = b.local_stock(spark, folder).select("sku", "shop", "available", "pending", F.when(F.col("available") > 20, "many").otherwise("few").alias("view"))
    placed = ranking.chunked(rows, ["shop"], ["sku"], 20_000, "outbox").withColumn("shop", F.nullif("shop", F.lit("无"))).withColumn("unknown", F.lit("dropped"))
    cells = {"sku": "text", "shop": "text", "available": "number", "pending": "number", "view": "text", "absent": "text"}
    outbox.write_outbox(placed, path, "loomwright.sinks.outbox:check_required", cells, ("outbox",), required="sku,shop")
    read = lambda refused: outbox.read_outbox(spark, path, "sku string, shop string, available long, pending long, view string", "outbox long", refused)
    return read(False).withColumn("taken", F.lit(True)).unionByName(read(True).drop("why").withColumn("taken", F.lit(False)))


@query("SELECT owner, count(DISTINCT sku) AS products FROM b_owners WHERE owner <> '' GROUP BY owner")
def snk_11_owner_views(spark: SparkSession, folder: str) -> DataFrame:
    """A view for each owner, written and read back: its products, counted."""
    path = fresh_path(spark, "views")
    fields.write_views(b.owners(spark, folder).select("sku", "owner", "shop").distinct(), "owner", path, ["shop", "sku", "owner"])
    return spark.read.schema("shop string, sku string, owner string").parquet(path).groupBy("owner").agg(F.countDistinct("sku").alias("products"))


@query("SELECT part_id, sku, ((row_number() OVER (PARTITION BY fabric ORDER BY part_id) - 1) // 100)::INT AS file, fabric FROM b_products")
def snk_12_chunked_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "chunks")
    write_files(ranking.chunked(b.products(spark, folder).select("part_id", "sku", "fabric"), ["fabric"], ["part_id"], 100, "file"), path, "file")
    return spark.read.parquet(path)


@query("SELECT spu, sum(qty)::BIGINT AS qty FROM b_planned GROUP BY spu UNION ALL SELECT 'total', sum(qty)::BIGINT FROM b_planned")
def snk_13_total_row(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.with_total_row(b.planned_orders(spark, folder).groupBy("spu").agg(F.sum("qty").alias("qty")), "spu", "total", ["qty"])


@query("SELECT shop, sum(qty)::BIGINT AS qty, '| ' || shop || ' | ' || sum(qty)::BIGINT || ' |' AS line FROM b_planned GROUP BY shop")
def snk_14_card_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.planned_orders(spark, folder).groupBy("shop").agg(F.sum("qty").alias("qty"))
    return rows.select("shop", "qty", F.concat(F.lit("| "), "shop", F.lit(" | "), F.col("qty").cast("string"), F.lit(" |")).alias("line"))


@query("SELECT order_id, line, sku FROM b_lines")
def snk_15_json_dump(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw record."""
    path = fresh_path(spark, "dump")
    b.lines(spark, folder).select("order_id", "line", "sku").write.json(path)
    return spark.read.schema("order_id long, line long, sku string").json(path)


@query("SELECT shop, (n // 15)::BIGINT AS order_no, count(*) AS items, shop <> 'N3-EU' AS taken FROM (SELECT shop, row_number() OVER (PARTITION BY shop ORDER BY sku) - 1 AS n FROM (SELECT DISTINCT shop, sku FROM b_planned)) GROUP BY ALL")
def snk_16_order_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of at most 15 products, sent 50 at a time; the remote side refuses those of a shop it has no number for, one by one."""
    path = fresh_path(spark, "orders")
    rows = ranking.chunked(b.planned_orders(spark, folder).select("shop", "sku").distinct(), ["shop"], ["sku"], 15, "order_no")
    payload = rows.groupBy("shop", "order_no").agg(F.array_sort(F.collect_list("sku")).alias("skus"))  # at most 15
    orders = payload.select("shop", "order_no", F.when(F.col("shop") != "N3-EU", F.col("shop")).alias("target"), F.to_json("skus").alias("skus"))
    outbox.write_outbox(orders, path, "loomwright.sinks.outbox:check_required", {"target": "text", "skus": "text"}, ("shop", "order_no"), 50, required="target,skus")
    read = lambda refused: outbox.read_outbox(spark, path, "target string, skus string", "shop string, order_no long", refused)
    both = read(False).withColumn("taken", F.lit(True)).unionByName(read(True).drop("why").withColumn("taken", F.lit(False)))
    return both.select("shop", "order_no", F.json_array_length("skus").cast("bigint").alias("items"), "taken")


@query("SELECT spu, count(*) AS n FROM b_products GROUP BY spu")
def snk_18_atomic_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A folder that is read and replaced in one step."""
    path = fresh_path(spark, "atomic")
    replace_folder(b.products(spark, folder).select("part_id", "sku"), path)
    replace_folder(spark.read.parquet(path).groupBy(spu_of(F.col("sku")).alias("spu")).agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)
