"""Scalar functions over the tables' texts, dates and numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import cells, codes, dates, numbers
from loomwright.queries.base import PARTS, colour, pack, query, registered, spu
from loomwright.sources import business as b
from loomwright.sources.business import table


def _over_products(name: str, made: Callable[[Column], Column], sql: str, source: Callable[[], Column] | None = None, source_sql: str = "sku") -> None:
    """part_id and one value for each product; ``sql`` reads the source as ``x``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = b.products(spark, folder).select("part_id", (F.col("sku") if source is None else source()).alias("x"))
        return rows.select("part_id", made(F.col("x")).alias("value"))

    registered(name, run, f"SELECT part_id, {sql} AS value FROM (SELECT part_id, {source_sql} AS x FROM b_products)")


def MSKU() -> Column:
    """Marketplace codes; every third lacks its end, some hold both ends."""
    return F.concat(F.lit("LA"), F.col("sku"), F.when(F.col("part_id") % 3 == 0, "").when(F.col("part_id") % 3 == 1, "-FBA").otherwise("-FBM-FBA2"))


MSKU_SQL = "'LA' || sku || CASE part_id % 3 WHEN 0 THEN '' WHEN 1 THEN '-FBA' ELSE '-FBM-FBA2' END"


SHOP = lambda: F.concat(F.when(F.col("part_id") % 3 == 0, "RR-").when(F.col("part_id") % 3 == 1, "RR_").otherwise("N7"), F.when(F.col("part_id") % 2 == 0, "-US").otherwise(""))
SHOP_SQL = "CASE part_id % 3 WHEN 0 THEN 'RR-' WHEN 1 THEN 'RR_' ELSE 'N7' END || CASE WHEN part_id % 2 = 0 THEN '-US' ELSE '' END"
NAMES = lambda: F.concat(F.col("name"), F.element_at(F.array(*map(F.lit, [",", ";", "，", "；", "|", "/"])), (F.col("part_id") % 6 + 1).cast("int")), F.col("fabric"), F.lit(";"), F.col("sku"))
NAMES_SQL = "name || [',', ';', '，', '；', '|', '/'][part_id % 6 + 1] || fabric || ';' || sku"

_over_products("str_01_without_pack", codes.without_pack, pack("x"))
_over_products("str_02_spu_of", codes.spu_of, spu("x"))
_over_products("str_03_product_spu", codes.product_spu, f"split_part({pack('x')}, '-', 1)")
_over_products("str_04_profit_spu", lambda x: F.concat_ws("|", codes.profit_spu(x, True), codes.profit_spu(F.replace(x, F.lit("-")), False), codes.profit_spu(F.replace(x, F.lit("-")), True)), "split_part(x, '-', 1) || '|' || replace(x, '-', '')")
_over_products(
    "str_05_spu_and_colour",
    lambda x: F.concat_ws("|", codes.spu_and_colour(x)["spu"], codes.spu_and_colour(x)["spu_colour"]),
    f"{PARTS.format('x')}[1] || '|' || CASE WHEN len({PARTS.format('x')}) >= 3 THEN {PARTS.format('x')}[1] || '-' || {PARTS.format('x')}[2] WHEN len({PARTS.format('x')}) = 2 THEN {PARTS.format('x')}[2] ELSE '无' END",
)
_over_products("str_06_order_colour", lambda x: codes.colour_of(x, 4), colour("x", 4))
_over_products("str_07_fabric_colour", lambda x: codes.colour_of(x, 3), colour("x", 3), lambda: F.regexp_replace("sku", "-[0-9]+$", ""), "regexp_replace(sku, '-[0-9]+$', '')")
_over_products("str_08_sku_of_msku", codes.sku_of_msku, "nullif(regexp_extract(x, '^..(.+?)-FB[AM]', 1), '')", MSKU, MSKU_SQL)
_over_products("str_09_brand_of_shop", codes.brand_of, "CASE WHEN strpos(x, '-') > 1 THEN split_part(x, '-', 1) || '-' END", SHOP, SHOP_SQL)
_over_products("str_10_shop_name", codes.shop_name, "CASE WHEN regexp_matches(x, '^RR[-_]') THEN 'RR-EU' ELSE x END", SHOP, SHOP_SQL)
_over_products("str_11_spu_of_msku", codes.spu_of_msku, "CASE WHEN length(split_part(x, '-', 1)) > 2 THEN substr(split_part(x, '-', 1), 3) ELSE split_part(x, '-', 1) END", MSKU, MSKU_SQL)
_over_products(
    "str_12_first_name",
    codes.first_name,
    "trim(split_part(x, CASE WHEN contains(x, ',') THEN ',' WHEN contains(x, ';') THEN ';' WHEN contains(x, '，') THEN '，' WHEN contains(x, '；') THEN '；' WHEN contains(x, '|') THEN '|' ELSE '/' END, 1))",
    NAMES,
    NAMES_SQL,
)
_over_products("str_13_full_size_image", codes.full_size_image, r"regexp_replace(x, '\._SL[0-9]+_', '', 'g')", lambda: F.concat(F.lit("http://i/"), F.col("sku"), F.lit("._SL"), F.col("size"), F.lit("_.jpg")), "'http://i/' || sku || '._SL' || size || '_.jpg'")
_over_products("str_14_normal", codes.normal, "upper(trim(coalesce(x, '')))", lambda: F.when(F.col("part_id") % 4 != 0, F.concat(F.lit(" "), F.col("name"), F.lit("  "))), "CASE WHEN part_id % 4 <> 0 THEN ' ' || name || '  ' END")
_over_products("str_15_us_shop", lambda x: F.endswith(x, F.lit("US")), "ends_with(x, 'US')", SHOP, SHOP_SQL)
_over_products("str_16_box_number", lambda x: F.concat_ws("|", codes.box_number(x), codes.padded(codes.box_number(x))), "coalesce(nullif(ltrim(string_split(x, 'U')[-1], '0'), ''), '0') || '|' || CASE WHEN length(coalesce(nullif(ltrim(string_split(x, 'U')[-1], '0'), ''), '0')) >= 6 THEN coalesce(nullif(ltrim(string_split(x, 'U')[-1], '0'), ''), '0') ELSE lpad(coalesce(nullif(ltrim(string_split(x, 'U')[-1], '0'), ''), '0'), 6, '0') END", lambda: F.concat(F.lit("FBA1U000"), F.when(F.col("part_id") % 9 != 0, F.col("part_id").cast("string")).otherwise("0")), "'FBA1U000' || CASE WHEN part_id % 9 <> 0 THEN part_id::VARCHAR ELSE '0' END")
_over_products("str_17_joined_names", lambda x: F.array_join(F.filter(F.transform(F.split(x, "[,;|/，；]"), lambda p: F.trim(p)), lambda p: p != ""), ","), "array_to_string(list_filter(list_transform(string_split_regex(x, '[,;|/，；]'), lambda p: trim(p)), lambda p: p <> ''), ',')", NAMES, NAMES_SQL)
_over_products("str_18_before_last_dash", codes.before_last_dash, "regexp_replace(x, '-[^-]*$', '')")
_over_products("str_19_label", lambda x: F.concat(F.lit("L1("), x, F.lit(")·step"), (F.length(x) % 4).cast("string")), "'L1(' || x || ')·step' || (length(x) % 4)")
_over_products("str_20_first_token", codes.first_token, "split_part(x, ' ', 1)", lambda: F.col("name"), "name")
_over_products("str_21_name_distance", lambda x: F.levenshtein(x, F.lit("red bolt")), "levenshtein(x, 'red bolt')", lambda: F.col("name"), "name")
_over_products("str_22_digest", lambda x: F.md5(F.concat(F.lit("a=1&sku="), x)), "md5('a=1&sku=' || x)")


def _over_orders(name: str, made: Callable[[Column], Column], sql: str) -> None:
    """order_id and one value for each order; ``d`` is its date."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("d"))
        return rows.select("order_id", made(F.col("d")).alias("value"))

    registered(name, run, f"SELECT order_id, {sql} AS value FROM (SELECT o_orderkey AS order_id, o_orderdate::DATE AS d FROM orders)")


LABEL_SQL = "strftime(d, '%y') || '年' || month(d) || '月销量'"
_over_orders("dt_01_month_offset", lambda d: dates.month_offset(d, -13), "(date_trunc('month', d) - INTERVAL 13 MONTH)::DATE")
_over_orders("dt_02_month_label", dates.month_label, LABEL_SQL)
_over_orders("dt_03_month_of_label", lambda d: dates.month_of_label(dates.month_label(d)), "date_trunc('month', d)::DATE")
_over_orders("dt_04_month_ends", lambda d: F.concat_ws("|", *(x.cast("string") for x in dates.month_ends(d)), F.size(dates.month_slices(d, F.date_add(d, 75))).cast("string")), "date_trunc('month', d)::DATE || '|' || last_day(d) || '|' || (datediff('month', d, d + 75) + 1)")
_over_orders("dt_05_date_formats", lambda d: F.concat_ws("|", F.date_format(d, "yyyy-MM-01"), F.date_format(d, "yyyy-MM"), F.date_format(d, "yy-MM")), "strftime(d, '%Y-%m-01') || '|' || strftime(d, '%Y-%m') || '|' || strftime(d, '%y-%m')")
_over_orders("dt_07_tolerant_date", lambda d: dates.tolerant_date(F.when(F.day(d) % 3 == 0, F.date_format(d, "yyyy/MM/dd")).when(F.day(d) % 3 == 1, F.concat(d.cast("string"), F.lit(" 10:00:00"))).otherwise("unknown")), "CASE WHEN day(d) % 3 < 2 THEN d END")
_over_orders("dt_10_epoch_millis", lambda d: dates.epoch_millis(F.when(F.day(d) % 2 == 0, d.cast("string")).otherwise(F.concat(d.cast("string"), F.lit(" 01:02:03")))), "epoch_ms(d::TIMESTAMP) + CASE WHEN day(d) % 2 = 0 THEN 0 ELSE 3723000 END")
_over_orders("dt_11_month_window", lambda d: F.array_join(F.transform(F.sequence(dates.month_offset(d, -2), dates.month_offset(d, 3), F.expr("interval 1 month")), lambda m: F.date_format(m, "yyyy-MM")), ","), "array_to_string([strftime(date_trunc('month', d) + to_months(k), '%Y-%m') FOR k IN [-2, -1, 0, 1, 2, 3]], ',')")


@query("SELECT event_id, ts::DATE AS value FROM events")
def dt_06_date_of_time(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.to_date("ts").alias("value"))


@query("""SELECT event_id, strftime(CASE WHEN event_id % 7 = 5 THEN date_trunc('second', ts) - INTERVAL 0 HOUR
        ELSE date_trunc('second', ts) + to_minutes([480, 480, 960, 900, 690, 0, 690][event_id % 7 + 1]) END, '%Y-%m-%d %H:%M:%S') AS value FROM events""")
def dt_08_beijing_time(spark: SparkSession, folder: str) -> DataFrame:
    zone = F.element_at(F.array(*map(F.lit, ["Z", " UTC", " PST", " PDT", "-03:30", "", " UTC-03:30"])), (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, folder, "events").select("event_id", dates.beijing_time(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone)).alias("value"))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS value FROM events")
def dt_09_epoch_time(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    x = F.when(F.col("event_id") % 2 == 0, F.unix_millis(ts)).otherwise(F.unix_seconds(ts))
    return table(spark, folder, "events").select("event_id", F.date_format(dates.epoch_time(x), "yyyy-MM-dd HH:mm:ss").alias("value"))


@query("SELECT o_orderkey AS order_id, datediff('month', o_orderdate::DATE, DATE '2000-06-15')::BIGINT AS value FROM orders")
def dt_12_run_date_anchor(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    months = (F.year(F.lit(b.AS_OF)) * 12 + F.month(F.lit(b.AS_OF)) - F.year(day) * 12 - F.month(day)).cast("bigint")
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), months.alias("value"))


NUMBER = lambda: F.when(F.col("part_id") % 4 == 0, F.col("size").cast("string")).when(F.col("part_id") % 4 == 1, F.concat(F.col("size").cast("string"), F.lit(".5"))).when(F.col("part_id") % 4 == 2, F.lit("n/a"))
NUMBER_SQL = "CASE part_id % 4 WHEN 0 THEN size::VARCHAR WHEN 1 THEN size || '.5' WHEN 2 THEN 'n/a' END"
_over_products("mth_01_to_decimal", lambda x: numbers.to_decimal(x).cast("double"), "coalesce(try_cast(x AS DOUBLE), 0)", NUMBER, NUMBER_SQL)
_over_products("mth_02_round_half_up", lambda x: numbers.round_half_up(x.cast("decimal(10,2)") / 40, 2).cast("double"), "floor(x * 100 / 40.0 + 0.5) / 100", lambda: F.col("size"), "size")
_over_products("mth_03_round_half_even_decimal", lambda x: numbers.round_half_even(x.cast("decimal(10,3)") / 8, 2).cast("double"), "round_even(x::DECIMAL(10,3) * 0.125, 2)::DOUBLE", lambda: F.col("size"), "size")
_over_products("mth_04_round_to_int", lambda x: numbers.round_half_even(x.cast("decimal(10,1)") / 2, 0).cast("bigint"), "round_even(x * 0.5, 0)::BIGINT", lambda: F.col("size"), "size")
_over_products("mth_05_truncated", lambda x: numbers.truncated((x - 25) / 4), "trunc((x - 25) / 4.0)::BIGINT", lambda: F.col("size"), "size")
_over_products("mth_06_clamp", lambda x: numbers.clamp(x / 16, 0.3, 3.0), "greatest(0.3::DOUBLE, least(3.0::DOUBLE, x / 16.0::DOUBLE))", lambda: F.col("size"), "size")
_over_products("mth_07_guarded", lambda x: numbers.guarded(F.lit(7), x - 3), "CASE WHEN x - 3 > 0 THEN 7::DOUBLE / (x - 3)::DOUBLE ELSE 0.0 END", lambda: F.col("size"), "size")
_over_products("mth_08_not_negative", lambda x: numbers.not_negative(x - 20), "greatest(0, x - 20)", lambda: F.col("size"), "size")
_over_products("mth_09_int_of_number", numbers.int_of_number_text, "coalesce(trunc(try_cast(x AS DOUBLE))::BIGINT, 0)", NUMBER, NUMBER_SQL)
_over_products("mth_10_int_of_integer", numbers.int_of_integer_text, "CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN x::BIGINT ELSE 0 END", NUMBER, NUMBER_SQL)
_over_products("mth_11_box_volume", lambda x: F.floor(numbers.cubic_metres(numbers.centimetres(x, F.when(x % 2 == 0, "in").otherwise("cm")), x, x) * 1e6).cast("bigint"), "floor((CASE WHEN x % 2 = 0 THEN x * 2.54::DOUBLE ELSE x END)::DOUBLE * x * x / 1000000::DOUBLE * 1000000::DOUBLE)::BIGINT", lambda: F.col("size").cast("double"), "size::DOUBLE")
_over_products("mth_12_nullable_int", lambda x: x.try_cast("bigint"), "CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN x::BIGINT END", lambda: F.when(F.col("part_id") % 4 != 1, NUMBER()), f"CASE WHEN part_id % 4 <> 1 THEN {NUMBER_SQL} END")

CELL = lambda: F.when(F.col("part_id") % 5 == 0, F.concat(F.lit('[{"text":"'), F.col("sku"), F.lit('"},{"text":"b"}]'))).when(F.col("part_id") % 5 == 1, F.concat(F.lit('{"text":"'), F.col("name"), F.lit('","link":"http://l"}'))).when(F.col("part_id") % 5 == 2, F.col("size").cast("string")).when(F.col("part_id") % 5 == 3, F.col("name"))
CELL_SQL = """CASE part_id % 5 WHEN 0 THEN '[{"text":"' || sku || '"},{"text":"b"}]' WHEN 1 THEN '{"text":"' || name || '","link":"http://l"}' WHEN 2 THEN size::VARCHAR WHEN 3 THEN name END"""
LIST = lambda: F.when(F.col("part_id") % 3 == 0, F.concat(F.lit('["'), F.col("sku"), F.lit('","'), F.col("spu"), F.lit('"]'))).when(F.col("part_id") % 3 == 1, F.col("sku"))
LIST_SQL = """CASE part_id % 3 WHEN 0 THEN '["' || sku || '","' || spu || '"]' WHEN 1 THEN sku END"""
_OF = "(SELECT s FROM (SELECT {} AS s))"


def _over_cells(name: str, made: Callable[[Column], Column], sql: str, source: Callable[[], Column] = CELL, source_sql: str = CELL_SQL) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = b.products(spark, folder).select("part_id", "sku", "spu", "name", "size", source().alias("x"))
        return rows.select("part_id", made(F.col("x")).alias("value"))

    registered(name, run, f"SELECT part_id, {sql} AS value FROM (SELECT *, {source_sql} AS x FROM b_products)")


_over_cells("arr_01_joined_list", cells.joined_list, "CASE part_id % 3 WHEN 0 THEN sku || ',' || spu WHEN 1 THEN sku ELSE '' END", LIST, LIST_SQL)
_over_cells("arr_02_cell_text", cells.cell_text, "CASE part_id % 5 WHEN 0 THEN sku WHEN 1 THEN name WHEN 2 THEN size::VARCHAR WHEN 3 THEN name ELSE '' END")
_over_cells("arr_03_cell_number", cells.cell_number, "CASE part_id % 5 WHEN 2 THEN size::DOUBLE ELSE 0.0 END")
_over_cells("arr_04_cell_texts", cells.cell_texts, "CASE part_id % 5 WHEN 0 THEN sku || ',b' WHEN 1 THEN name WHEN 2 THEN size::VARCHAR WHEN 3 THEN name ELSE '' END")
_over_cells("arr_05_field_of_object_or_list", lambda x: cells.field(x, "text"), "CASE part_id % 5 WHEN 0 THEN sku WHEN 1 THEN name END")
_over_cells("arr_06_first_present", lambda x: F.coalesce(F.nullif(F.when(F.length(x) % 2 == 0, x).otherwise(""), F.lit("")), x, F.lit("none")), "coalesce(x, 'none')")
_over_cells("arr_07_cell_link", cells.cell_link, "CASE part_id % 5 WHEN 0 THEN sku WHEN 1 THEN 'http://l' ELSE x END")
_over_cells("arr_10_first_of_list", lambda x: F.get(cells.text_list(x), F.lit(0)), "CASE WHEN part_id % 3 < 2 THEN sku END", LIST, LIST_SQL)


@query("""SELECT part_id, '{"at":' || epoch_ms(DATE '2000-01-01' + size::INT) || ',"n":' || size || ',"t":"' || name || '"}' AS value FROM b_products""")
def arr_08_sink_cell(spark: SparkSession, folder: str) -> DataFrame:
    at = F.unix_millis(F.date_add(F.lit("2000-01-01").cast("date"), F.col("size").cast("int")).cast("timestamp"))
    return b.products(spark, folder).select("part_id", F.to_json(F.struct(at.alias("at"), F.col("size").alias("n"), F.col("name").alias("t"))).alias("value"))


@query("SELECT part_id, name AS title, CASE WHEN part_id % 2 = 0 THEN spu ELSE fabric END AS shop FROM b_products")
def arr_09_renamed_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields renamed by a map; the shop is taken from any column that names one."""
    rows = b.products(spark, folder).select("part_id", F.col("name").alias("f1"), F.when(F.col("part_id") % 2 == 0, F.col("spu")).alias("store_a"), F.col("fabric").alias("store_b"))
    rows = rows.withColumnsRenamed({"f1": "title"})
    return rows.select("part_id", "title", F.coalesce(*(F.col(c) for c in rows.columns if c.startswith("store"))).alias("shop"))
