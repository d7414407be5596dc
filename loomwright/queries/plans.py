"""The composite plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import codes, dates
from loomwright.functions.nulls import NONE
from loomwright.operators import lookup, ranking, reshape
from loomwright.plans import fabric, fees, forecast, inventory, orders, procurement, profit
from loomwright.queries.base import colour, query, ratio, spu
from loomwright.sinks.files import written
from loomwright.sources import business as b
from loomwright.sources.business import AS_OF, table

P = forecast.Forecast()
#: The comparison report and the plans built on it, and the sales sheet, read fewer months.
REPORT, SHEET = forecast.Forecast(history="short"), forecast.Forecast(history="sheet")
FIRST = forecast.shifted(AS_OF, 0)
_LAGS = sorted({1, 2, 3, 13, 14, 15, 12, 11, 10, 9})
_DAY = lambda k: f"DATE '{forecast.shifted(AS_OF, -k)}'"
_NUM = " + ".join(["0.0::DOUBLE"] + [f"(CASE WHEN s_{i + 12} > 0 THEN {w}::DOUBLE * (s_{i}::DOUBLE / s_{i + 12}::DOUBLE) ELSE 0.0::DOUBLE END)" for i, w in enumerate(P.weights, 1)])
_DEN = " + ".join(["0.0::DOUBLE"] + [f"(CASE WHEN s_{i + 12} > 0 THEN {w}::DOUBLE ELSE 0.0::DOUBLE END)" for i, w in enumerate(P.weights, 1)])
_OLD = "(CASE WHEN s_3 > 0 THEN (s_2::DOUBLE - s_3::DOUBLE) / s_3::DOUBLE ELSE 0.0::DOUBLE END)"
_NEW = "(CASE WHEN s_2 > 0 THEN (s_1::DOUBLE - s_2::DOUBLE) / s_2::DOUBLE ELSE 0.0::DOUBLE END)"
_GROWTH = f"(0.4::DOUBLE * {_OLD} + 0.6::DOUBLE * {_NEW})"


def _damped(step: int) -> str:
    out = "s_1::DOUBLE"
    for i in range(step + 1):
        out = f"({out} * (1.0::DOUBLE + least({_GROWTH}, 0.5::DOUBLE) * {P.damping**i!r}::DOUBLE))"
    return out


def _step(step: int) -> str:
    ago, recent = f"s_{12 - step}", f"(CASE WHEN s_1 + s_2 + s_3 < 5 THEN 0 WHEN growth > 0.05::DOUBLE THEN floor({_damped(step)}) ELSE floor((s_1 + s_2 + s_3) / 3.0::DOUBLE) END)"
    how = "(CASE WHEN s_1 + s_2 + s_3 < 5 THEN 'L3_none' WHEN growth > 0.05::DOUBLE THEN 'L3_damped' ELSE 'L3_mean' END)"
    return f"""SELECT shop, sku, spu, trend, DATE '{forecast.shifted(AS_OF, step)}' AS month,
        (CASE WHEN {ago} > 0 AND trend > 0 THEN floor({ago}::DOUBLE * (trend / 100.0::DOUBLE)) WHEN {recent} > 0 THEN {recent}
            WHEN {ago} > 0 AND style_trend > 0 THEN floor({ago}::DOUBLE * (style_trend / 100.0::DOUBLE)) ELSE 0 END)::BIGINT AS qty,
        CASE WHEN {ago} > 0 AND trend > 0 THEN 'L1_trend' WHEN {recent} > 0 THEN {how} WHEN {ago} > 0 AND style_trend > 0 THEN 'L4_style' ELSE 'L5_none' END AS method FROM f_known"""


def _forecast_sql(unread: tuple[int, ...] = ()) -> str:
    """Common tables of the forecast, without the months (before the run's) that a report doesn't read."""
    read = [k for k in _LAGS if k not in unread]
    sums = ", ".join(f"coalesce(sum(qty) FILTER (month = {_DAY(k)}), 0)::BIGINT AS s_{k}" for k in read) + "".join(f", 0::BIGINT AS s_{k}" for k in unread)
    return f"""f_series AS (SELECT shop, sku, spu, {sums} FROM b_sales WHERE month IN ({", ".join(map(_DAY, read))}) GROUP BY ALL),
f_trend AS (SELECT *, CASE WHEN {_DEN} > 0 THEN floor(greatest(0.3::DOUBLE, least(3.0::DOUBLE, ({_NUM}) / ({_DEN}))) * 100 + 0.5)::BIGINT END AS trend, {_GROWTH} AS growth FROM f_series),
f_known AS (SELECT t.*, floor(m + 0.5)::BIGINT AS style_trend FROM f_trend t JOIN (SELECT shop, spu, sum(trend)::DOUBLE / count(trend) AS m FROM f_trend GROUP BY ALL) USING (shop, spu)),
f_rows AS ({" UNION ALL ".join(_step(s) for s in range(P.months))})"""


FORECAST = _forecast_sql()
FORECAST_REPORT = _forecast_sql((14, 15))
FORECAST_SHEET = _forecast_sql((2, 3, 14, 15))


def _forecast(spark: SparkSession, folder: str, p: forecast.Forecast = REPORT) -> DataFrame:
    return forecast.forecast(b.monthly_sales(spark, folder, *forecast.span(AS_OF)), AS_OF, p)


@query(f"WITH {FORECAST} SELECT shop, sku, trend FROM f_trend")
def cmp_02_trend_factor(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.series(b.monthly_sales(spark, folder, *forecast.span(AS_OF)), AS_OF, P).select("shop", "sku", forecast.trend_factor(P).alias("trend"))


@query(f"WITH {FORECAST} SELECT shop, sku, (CASE WHEN s_1 + s_2 + s_3 < 5 THEN 0 WHEN growth > 0.05::DOUBLE THEN floor({_damped(1)}) ELSE floor((s_1 + s_2 + s_3) / 3.0::DOUBLE) END)::BIGINT AS qty FROM f_trend")
def cmp_03_recent_growth(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.series(b.monthly_sales(spark, folder, *forecast.span(AS_OF)), AS_OF, P).select("shop", "sku", forecast.recent_growth(1, P)[0].alias("qty"))


@query(f"WITH {FORECAST} SELECT shop, sku, spu, month, qty, method, trend FROM f_rows")
def cmp_04_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return _forecast(spark, folder, P)


_COMPARED = """WITH {f}, c AS (SELECT spu, shop, month, coalesce(s.qty, 0)::BIGINT AS system_qty, coalesce(p.qty, 0)::BIGINT AS planned_qty
    FROM (SELECT spu, shop, month, sum(qty) AS qty FROM f_rows GROUP BY ALL) s FULL JOIN (SELECT spu, shop, month, sum(qty) AS qty FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-09-01' GROUP BY ALL) p USING (spu, shop, month))
SELECT *, planned_qty - system_qty AS difference, {r} AS difference_ratio FROM c WHERE system_qty <> 0 OR planned_qty <> 0"""
_RATIO = ratio("(planned_qty - system_qty)", "system_qty")


def _ahead(spark: SparkSession, folder: str) -> DataFrame:
    return b.planned_orders(spark, folder).where(F.col("month").between(F.lit(dt.date(2000, 6, 1)), F.lit(dt.date(2000, 9, 1))))


@query(_COMPARED.format(f=FORECAST_REPORT, r=_RATIO))
def cmp_05_forecast_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.comparison(_forecast(spark, folder), _ahead(spark, folder))


@query(_COMPARED.format(f=FORECAST, r=_RATIO))
def cmp_05_full_history(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.comparison(_forecast(spark, folder, P), _ahead(spark, folder))


@query(f"WITH {FORECAST_REPORT} SELECT sku, spu, shop, month, sum(qty)::BIGINT AS qty FROM f_rows WHERE qty > 0 GROUP BY ALL")
def cmp_05_product_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.by_product(_forecast(spark, folder))


_CELLS = """WITH c AS (SELECT sku, shop, f.sellable, f.in_transit, l.available, l.pending FROM b_fba f FULL JOIN b_local l USING (sku, shop)),
fs AS (SELECT sku, arg_min(shop, (NOT shop LIKE '%US', shop)) AS t FROM b_fba WHERE shop <> '无' GROUP BY sku), ls AS (SELECT sku, arg_min(shop, (NOT shop LIKE '%US', shop)) AS t FROM b_local WHERE shop <> '无' GROUP BY sku),
wf AS (SELECT * FROM b_fba WHERE shop = '无'), wl AS (SELECT * FROM b_local WHERE shop = '无'),
p AS (
    SELECT sku, shop, 0 AS s, 0 AS t, available AS a, pending AS p FROM b_local WHERE shop <> '无'
    UNION ALL SELECT wl.sku, fs.t, 0, 0, available, pending FROM wl JOIN fs USING (sku)
    UNION ALL SELECT wl.sku, ls.t, 0, 0, available, pending FROM wl JOIN ls USING (sku) WHERE wl.sku NOT IN (SELECT sku FROM b_fba)
    UNION ALL SELECT sku, '无', 0, 0, available, pending FROM wl WHERE sku IN (SELECT sku FROM wf) OR (sku NOT IN (SELECT sku FROM b_fba) AND sku NOT IN (SELECT sku FROM ls))
    UNION ALL SELECT f.sku, f.shop, sellable, in_transit, 0, 0 FROM b_fba f LEFT JOIN fs USING (sku) WHERE f.shop <> '无' AND ((f.sku, f.shop) IN (SELECT (sku, shop) FROM b_local) OR f.shop = fs.t OR f.sku NOT IN (SELECT sku FROM wl))
    UNION ALL SELECT l.sku, l.shop, wf.sellable, wf.in_transit, 0, 0 FROM b_local l JOIN wf USING (sku) WHERE l.shop <> '无'
    UNION ALL SELECT sku, '无', sellable, in_transit, 0, 0 FROM wf WHERE sku IN (SELECT sku FROM wl)
), e AS (SELECT sku, shop, sum(s)::BIGINT AS sellable, sum(t)::BIGINT AS in_transit, sum(a)::BIGINT AS available, sum(p)::BIGINT AS pending FROM p GROUP BY ALL)"""


@query(_CELLS.replace("IN (SELECT (sku, shop) FROM b_local)", "IN (SELECT sku, shop FROM b_local)") + """ SELECT sku, spu, string_split(clean, '-')[1] || '-' || string_split(clean, '-')[2] AS spu_colour, shop, state, qty FROM (
    SELECT sku, shop, unnest(['fba_sellable', 'fba_in_transit', 'local_available', 'local_pending']) AS state, unnest([sellable, in_transit, available, pending]) AS qty FROM e)
    JOIN (SELECT DISTINCT sku, spu, replace(sku, '4PCS-', '') AS clean FROM b_products) USING (sku) WHERE qty > 0""")
def cmp_01_inventory_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.inventory_estimate(b.stock_cells(spark, folder))


def _order_comparison(spark: SparkSession, folder: str) -> DataFrame:
    cells = written(b.order_cells(spark, folder), "order-cells")  # once, for the three sides
    bought = cells.select("sku", "shop", F.col("month").alias("ordered"), F.col("bought").alias("qty"))
    planned = cells.select("sku", "shop", "month", F.col("planned").alias("qty"), F.col("planner").alias("owner"))
    listed = cells.where("listed is not null").select("sku", "shop", "listed.owner", "listed.ordinal")
    return orders.order_comparison(bought, planned, listed, b.fabric_pricing(spark, folder), b.colours(spark, folder), AS_OF)


_ORDER_SQL = f"""WITH o AS (SELECT sku, shop, date_trunc('month', ordered)::DATE AS month, sum(qty)::BIGINT AS ordered_qty FROM b_purchases WHERE shop <> '无' AND ordered >= DATE '2000-06-01' GROUP BY ALL),
p AS (SELECT sku, shop, month, sum(qty)::BIGINT AS planned_qty, max(owner) AS owner FROM b_planned WHERE month >= DATE '2000-06-01' GROUP BY ALL),
po AS (SELECT {spu("sku")} AS spu, shop, arg_min(owner, (month, sku)) AS o FROM p WHERE owner <> '' GROUP BY ALL), lo AS (SELECT spu, shop, arg_min(owner, (ordinal, owner)) AS o FROM b_owners WHERE owner <> '' GROUP BY ALL),
fb AS (SELECT spu, string_agg(DISTINCT fabric, ',' ORDER BY fabric) AS fabrics FROM b_pricing GROUP BY spu),
c AS (SELECT sku, {spu("sku")} AS spu, {colour("sku", 4)} AS colour, shop, month, coalesce(ordered_qty, 0) AS ordered_qty, coalesce(planned_qty, 0) AS planned_qty FROM o FULL JOIN p USING (sku, shop, month)),
cn AS (SELECT abbr AS colour, coalesce(arg_max(name, ordinal) FILTER (state = 'new'), arg_min(name, ordinal) FILTER (state = 'old')) AS colour_name FROM b_colours WHERE trim(name) <> '' GROUP BY abbr),
r AS (SELECT sku, spu, colour, coalesce(colour_name, '') AS colour_name, shop, month, coalesce(fabrics, '') AS fabrics, coalesce(po.o, lo.o, '') AS owner, ordered_qty, planned_qty, CASE WHEN planned_qty > 0 THEN 'yes' ELSE 'no' END AS has_plan,
    ordered_qty - planned_qty AS difference, {ratio("ordered_qty", "planned_qty")} AS fulfilled FROM c LEFT JOIN po USING (spu, shop) LEFT JOIN lo USING (spu, shop) LEFT JOIN fb USING (spu) LEFT JOIN cn USING (colour))"""


@query(f"{_ORDER_SQL} SELECT * FROM r")
def cmp_06_order_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return _order_comparison(spark, folder)


@query(f"{_ORDER_SQL}, s AS (SELECT spu, shop, month, colour, colour_name, fabrics, sum(ordered_qty)::BIGINT AS ordered_qty, sum(planned_qty)::BIGINT AS planned_qty, min(nullif(owner, '')) AS owner FROM r GROUP BY ALL) SELECT *, ordered_qty - planned_qty AS difference, {ratio('ordered_qty', 'planned_qty')} AS fulfilled FROM s WHERE planned_qty > 0")
def cmp_06_comparison_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return orders.comparison_sheet(_order_comparison(spark, folder))


def _style_stock(cells: DataFrame) -> DataFrame:
    """Stock by style; a fortieth of what years of lines add up to, so that some suggestions are above 0."""
    sums = lambda *names: F.coalesce(F.sum(sum(F.coalesce(n, F.lit(0).cast("bigint")) for n in names)), F.lit(0).cast("bigint"))
    held = cells.where("sellable is not null or available is not null").groupBy("spu", "shop").agg(sums("sellable", "in_transit", "available").alias("stock"), sums("pending").alias("pending"))
    return held.select("spu", "shop", F.expr("stock div 40").alias("stock"), F.expr("pending div 40").alias("pending"))


def _suggestions(spark: SparkSession, folder: str) -> DataFrame:
    last = forecast.shifted(AS_OF, P.months - 1)
    cells = written(b.supply_cells(spark, folder, FIRST, last), "supply-cells")  # once, for stock, factories and plans
    factory = cells.groupBy("spu", "shop").agg(F.max("latest").alias("x")).where("x is not null").select("spu", "shop", F.col("x.supplier_id").cast("string").alias("factory"))
    planned = cells.where("month is not null").select("spu", "shop", "month", F.col("planned").alias("qty"))
    return procurement.suggestions(_forecast(spark, folder), _style_stock(cells), b.fabric_pricing(spark, folder), b.custom_fabrics(spark, folder), factory, planned, FIRST)


SUGGESTED = f"""{FORECAST_REPORT},
g_total AS (SELECT spu, shop, sum(qty)::BIGINT AS total FROM f_rows GROUP BY ALL),
g_main AS (SELECT spu, arg_min(fabric, (-coalesce(usage, 0), fabric)) AS fabric FROM b_pricing GROUP BY spu),
g_kind AS (SELECT spu, fabric IN (SELECT fabric FROM b_custom) AS custom FROM g_main),
g_stock AS (SELECT {spu("sku")} AS spu, shop, sum(s)::BIGINT // 40 AS stock, sum(p)::BIGINT // 40 AS pending FROM (SELECT sku, shop, sellable + in_transit AS s, 0 AS p FROM b_fba UNION ALL SELECT sku, shop, available, pending FROM b_local) GROUP BY ALL),
g_factory AS (SELECT spu, shop, arg_max(supplier_id, (ordered, order_id, line, supplier_id))::VARCHAR AS factory FROM b_purchases WHERE status <> 'F' GROUP BY ALL),
g_ahead AS (SELECT spu, shop, sum(qty) FILTER (month < DATE '2000-08-01')::BIGINT AS p2, sum(qty) FILTER (month < DATE '2000-09-01')::BIGINT AS p3 FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-09-01' GROUP BY ALL),
g_rows AS (SELECT t.spu, t.shop, coalesce(factory, '') AS factory, CASE WHEN custom THEN 'custom' ELSE 'stock' END AS fabric_type, CASE WHEN custom THEN 3 ELSE 2 END::BIGINT AS cover,
    coalesce(e.stock, 0) + coalesce(w.stock, 0) AS stock, coalesce(e.pending, 0) + coalesce(w.pending, 0) AS pending, coalesce(CASE WHEN custom THEN p3 ELSE p2 END, 0) AS planned_total, total,
    greatest(0, total - coalesce(e.stock, 0) - coalesce(w.stock, 0) - coalesce(e.pending, 0) - coalesce(w.pending, 0)) AS suggested
    FROM g_total t LEFT JOIN g_kind USING (spu) LEFT JOIN g_stock e ON e.spu = t.spu AND e.shop = t.shop LEFT JOIN g_stock w ON w.spu = t.spu AND w.shop = '无'
    LEFT JOIN g_factory f ON f.spu = t.spu AND f.shop = t.shop LEFT JOIN g_ahead a ON a.spu = t.spu AND a.shop = t.shop)"""


@query(f"WITH {SUGGESTED} SELECT * FROM g_rows")
def cmp_07_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    return _suggestions(spark, folder)


@query(f"""WITH {SUGGESTED}, m AS (SELECT spu, shop, month, suggested, q * [15, 12, 9, 6][datediff('month', DATE '2000-06-01', month) + 1] AS w FROM (SELECT spu, shop, month, sum(qty)::BIGINT AS q FROM f_rows GROUP BY ALL) JOIN g_rows USING (spu, shop)),
s AS (SELECT *, CASE WHEN sum(w) OVER g > 0 THEN round_even((suggested::DECIMAL(18,0) * w) / (sum(w) OVER g), 0) ELSE 0 END AS share FROM m WINDOW g AS (PARTITION BY spu, shop))
SELECT spu, shop, month, suggested, CASE WHEN month = DATE '2000-09-01' THEN greatest(0, suggested - sum(share) OVER (PARTITION BY spu, shop ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) ELSE share END::BIGINT AS share FROM s""")
def cmp_07_monthly_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    return procurement.monthly_suggestions(_forecast(spark, folder), _suggestions(spark, folder), FIRST)


@query(f"WITH {SUGGESTED} SELECT fabric, count(DISTINCT spu) AS styles, sum(suggested)::BIGINT AS suggested, arg_max(coalesce(usage, 0), (spu, shop)) AS usage, (sum(suggested)::BIGINT * arg_max(coalesce(usage, 0), (spu, shop)))::DOUBLE / 100 AS metres FROM g_rows JOIN b_pricing USING (spu) WHERE fabric_type = 'custom' AND suggested > 0 GROUP BY fabric")
def cmp_07_fabric_need(spark: SparkSession, folder: str) -> DataFrame:
    return procurement.fabric_need(_suggestions(spark, folder), b.fabric_pricing(spark, folder))


_FABRIC_SQL = f"""WITH {FORECAST_REPORT}, k AS (SELECT sku, month, coalesce(p.q, 0)::BIGINT AS planned_qty, coalesce(s.q, 0)::BIGINT AS system_qty
    FROM (SELECT sku, month, sum(qty) AS q FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-09-01' GROUP BY ALL) p FULL JOIN (SELECT sku, month, sum(qty) AS q FROM f_rows GROUP BY ALL) s USING (sku, month)),
mn AS (SELECT fabric, (sum(usage)::BIGINT * 1000) // count(*) AS m FROM b_pricing WHERE usage > 0 GROUP BY fabric),
u AS (SELECT p.spu, p.fabric, ((CASE WHEN coalesce(usage, 0) = 0 THEN coalesce(m, 0) ELSE usage * 1000 END) * (CASE WHEN coalesce(loss, 0) = 0 THEN 100 ELSE loss END))::BIGINT AS per_piece, coalesce(usage, 0) = 0 AS missing FROM b_pricing p LEFT JOIN mn USING (fabric)),
j AS (SELECT k.*, {spu("sku")} AS spu, upper({colour("sku", 3)}) AS colour FROM k WHERE planned_qty > 0 OR system_qty > 0), x AS (SELECT * FROM j JOIN u USING (spu)),
pf AS (SELECT spu, arg_min(fabric, (-coalesce(usage, 0), fabric)) AS fabric FROM b_pricing GROUP BY spu),
a AS (SELECT 'total' AS kind, fabric, '' AS colour, month, planned_qty, system_qty, per_piece, missing, spu FROM x
    UNION ALL SELECT 'colour', fabric, CASE WHEN colour = 'RED' THEN 'WARM' ELSE colour END, month, planned_qty, system_qty, per_piece, missing, spu FROM x WHERE (spu, fabric) IN (SELECT spu, fabric FROM pf) AND fabric IN (SELECT fabric FROM b_custom) AND colour <> ''),
g AS (SELECT kind, fabric, colour, month, sum(planned_qty)::BIGINT AS planned_qty, sum(system_qty)::BIGINT AS system_qty, floor(sum(planned_qty * per_piece) / 100000.0::DOUBLE + 0.5)::BIGINT AS pc, floor(sum(system_qty * per_piece) / 100000.0::DOUBLE + 0.5)::BIGINT AS sc,
    coalesce(string_agg(DISTINCT spu, ',' ORDER BY spu) FILTER (missing), '') AS missing FROM a GROUP BY ALL),
st AS (SELECT upper(split_part(sku, '-', 1)) AS key, '' AS colour, sum(available)::BIGINT AS stock FROM stock GROUP BY ALL UNION ALL SELECT split_part(sku, '-', 1), split_part(sku, '-', 2), sum(available)::BIGINT FROM stock WHERE len(string_split(sku, '-')) = 2 GROUP BY ALL)
SELECT kind, fabric, coalesce(code, '') AS code, g.colour, month, planned_qty, system_qty, pc / 100.0::DOUBLE AS planned_metres, sc / 100.0::DOUBLE AS system_metres,
    CASE WHEN coalesce(roll, 0) > 0 THEN floor(pc::DOUBLE / roll + 0.5) / 100.0::DOUBLE ELSE 0.0 END AS planned_rolls, CASE WHEN coalesce(roll, 0) > 0 THEN floor(sc::DOUBLE / roll + 0.5) / 100.0::DOUBLE ELSE 0.0 END AS system_rolls,
    coalesce(stock, 0) AS stock_rolls, coalesce(stock, 0) * coalesce(roll, 0) AS stock_metres, missing
FROM g LEFT JOIN b_custom USING (fabric) LEFT JOIN st ON st.key = upper(coalesce(code, '')) AND st.colour = g.colour"""
_STOCK_SQL = f"stock AS (SELECT fabric[1:2] || '-' || {colour('sku', 3)} AS sku, size AS available FROM b_products)"


@query(_FABRIC_SQL.replace("WITH ", f"WITH {_STOCK_SQL}, ", 1))
def cmp_08_fabric_demand(spark: SparkSession, folder: str) -> DataFrame:
    stock = b.products(spark, folder).select(F.concat(F.substring("fabric", 1, 2), F.lit("-"), codes.colour_of(F.col("sku"), 3)).alias("sku"), F.col("size").alias("available"))
    custom = b.custom_fabrics(spark, folder)
    merged = custom.select("code", F.lit("RED").alias("colour"), F.lit("WARM").alias("merged"))
    return fabric.fabric_demand(_ahead(spark, folder), _forecast(spark, folder), b.fabric_pricing(spark, folder), custom, stock, merged)


def _profit_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.lines(spark, folder, dt.date(2000, 1, 1), dt.date(2001, 1, 1))
    return rows.select(
        F.concat_ws("-", "order_id", "line", "part_id", "supplier_id").alias("id"), F.when(F.col("part_id") % 6 == 0, "").otherwise(F.col("sku")).alias("sku"), F.concat(F.lit("LA"), "sku", F.lit("-FBA")).alias("msku"), "shop", F.concat(F.lit("own"), (F.col("supplier_id") % 9).cast("string")).alias("owner"), dates.month_of(F.col("shipped")).alias("month"),
        "cost", F.col("tax").alias("freight_cost"), F.col("qty").alias("sold"), (F.col("line") % 2).alias("reshipped"), (F.col("line") % 3).alias("returned"), "discount", "tax", "cents",
    )


_PROFIT_SQL = """WITH r AS (SELECT order_id || '-' || line || '-' || part_id || '-' || supplier_id AS id, CASE WHEN part_id % 6 = 0 THEN nullif(regexp_extract('LA' || sku || '-FBA', '^..(.+?)-FB[AM]', 1), '') ELSE sku END AS sku, shop, 'own' || (supplier_id % 9) AS owner, date_trunc('month', shipped)::DATE AS month, split_part(shop, '-', 1) || '-' AS brand,
    cost, tax AS freight_cost, qty + line % 2 - line % 3 AS actual, discount, tax, cents FROM b_lines WHERE shipped >= DATE '2000-01-01' AND shipped < DATE '2001-01-01'),
ws AS (SELECT sku, arg_min(weight, part_id)::DOUBLE AS w FROM b_products WHERE weight > 0 GROUP BY sku), wp AS (SELECT spu, sum(weight)::DOUBLE / count(*)::DOUBLE AS w FROM b_products WHERE weight > 0 GROUP BY spu),
f AS (SELECT *, split_part(shop, '-', 1) || '-' AS brand FROM b_freight WHERE price > 0),
lv AS (SELECT 0 AS level, shop, owner, '' AS brand, month, arg_min(price, ordinal)::DOUBLE AS price FROM f GROUP BY ALL UNION ALL SELECT 1, shop, '', '', month, sum(price)::DOUBLE / count(*)::DOUBLE FROM f GROUP BY ALL UNION ALL SELECT 2, '', '', brand, month, sum(price)::DOUBLE / count(*)::DOUBLE FROM f GROUP BY ALL),
o AS (SELECT level, shop, owner, brand, (month + to_months(k))::DATE AS month, arg_min(price, k) AS price, arg_min(month, k) AS matched FROM lv, range(0, 3) t(k) GROUP BY ALL),
c AS (SELECT r.*, coalesce(ws.w, wp.w) AS weight, CASE WHEN ws.w IS NOT NULL THEN 'sku' WHEN wp.w IS NOT NULL THEN 'spu' END AS weight_level, coalesce(a.price, b.price, d.price) AS price, coalesce(a.matched, b.matched, d.matched) AS price_month,
    CASE WHEN a.price IS NOT NULL THEN 'owner' WHEN b.price IS NOT NULL THEN 'shop' WHEN d.price IS NOT NULL THEN 'brand' END AS price_level
    FROM r LEFT JOIN ws USING (sku) LEFT JOIN wp ON wp.spu = CASE WHEN instr(r.sku, '-') > 1 THEN split_part(r.sku, '-', 1) END LEFT JOIN o a ON a.level = 0 AND a.shop = r.shop AND a.owner = r.owner AND a.month = r.month LEFT JOIN o b ON b.level = 1 AND b.shop = r.shop AND b.month = r.month
    LEFT JOIN o d ON d.level = 2 AND d.brand = r.brand AND d.month = r.month)"""


@query(f"{_PROFIT_SQL} SELECT id, shop, owner, month, price, price_level, price_month FROM c")
def jn_18_freight_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return profit.freight_price(_profit_records(spark, folder).select("id", "shop", "owner", "month"), b.freight(spark, folder)).drop("brand", "price_exact")


# Integers in tenths of thousand-millionths: weights and prices with twelve places, their product rounded at the seventh.
_EXACT = """, x AS (
    SELECT c.*, coalesce(ws.w::HUGEINT * 1000000000000, we.w) AS w12, CASE price_level WHEN 'owner' THEN price::HUGEINT * 1000000000000 ELSE pe.p END AS p12
    FROM c LEFT JOIN ws USING (sku)
    LEFT JOIN (SELECT spu, (2 * sum(weight)::HUGEINT * 1000000000000 + count(*)) // (2 * count(*)) AS w FROM b_products WHERE weight > 0 GROUP BY spu) we ON we.spu = CASE WHEN instr(c.sku, '-') > 1 THEN split_part(c.sku, '-', 1) END
    LEFT JOIN (SELECT 'shop' AS level, shop AS k, month, (2 * sum(price)::HUGEINT * 1000000000000 + count(*)) // (2 * count(*)) AS p FROM f GROUP BY ALL
        UNION ALL SELECT 'brand', brand, month, (2 * sum(price)::HUGEINT * 1000000000000 + count(*)) // (2 * count(*)) FROM f GROUP BY ALL) pe
        ON pe.level = c.price_level AND pe.month = c.price_month AND pe.k = CASE price_level WHEN 'shop' THEN c.shop ELSE c.brand END
), fee AS (SELECT *, coalesce(-sign(actual) * ((w12 * p12 * abs(actual) + 50000000000000000) // 100000000000000000), 0)::BIGINT AS fee FROM x)"""


@query(f"""{_PROFIT_SQL}{_EXACT} SELECT id, sku, weight, weight_level, price, price_level, price_month, actual, cost * 15000000 AS cost_addition, fee AS freight_fee,
    (sign(fee) * ((abs(fee) * 15 + 50) // 100))::BIGINT AS freight_addition, fee - freight_cost * 100000000 AS recorded_freight, (discount + tax) * 100000000 AS platform, cents * 100000000 AS revenue, tax * 100000000 AS advertising,
    -(cents + discount + tax + tax) * 1000000 AS exchange_loss FROM fee""")
def cmp_09_profit_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The decimals' ten places are shown as integers."""
    found = profit.calculated(_profit_records(spark, folder), b.products(spark, folder), b.freight(spark, folder), ["discount", "tax"], ["cents"], ["tax"])
    money = ("cost_addition", "freight_fee", "freight_addition", "recorded_freight", "platform", "revenue", "advertising", "exchange_loss")
    return found.withColumns({c: (F.col(c) * F.lit("10000000000").cast("decimal(11,0)")).cast("bigint") for c in money})


_FEES = {"discount": "promotion", "tax": "duty", "promo2": "vine", "promo3": "label"}


def _fees(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.lines(spark, folder, dt.date(2000, 5, 1), dt.date(2000, 6, 1))
    rows = rows.select("shop", F.when(F.col("line") == 7, "UNKNOW").otherwise(F.concat(F.lit("LA"), "sku")).alias("msku"), "discount", "tax", (F.col("line") % 3).alias("promo2"), (F.col("qty") % 4).alias("promo3"))
    return fees.expanded_fees(rows, _FEES, 40)


_FEE_SQL = """WITH s AS (SELECT shop, 'LA' || sku AS msku, sum(discount)::BIGINT AS a, sum(tax)::BIGINT AS b, sum(line % 3)::BIGINT AS c, sum(qty % 4)::BIGINT AS d FROM b_lines
    WHERE line <> 7 AND shipped >= DATE '2000-05-01' AND shipped < DATE '2000-06-01' AND (discount <> 0 OR tax <> 0 OR line % 3 <> 0 OR qty % 4 <> 0) GROUP BY ALL),
e AS (SELECT shop, msku, fee, amount, row_number() OVER (ORDER BY shop, msku, fee) - 1 AS n, dense_rank() OVER (PARTITION BY shop ORDER BY msku) - 1 AS m FROM (SELECT * FROM (SELECT shop, msku, unnest(['promotion', 'duty', 'vine', 'label']) AS fee, unnest([a, b, c, d]) AS amount FROM s) WHERE amount <> 0))"""


@query(f"{_FEE_SQL} SELECT shop, msku, fee, amount, n // 40 AS file FROM e")
def cmp_10_fee_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _fees(spark, folder)


@query(f"{_FEE_SQL} SELECT shop, m // 15 AS order_no, count(*) AS items, sum(amount)::BIGINT AS amount FROM e GROUP BY ALL")
def cmp_11_fee_orders(spark: SparkSession, folder: str) -> DataFrame:
    made = fees.fee_orders(_fees(spark, folder).drop("file"))
    return made.select("shop", "order_no", F.size("items").cast("bigint").alias("items"), "amount")


@query("""WITH h AS (SELECT order_id AS box, spu, sum(qty)::BIGINT AS qty FROM b_lines GROUP BY ALL) SELECT box, spu, qty, arg_min(spu, (-qty, spu)) OVER (PARTITION BY box) AS main_spu, (sum(qty) OVER (PARTITION BY box))::BIGINT AS box_qty FROM h""".replace("arg_min(spu, (-qty, spu)) OVER (PARTITION BY box)", "first_value(spu) OVER (PARTITION BY box ORDER BY qty DESC, spu)"))
def cmp_12_shipment_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return fees.box_contents(b.lines(spark, folder).select(F.col("order_id").alias("box"), "spu", "qty"))


@query("SELECT n.sku, n.shop, n.month, n.qty, coalesce(o.qty, 0) AS before, n.qty - coalesce(o.qty, 0) AS delta FROM b_planned n LEFT JOIN (SELECT sku, shop, month, qty - qty % 3 AS qty FROM b_planned WHERE qty % 5 <> 0) o USING (sku, shop, month) WHERE n.qty - coalesce(o.qty, 0) <> 0")
def cmp_13_plan_capture(spark: SparkSession, folder: str) -> DataFrame:
    now = b.planned_orders(spark, folder)
    return orders.plan_changes(now, now.where("qty % 5 <> 0").withColumn("qty", F.col("qty") - F.col("qty") % 3))


@query("SELECT sku, shop, month, qty - coalesce(before, 0) AS delta FROM (SELECT sku, shop, month, qty, CASE WHEN qty % 2 = 0 THEN qty END AS before FROM b_planned) WHERE qty - coalesce(before, 0) <> 0")
def flt_14_changes_only(spark: SparkSession, folder: str) -> DataFrame:
    now = b.planned_orders(spark, folder)
    return orders.plan_changes(now, now.where("qty % 2 = 0")).select("sku", "shop", "month", "delta")


@query("SELECT n.sku, n.shop, n.month, n.qty, coalesce(o.qty, 0) AS before FROM b_planned n LEFT JOIN (SELECT sku, shop, (month + INTERVAL 1 MONTH)::DATE AS month, qty FROM b_planned) o USING (sku, shop, month)")
def jn_27_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    now = b.planned_orders(spark, folder).select("sku", "shop", "month", "qty")
    before = now.select("sku", "shop", F.add_months("month", 1).alias("month"), F.col("qty").alias("before"))
    return now.join(before, ["sku", "shop", "month"], "left").na.fill(0, ["before"])


@query(f"""WITH {FORECAST_SHEET}, q AS (SELECT shop, sku, spu, sum(qty) FILTER (month = DATE '2000-06-01')::BIGINT AS f0, sum(qty) FILTER (month = DATE '2000-07-01')::BIGINT AS f1 FROM f_rows GROUP BY ALL), sells AS (SELECT shop, sku FROM f_series WHERE s_1 > 0),
lo AS (SELECT sku, shop, arg_min(owner, (ordinal, owner)) AS o FROM b_owners WHERE owner <> '' GROUP BY ALL), pf AS (SELECT spu, arg_min(fabric, (-coalesce(usage, 0), fabric)) AS fabric FROM b_pricing GROUP BY spu)
SELECT q.shop, q.sku, f0, f1, coalesce(e.available, 0) + coalesce(w.available, 0) AS available, coalesce(o, 'style ' || q.spu) AS owner, b_custom.fabric IS NOT NULL AS is_custom
FROM q SEMI JOIN sells USING (shop, sku) LEFT JOIN b_local e ON e.sku = q.sku AND e.shop = q.shop LEFT JOIN b_local w ON w.sku = q.sku AND w.shop = '无'
LEFT JOIN lo ON lo.sku = q.sku AND lo.shop = q.shop LEFT JOIN pf ON pf.spu = q.spu LEFT JOIN b_custom ON b_custom.fabric = pf.fabric""")
def cmp_14_sales_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Products that sold last month (the sheet reads no other month of this year), with owner and whether the style's fabric is a custom one."""
    sales = b.monthly_sales(spark, folder, *forecast.span(AS_OF))
    wide = forecast.forecast(sales, AS_OF, SHEET).withColumn("label", F.when(F.col("month") == F.lit(dt.date(2000, 6, 1)), "f0").when(F.col("month") == F.lit(dt.date(2000, 7, 1)), "f1"))
    wide = reshape.pivot_months(wide, ["shop", "sku", "spu"], "label", ["f0", "f1"], "qty")
    sells = forecast.series(sales, AS_OF, SHEET).where("s_1 + s_2 + s_3 > 0").select("shop", "sku")
    rows = lookup.wildcard_additive(wide.join(sells, ["shop", "sku"], "left_semi"), b.local_stock(spark, folder), "sku", "shop", ["available"])
    listed = ranking.first_wins(b.owners(spark, folder).where("owner <> ''"), ["sku", "shop"], ["ordinal", "owner"], ["owner"])
    rows = lookup.with_default(rows, listed, ["sku", "shop"], "owner", F.concat(F.lit("style "), F.col("spu")))
    rows = rows.join(procurement.primary_fabric(b.fabric_pricing(spark, folder)).select("spu", "fabric"), "spu", "left")
    custom = b.custom_fabrics(spark, folder).select("fabric", F.lit(True).alias("is_custom"))
    return lookup.with_default(rows, custom, ["fabric"], "is_custom", F.lit(False)).select("shop", "sku", "f0", "f1", "available", "owner", "is_custom")


@query("""SELECT strftime(ordered, '%Y-%m') AS month, count(DISTINCT spu) AS styles, sum(qty)::BIGINT AS qty, arg_min(spu, (-q, spu)) AS top_style FROM (SELECT *, sum(qty) OVER (PARTITION BY date_trunc('month', ordered), spu) AS q FROM b_purchases WHERE status <> 'F') GROUP BY 1""")
def cmp_15_monthly_summary(spark: SparkSession, folder: str) -> DataFrame:
    styles = b.purchases(spark, folder).where("status <> 'F'").groupBy(F.date_format("ordered", "yyyy-MM").alias("month"), "spu").agg(F.sum("qty").alias("q"))
    return styles.groupBy("month").agg(F.count(F.lit(1)).alias("styles"), F.sum("q").alias("qty"), F.min_by("spu", F.struct((-F.col("q")).alias("n"), "spu")).alias("top_style"))


@query("SELECT sku, shop, arg_min(owner, (owner = '', deleted, ordinal, owner)) AS owner, arg_min(ordinal, (owner = '', deleted, ordinal, owner)) AS ordinal FROM b_owners GROUP BY ALL")
def cmp_16_listing_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return fees.deduped_listings(b.owners(spark, folder), ["sku", "shop"], ["owner", "ordinal"])


@query("SELECT sku, n AS image, CASE WHEN c THEN o ELSE 'older' END AS previous, c AS changed, 1 + c::BIGINT AS changes FROM (SELECT sku, max(name) AS n, min(name) AS o, max(name) <> min(name) AS c FROM b_products GROUP BY sku)")
def cmp_17_image_tracking(spark: SparkSession, folder: str) -> DataFrame:
    by_sku = b.products(spark, folder).groupBy("sku").agg(F.max("name").alias("new"), F.min("name").alias("old"))
    before = by_sku.select("sku", F.col("old").alias("image"), F.lit(1).cast("bigint").alias("changes"), F.lit("older").alias("previous"))
    return fees.tracked_images(by_sku.select("sku", F.col("new").alias("image")), before)


@query("""WITH r AS (SELECT spu, part_id % 7 AS made, unnest([fabric, CASE WHEN size > 20 THEN name END, '无']) AS fabric, unnest([size, weight, 1]) AS usage FROM b_products), v AS (SELECT * FROM r WHERE fabric IS NOT NULL AND fabric <> '无')
SELECT spu, made, fabric, usage FROM v QUALIFY rank() OVER (PARTITION BY spu ORDER BY made DESC) = 1""")
def cmp_18_fabric_prices(spark: SparkSession, folder: str) -> DataFrame:
    records = b.products(spark, folder).select(
        "spu", (F.col("part_id") % 7).alias("made"), F.col("fabric").alias("fabric1"), F.col("size").alias("usage1"), F.when(F.col("size") > 20, F.col("name")).alias("fabric2"), F.col("weight").alias("usage2"), F.lit(NONE).alias("fabric3"), F.lit(1).cast("bigint").alias("usage3"),
    )
    return fabric.latest_pricing(records)


@query(f"""WITH k AS (SELECT sku, month, sum(qty)::BIGINT AS planned_qty FROM b_planned WHERE month BETWEEN DATE '2000-06-01' AND DATE '2000-09-01' GROUP BY ALL HAVING sum(qty) <> 0), mn AS (SELECT fabric, (sum(usage)::BIGINT * 1000) // count(*) AS m FROM b_pricing WHERE usage > 0 GROUP BY fabric),
u AS (SELECT p.spu, p.fabric, ((CASE WHEN coalesce(usage, 0) = 0 THEN coalesce(m, 0) ELSE usage * 1000 END) * (CASE WHEN coalesce(loss, 0) = 0 THEN 100 ELSE loss END))::BIGINT AS per_piece FROM b_pricing p LEFT JOIN mn USING (fabric))
SELECT sku, fabric, month, code || '-' || c AS fabric_colour, planned_qty, floor(planned_qty * per_piece / 100000.0::DOUBLE + 0.5) / 100.0::DOUBLE AS metres FROM (SELECT *, {spu("sku")} AS spu, upper({colour("sku", 3)}) AS c FROM k) JOIN u USING (spu) JOIN b_custom USING (fabric) WHERE c <> ''""")
def cmp_19_product_demand(spark: SparkSession, folder: str) -> DataFrame:
    return fabric.product_demand(_ahead(spark, folder), b.fabric_pricing(spark, folder), b.custom_fabrics(spark, folder))


@query("SELECT sku, shop, available, pending, coalesce(name, '') AS name FROM b_local LEFT JOIN (SELECT sku, arg_min(name, part_id) AS name FROM b_products GROUP BY sku) USING (sku) WHERE available <> 0 OR pending <> 0")
def cmp_20_inventory_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.inventory_sheet(b.local_stock(spark, folder), b.products(spark, folder))


@query("SELECT 'order_id' AS key, count(*) AS n, count(DISTINCT order_id) AS keys FROM b_lines UNION ALL SELECT 'sku', count(*), count(DISTINCT sku) FROM b_lines UNION ALL SELECT 'shop', count(*), count(DISTINCT shop) FROM b_lines")
def cmp_21_join_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows and keys each join key has; plans are read with ``explain('formatted')``."""
    found = b.lines(spark, folder).agg(F.count(F.lit(1)).alias("n"), *(F.countDistinct(k).alias(k) for k in ("order_id", "sku", "shop")))
    return found.select("n", F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).alias("keys")) for k in ("order_id", "sku", "shop")))).alias("x")).select("x.key", "n", "x.keys")
