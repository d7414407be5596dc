"""The registry, and the business tables of :mod:`loomwright.sources.business` as SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Cleaning of a code, its style, and its parts, as SQL.
PACK = r"regexp_replace(regexp_replace(regexp_replace(trim({0}), '(?i)[0-9]+(?:PSC|PCS)', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g')"
SPU = f"(CASE WHEN split_part({PACK}, '-', 1) = '' THEN {PACK} ELSE split_part({PACK}, '-', 1) END)"
PARTS = f"string_split({PACK}, '-')"


def pack(c: str) -> str:
    return PACK.format(c)


def spu(c: str) -> str:
    return SPU.format(c)


def colour(c: str, least: int) -> str:
    p = PARTS.format(c)
    return f"coalesce(CASE WHEN len({p}) >= {least} AND upper({p}[2]) IN ('LONG', 'SHORT') THEN {p}[3] ELSE {p}[2] END, '')"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {b} <> 0 THEN floor({a}::DOUBLE / {b}::DOUBLE * 10000.0 + 0.5) / 10000.0 END)"


VIEWS = {
    "b_products": f"""SELECT *, {spu("sku")} AS spu FROM (
        SELECT p_partkey AS part_id, replace(p_brand, '#', '') || '-' || CASE WHEN p_partkey % 5 = 0 THEN 'LONG-' ELSE '' END || upper(split_part(p_name, ' ', 1)) || '-'
            || CASE WHEN p_partkey % 7 = 0 THEN '4PCS-' ELSE '' END || p_size AS sku, p_type AS fabric, p_size::BIGINT AS size,
            (CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 20 END)::BIGINT AS weight, round(p_retailprice * 100)::BIGINT AS cost, p_name AS name FROM part)""",
    "b_shops": """SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 11 = 0 THEN '无' ELSE 'N' || n_nationkey || CASE WHEN n_regionkey = 1 THEN '-US' ELSE '-EU' END END AS shop
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "b_lines": """SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id, l_linenumber::BIGINT AS line, l_quantity::BIGINT AS qty,
            round(l_extendedprice * 100)::BIGINT AS cents, round(l_discount * 100)::BIGINT AS discount, round(l_tax * 100)::BIGINT AS tax, l_returnflag AS flag, l_linestatus AS state,
            l_shipdate::DATE AS shipped, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate::DATE AS ordered, o_orderpriority AS priority, shop, sku, fabric, size, weight, cost, name, spu
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN b_shops s ON s.customer_id = o_custkey JOIN b_products p ON p.part_id = l_partkey""",
    "b_sales": "SELECT shop, sku, spu, date_trunc('month', shipped)::DATE AS month, sum(qty)::BIGINT AS qty FROM b_lines WHERE shop <> '无' GROUP BY ALL",
    "b_planned": """SELECT shop, sku, spu, date_trunc('month', ordered)::DATE AS month, sum(qty % 17)::BIGINT AS qty,
            max(CASE WHEN customer_id % 3 = 0 THEN '' ELSE 'op' || (customer_id % 7) END) AS owner
        FROM b_lines WHERE shop <> '无' GROUP BY ALL""",
    "b_fba": "SELECT sku, shop, sum(qty % 7)::BIGINT AS sellable, sum(line % 3)::BIGINT AS in_transit FROM b_lines WHERE flag = 'A' GROUP BY ALL",
    "b_local": "SELECT sku, shop, sum(qty % 5)::BIGINT AS available, sum(line % 2)::BIGINT AS pending FROM b_lines WHERE flag = 'R' GROUP BY ALL",
    "b_pricing": "SELECT spu, fabric, max(CASE WHEN size % 10 <> 0 THEN size * 2 END) AS usage, max(part_id % 20 + 100) AS loss FROM b_products GROUP BY ALL",
    "b_custom": "SELECT fabric, fabric[1:2] AS code, length(fabric)::BIGINT AS roll FROM (SELECT DISTINCT fabric FROM b_products) WHERE length(fabric) >= 6",
    "b_owners": """SELECT sku, spu, shop, CASE WHEN supplier_id % 4 = 0 THEN '' ELSE 'own' || (supplier_id % 9) END AS owner, line % 2 AS deleted,
            order_id * 1000 + line * 100 + supplier_id % 100 AS ordinal FROM b_lines WHERE shop <> '无'""",
    "b_freight": """SELECT 'N' || n_nationkey || CASE WHEN n_regionkey = 1 THEN '-US' ELSE '-EU' END AS shop, 'own' || (s_suppkey % 9) AS owner, make_date(2000, (s_suppkey % 12 + 1)::INT, 1) AS month,
            round(greatest(s_acctbal, 0))::BIGINT AS price, s_suppkey AS ordinal FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "b_purchases": "SELECT order_id, line, part_id, shop, sku, spu, ordered, shipped, qty, status, supplier_id FROM b_lines",
    "b_colours": """SELECT upper(split_part(p_name, ' ', 1)) AS abbr, CASE WHEN p_size % 9 <> 0 THEN upper(p_name[1]) || lower(split_part(p_name, ' ', 1)[2:]) || ' ' || p_size ELSE ' ' END AS name,
            CASE WHEN p_partkey % 4 = 0 THEN 'new' ELSE 'old' END AS state, p_partkey AS ordinal FROM part WHERE p_partkey % 4 < 2""",
    "b_month": "SELECT DISTINCT month FROM b_sales",
}


def expand(sql: str) -> str:
    """The query with the business tables it names, and theirs, as common tables."""
    names: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in names:
                need(VIEWS[name])
                names.append(name)

    need(sql)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    if not names:
        return sql
    body = sql.strip()
    if re.match(r"WITH\s+RECURSIVE\s", body):
        return f"WITH RECURSIVE {ctes},\n{re.sub(r'^WITH\s+RECURSIVE\s+', '', body)}"
    return f"WITH {ctes},\n{body[4:].lstrip()}" if re.match(r"WITH\s", body) else f"WITH {ctes}\n{body}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = expand(sql)
        return f

    return register


def registered(name: str, f: Query, sql: str | None = None) -> None:
    f.__name__ = name
    query(sql)(f)
