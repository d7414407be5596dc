"""Golden values, quirks, and plans against row-by-row models."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwright.operators import lookup, ranking, reshape
from loomwright.plans import fees, forecast, inventory, procurement
from loomwright.sources import business

AS_OF = dt.date(2026, 4, 23)
NONE = "无"


def sales(spark, **series):
    """Monthly sales of products, by months before the run."""
    rows = [("s", sku, sku.split("_")[0], forecast.shifted(AS_OF, -k), q) for sku, months in series.items() for k, q in months.items()]
    return spark.createDataFrame(rows, "shop string, sku string, spu string, month date, qty long")


def forecast_of(spark, sku="A_1", **series):
    rows = forecast.forecast(sales(spark, **series), AS_OF).where(F.col("sku") == sku).orderBy("month").collect()
    return [r["qty"] for r in rows], [r["method"] for r in rows], rows[0]["trend"]


def test_year_before_times_trend(spark):
    qty, methods, trend = forecast_of(spark, A_1={1: 122, 13: 100, 12: 180, 11: 220, 10: 300, 9: 350})
    assert (qty, trend) == ([219, 268, 366, 427], 122) and set(methods) == {"L1_trend"}


def test_trend_is_clamped(spark):
    assert forecast_of(spark, A_1={1: 900, 13: 100, 12: 10})[2] == 300
    assert forecast_of(spark, A_1={1: 1, 13: 100, 12: 10})[2] == 30


def test_rising_new_product_grows_with_damping(spark):
    qty, methods, _ = forecast_of(spark, A_1={3: 30, 2: 60, 1: 90})
    assert qty == [135, 175, 207, 229] and set(methods) == {"L3_damped"}


def test_flat_new_product_takes_the_mean(spark):
    qty, methods, _ = forecast_of(spark, A_1={3: 80, 2: 85, 1: 82})
    assert qty == [82] * 4 and set(methods) == {"L3_mean"}


def test_recent_growth_comes_before_the_style(spark):
    """An old product without a trend takes its recent sales even if its style has a trend."""
    qty, methods, trend = forecast_of(spark, A_1={12: 150, 1: 57, 2: 57, 3: 57}, A_2={1: 120, 13: 100})
    assert trend is None and qty[0] == 57 and methods[0] == "L3_mean"


def test_style_comes_last(spark):
    qty, methods, _ = forecast_of(spark, A_1={12: 150}, A_2={1: 120, 13: 100})
    assert qty[0] == 180 and methods[0] == "L4_style" and methods[1] == "L5_none"


def test_flat_level_is_never_reached(spark):
    rows = forecast.forecast(business.monthly_sales(spark, "/root/testdata/sf0.01"), business.AS_OF)
    assert rows.where("method like 'L2%'").isEmpty()


def row_model(f: dict, l: dict) -> dict:
    """Walk the cells in the order of the rules, adding to or starting rows."""
    out: dict = {}

    def add(key, s=0, t=0, a=0, p=0):
        old = out.get(key, (0, 0, 0, 0))
        out[key] = tuple(x + y for x, y in zip(old, (s, t, a, p), strict=True))

    prefer = lambda shops: min(shops, key=lambda x: (not x.endswith("US"), x)) if shops else None
    skus = {k[0] for k in f} | {k[0] for k in l}
    for sku in skus:
        fs = [x for (q, x) in f if q == sku and x != NONE]
        ls = [x for (q, x) in l if q == sku and x != NONE]
        fn, ln = f.get((sku, NONE)), l.get((sku, NONE))
        for shop in set(fs) & set(ls):
            add((sku, shop), *f[sku, shop], *l[sku, shop])
        target = None
        if ln is not None:
            if fs or fn is not None:
                target = prefer(fs)
                if target is not None:
                    if (sku, target) in out:
                        add((sku, target), a=ln[0], p=ln[1])
                    else:
                        add((sku, target), *f[sku, target], *ln)
            elif ls:
                add((sku, prefer(ls)), a=ln[0], p=ln[1])
            else:
                add((sku, NONE), a=ln[0], p=ln[1])
        if fn is not None:
            for shop in ls:
                add((sku, shop), *fn)
            if ln is not None:
                add((sku, NONE), *fn, *ln)
        for shop in set(fs) - set(ls):
            if ln is None:
                add((sku, shop), *f[sku, shop])
        for shop in set(ls) - set(fs):
            add((sku, shop), a=l[sku, shop][0], p=l[sku, shop][1])
    return {k: v for k, v in out.items() if any(v)}


def test_inventory_estimate_equals_the_row_model(spark):
    random.seed(3)
    f, l = {}, {}  # noqa: E741
    for n in range(400):
        for cells in (f, l):
            for shop in random.sample(["A-US", "B-US", "C-EU", "D-EU", NONE], random.randint(0, 4)):
                cells[f"S{n}-RED-1", shop] = (random.randint(0, 9), random.randint(0, 9))
    fba = spark.createDataFrame([(*k, *v) for k, v in f.items()], "sku string, shop string, sellable long, in_transit long")
    local = spark.createDataFrame([(*k, *v) for k, v in l.items()], "sku string, shop string, available long, pending long")
    found = {(r["sku"], r["shop"]): (r["sellable"], r["in_transit"], r["available"], r["pending"]) for r in inventory.estimate_cells(fba, local).collect()}
    assert {k: v for k, v in found.items() if any(v)} == row_model(f, l)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.lists(st.integers(0, 90), min_size=1, max_size=6)), min_size=1, max_size=20))
def test_allocation_adds_up(spark, groups):
    rows = [(g, m, total, w) for g, (total, weights) in enumerate(groups) for m, w in enumerate(weights)]
    out = reshape.allocate(spark.createDataFrame(rows, "g long, m long, total long, w long"), ["g"], "m", "total", "w", "share")
    sums: dict = {}
    for r in out.collect():
        assert r["share"] >= 0
        sums.setdefault(r["g"], []).append(r)
    for found in sums.values():
        total = found[0]["total"]
        parts = sorted(found, key=lambda r: r["m"])
        before = sum(r["share"] for r in parts[:-1])
        assert parts[-1]["share"] == max(0, total - before)


def test_first_fitting_prefix_wins(spark):
    codes = spark.createDataFrame([("AB-C-1",), ("AB-D",), ("ABX-1",), ("AB",)], "sku string")
    prefixes = spark.createDataFrame([("AB", 1), ("AB-C", 2), ("ABX", 3)], "code string, v long")
    found = {r["sku"]: r["v"] for r in lookup.prefix_lookup(codes, "sku", prefixes, "code", "v", "v").collect()}
    assert found == {"AB-C-1": 1, "AB-D": 1, "ABX-1": 3, "AB": None}


def test_as_of_takes_the_nearest_month(spark):
    d = lambda m: dt.date(2000, m, 1)
    table = spark.createDataFrame([("a", d(1), 10), ("a", d(3), 30)], "k string, month date, v long")
    probe = spark.createDataFrame([("a", d(m)) for m in range(1, 8)] + [("b", d(1))], "k string, month date")
    found = {(r["k"], r["month"].month): r["v"] for r in lookup.as_of_months(probe, table, ["k"], "month", "v", 2, "v", ["k", "month"]).collect()}
    assert found == {("a", 1): 10, ("a", 2): 10, ("a", 3): 30, ("a", 4): 30, ("a", 5): 30, ("a", 6): None, ("a", 7): None, ("b", 1): None}


def test_owner_beats_undeleted(spark):
    rows = spark.createDataFrame([("k", "", 0, 1), ("k", "x", 1, 2), ("k", "y", 1, 3)], "sku string, owner string, deleted long, ordinal long")
    assert fees.deduped_listings(rows, ["sku"], ["owner"]).collect()[0]["owner"] == "x"


def test_main_fabric_ties_go_by_name(spark):
    rows = spark.createDataFrame([("s", "b", 5), ("s", "a", 5), ("s", "c", None)], "spu string, fabric string, usage long")
    assert procurement.primary_fabric(rows).collect()[0]["fabric"] == "a"


@pytest.mark.parametrize("limit", [1, 2, 50])
def test_orders_have_bounded_size(spark, limit):
    rows = spark.createDataFrame([("s", f"m{i}", "fee", i + 1) for i in range(7)], "shop string, msku string, fee string, amount long")
    sizes = [len(r["items"]) for r in fees.fee_orders(rows, limit).collect()]
    assert sum(sizes) == 7 and max(sizes) <= limit


def test_chunks_go_on_over_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), (F.col("id") * 37 % 1000).alias("o")).withColumn("k", F.when(F.col("k") == 1, 1))
    found = ranking.chunked(rows, ["k"], ["o"], 30).collect()
    assert len(found) == 1000
    for k in (None, 1):
        mine = sorted((r["o"], r["chunk"]) for r in found if r["k"] == k)
        assert [c for _, c in mine] == [i // 30 for i in range(500)]


def test_profit_fields_are_exact_decimals(spark):
    """Against Decimal, half up at ten places, with means that don't end and negative quantities."""
    from decimal import ROUND_HALF_UP, Decimal

    from loomwright.plans.profit import calculated

    products = spark.createDataFrame([(1, "A-1", "A", 333), (2, "A-2", "A", 100), (3, "A-3", "A", 101), (4, "B-1", "B", 7)], "part_id long, sku string, spu string, weight long")
    freight = spark.createDataFrame([("N1-US", "o", dt.date(2024, 1, 1), 17, 1), ("N1-US", "p", dt.date(2024, 1, 1), 22, 2), ("N1-US", "q", dt.date(2024, 1, 1), 1001, 3)], "shop string, owner string, month date, price long, ordinal long")
    kind = "id string, sku string, msku string, shop string, owner string, month date, cost long, freight_cost long, sold long, reshipped long, returned long, f long, r long, a long"
    rows = [(f"{sku}{owner}{sold}", sku, "", "N1-US", owner, dt.date(2024, 1, 1), 12345, 77, sold, 1, 2, 333, 98765, 41) for sku in ("A-1", "A-9", "B-1", "C-1") for owner in ("o", "x") for sold in (0, 3, 17)]
    found = {r["id"]: r for r in calculated(spark.createDataFrame(rows, kind), products, freight, ["f"], ["r"], ["a"]).collect()}
    to = lambda x, places=10: x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)
    weight = {"A-1": Decimal(333), "A-9": to(Decimal(534) / 3, 12), "B-1": Decimal(7)}
    price = {"o": Decimal(17), "x": to(Decimal(1040) / 3, 12)}
    for key, sku, _, _, owner, _, cost, paid, sold, *_ in rows:
        fee = -to(weight[sku] / 1000 * (sold - 1) * price[owner]) if sku in weight else Decimal(0)
        r = found[key]
        assert r["freight_fee"] == fee and r["freight_addition"] == to(fee * Decimal("0.15")) and r["recorded_freight"] == fee - Decimal(paid) / 100
        assert r["cost_addition"] == to(Decimal(cost) / 100 * Decimal("0.15")) and r["exchange_loss"] == -to(Decimal(333 + 98765 + 41) / 100 * Decimal("0.01"))


def test_colour_names_prefer_the_last_new_record(spark):
    from loomwright.plans.orders import colour_names

    rows = [("RED", "old red", "old", 1), ("RED", "r1", "new", 2), ("RED", "r2", "new", 3), ("BLU", "b1", "old", 1), ("BLU", "b2", "old", 2), ("BLU", " ", "new", 9), (" ", "x", "new", 1), (None, "y", "new", 1), ("GRN", None, "new", 1)]
    found = colour_names(spark.createDataFrame(rows, "abbr string, name string, state string, ordinal long")).collect()
    assert {tuple(r) for r in found} == {("RED", "r2"), ("BLU", "b1")}


def test_joins_of_lines_have_partitions_by_the_size_of_the_table(spark):
    """The session's number of partitions was that of every table, so a task's rows grew with it."""
    big, other = (spark.range(50).selectExpr("id AS k", f"id * 2 AS {v}") for v in ("a", "b"))
    plan = lambda *more: business.joined(big, other, "k", *more)._jdf.queryExecution().executedPlan().toString()
    assert plan(77, 1 << 40).count("hashpartitioning(k") == 2 and ", 77)" in plan(77, 1 << 40)
    assert ", 77)" not in plan(77, 1 << 20) and ", 3)" not in plan(3, 1 << 40)
    assert business.joined(big, other, "k", 77, 1 << 40).count() == 50


def test_five_keys_sort_no_lines(spark, small):
    """The smallest text was an aggregate by sorting over all lines of a task."""
    from loomwright.queries import QUERIES

    plan = QUERIES["agg_18_five_keys"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[spu" in plan.replace("\n", "") and plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_suggestions_read_lines_twice(spark, small):
    """Sales, and all else in one pass; stocks, purchases and plans were one pass each."""
    from loomwright.queries import QUERIES

    plan = QUERIES["cmp_07_suggestions"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Relation [l_orderkey") == 1


@pytest.fixture
def settings_of(spark):
    """Sets the session's settings for a test."""
    before = {}

    def to(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield to
    for name, value in before.items():
        spark.conf.set(name, value)


def exchanges(df, key):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if f"Exchange hashpartitioning({key}#" in x]


def test_joins_of_lines_keep_their_partitions_where_the_session_has_more(spark, settings_of):
    """With as many partitions in the session the join was left to it, and merged to one for each core whatever they held."""
    settings_of("spark.sql.shuffle.partitions", "200")
    big, other = (spark.range(50).selectExpr("id AS k", f"id * 2 AS {v}") for v in ("a", "b"))
    found = exchanges(business.joined(big, other, "k", 77, 1 << 40), "k")
    assert len(found) == 2 and all("REPARTITION_BY_NUM" in x for x in found)


def test_lines_are_joined_in_partitions_by_their_size(spark, small, settings_of, monkeypatch):
    """Customers with nations, and orders with these, were taken for tables that may be broadcast by their files; Catalyst never does, as it estimates such joins as products."""
    monkeypatch.setattr(business, "PART", 1 << 11)  # the files have 116,347 and 36,281 bytes
    settings_of("spark.sql.autoBroadcastJoinThreshold", "13k")
    rows = business.monthly_sales(spark, small)
    for key, parts in (("order_id", 57), ("customer_id", 5)):
        found = exchanges(rows, key)
        assert len(found) == 2 and all(f", {parts}), REPARTITION_BY_NUM" in x for x in found)


def test_styles_are_rolled_up_without_a_table_of_products(spark, small):
    """Lines were added up by product and month first, which each task held a table of."""
    from loomwright.queries import QUERIES

    rows = QUERIES["agg_21_style_roll_up"](spark, small)
    assert rows._jdf.queryExecution().executedPlan().toString().count("HashAggregate(") == 2
    want = business.monthly_sales(spark, small).groupBy("spu", "shop", "month").agg(F.sum("qty").alias("qty"))
    assert rows.count() and rows.schema == want.schema and rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()


def test_months_of_shops_are_pivoted_without_a_table_of_products(spark, small):
    """The pivot read sales by product, which each task held a table of; it needs those by shop."""
    from loomwright.queries import QUERIES

    rows = QUERIES["exp_07_pivot"](spark, small)
    assert not any("HashAggregate(keys=[" in x and "sku" in x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines())
    want = business.monthly_sales(spark, small).groupBy("shop").agg(*(F.sum(F.when(F.col("month") == dt.date(2000, m, 1), F.col("qty")).otherwise(0)).alias(f"m{m}") for m in (4, 5, 6)))
    assert rows.count() and rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
