"""Scalar functions on given cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomwright.functions import cells, codes, dates, numbers
from loomwright.functions.nulls import any_nonzero, first_present, or_default, present, text_or


def over(spark, made, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in rows.select("i", made(F.col("x")).alias("y")).orderBy("i").collect()]


def test_codes(spark):
    given = ("ABC-RED-XL", "ABC-LONG-RED-XL", "ABC-SHORT-BLUE-M", "ABC-4PSC-RED-XL", "ABC", "ABC-RED", None)
    assert over(spark, codes.spu_of, *given) == ["ABC"] * 6 + [None]
    assert over(spark, lambda x: codes.colour_of(x, 4), *given)[:4] == ["RED", "RED", "BLUE", "RED"]
    assert over(spark, lambda x: codes.colour_of(x, 4), "ABC-LONG-RED") == ["LONG"]
    assert over(spark, lambda x: codes.colour_of(x, 3), "ABC-LONG-RED") == ["RED"]
    assert over(spark, lambda x: codes.spu_and_colour(x)["spu_colour"], *given)[4:6] == ["无", "RED"]
    assert over(spark, codes.without_pack, "-A--4pcs-B-", "4PCS") == ["A-B", ""]


def test_marketplace_codes(spark):
    assert over(spark, codes.sku_of_msku, "LAX-1-FBA2", "LAX-FBM-FBA", "LAX", "LA-FBA") == ["X-1", "X", None, None]
    assert over(spark, codes.spu_of_msku, "LAZSY503-BKM-FBA", "AB") == ["ZSY503", "AB"]
    assert over(spark, codes.brand_of, "RR-US", "-US", "RR") == ["RR-", None, None]
    assert over(spark, codes.shop_name, "RR-UK", "RR_DE", "RRX") == ["RR-EU", "RR-EU", "RRX"]
    assert over(spark, codes.first_name, "a;b,c", "a；b", "a/b|c", "a") == ["a;b", "a", "a/b", "a"]
    assert over(spark, codes.box_number, "FBA1U000012", "FBA1U000", "FBA1") == ["12", "0", "FBA1"]


def test_numbers(spark):
    assert over(spark, numbers.int_of_number_text, "12.5", "x", None, " 7 ") == [12, 0, 0, 7]
    assert over(spark, numbers.int_of_integer_text, "12.5", "12", "", None) == [0, 12, 0, 0]
    assert over(spark, numbers.number_or_null, "1.5", " ", "x", None) == [1.5, None, None, None]
    assert [float(x) for x in over(spark, numbers.to_decimal, "1.25", "x", None)] == [1.25, 0, 0]
    one = spark.range(1)
    row = one.select(numbers.ratio(F.lit(1), F.lit(0)), numbers.ratio(F.lit(1), F.lit(3)), numbers.round_half_even(F.lit(2.5).cast("decimal(3,1)")), numbers.guarded(F.lit(1), F.lit(0))).collect()[0]
    assert row[0] is None and row[1] == 0.3333 and row[2] == 2 and row[3] == 0.0


def test_missing_values(spark):
    assert over(spark, lambda x: present(x), "a", " ", "无", None) == [True, False, False, False]
    assert over(spark, lambda x: or_default(x, "d"), "a", "", None, "0", "0.0", "5") == ["a", "d", "d", "d", "d", "5"]
    assert over(spark, lambda x: text_or(x, "d"), " a ", " ", None) == ["a", "d", "d"]
    row = spark.range(1).select(first_present(F.lit(None).cast("string"), F.lit(" "), F.lit("x")), any_nonzero(F.lit(None).cast("int"), F.lit(0))).collect()[0]
    assert row[0] == "x" and row[1] is False


def test_dates(spark):
    assert over(spark, dates.month_of_label, "26年4月销量", "99年12月", "26年13月", "x") == [dt.date(2026, 4, 1), dt.date(1999, 12, 1), None, None]
    assert over(spark, dates.tolerant_date, "2000-01-02 03:04", "2000/01/02", "2000-13-01", None) == [dt.date(2000, 1, 2)] * 2 + [None, None]
    given = ("2024-01-01 20:00:00Z", "2024-01-01T20:00:00-03:30", "2024-01-01 20:00:00 PST", "2024-01-01", "2024-01-01 20:00:00", "soon")
    assert over(spark, dates.beijing_time, *given) == ["2024-01-02 04:00:00", "2024-01-02 07:30:00", "2024-01-02 12:00:00", "2024-01-01", "2024-01-01 20:00:00", None]


@pytest.mark.parametrize(
    ("raw", "text"),
    [('[{"text":"a"},{"text":"b"}]', "a,b"), ('{"users":[{"name":"u"},{"name":"v"}]}', "u,v"), ("{'text': 'q'}", "q"), ("plain", "plain"), ("5", "5"), (None, "")],
)
def test_cell_texts(spark, raw, text):
    assert over(spark, cells.cell_texts, raw) == [text]


def test_cells(spark):
    assert over(spark, cells.cell_text, '[{"text":"a"}]', '{"text":"b"}', "c", None) == ["a", "b", "c", ""]
    assert over(spark, cells.cell_number, '[{"text":"2.5"}]', "3", "x", None) == [2.5, 3.0, 0.0, 0.0]
    assert over(spark, cells.joined_list, '["a","b"]', "c", "", None) == ["a,b", "c", "", ""]
    assert over(spark, lambda x: cells.field(x, "f"), '{"f":"1"}', '[{"f":"2"}]', "x") == ["1", "2", None]
