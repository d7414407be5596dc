"""Sales forecasts: trend factor, damped growth, a cascade of methods, and their comparison with plans."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.functions.numbers import clamp, ratio


@dataclass(frozen=True)
class Forecast:
    """``history`` is what a report has read: ``full`` all months that the methods name; ``short`` (the comparison of
    forecasts and plans, and what is built on it) last year only from the month before the run on; ``sheet`` (the sales
    sheet) of the months just past only the last one, too.  Months that aren't read count as 0."""

    weights: tuple[float, ...] = (0.6, 0.3, 0.1)
    low: float = 0.3
    high: float = 3.0
    least_recent: int = 5
    old_growth: float = 0.4
    new_growth: float = 0.6
    rising: float = 0.05
    most_growth: float = 0.5
    damping: float = 0.6
    months: int = 4
    history: str = "full"


#: By history, the months (before the run's) that aren't read.
UNREAD = {"full": (), "short": (14, 15), "sheet": (2, 3, 14, 15)}


def shifted(day: dt.date, months: int) -> dt.date:
    """The first day of the month that many months later."""
    n = day.year * 12 + day.month - 1 + months
    return dt.date(n // 12, n % 12 + 1, 1)


def span(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The days (from, to before) whose sales a forecast reads."""
    return shifted(as_of, -15), shifted(as_of, 0)


def series(sales: DataFrame, as_of: dt.date, p: Forecast) -> DataFrame:
    """shop, sku, spu and one column for each month that a forecast reads: s_1 is last month, s_13 a year before it.

    One pass of conditional sums; only the months named are read.
    """
    lags = sorted({k for i in range(1, 4) for k in (i, i + 12)} | {12 - step for step in range(p.months)})
    lags = [k for k in lags if k not in UNREAD[p.history]]
    sums = [F.coalesce(F.sum(F.when(F.col("month") == F.lit(shifted(as_of, -k)), F.col("qty"))), F.lit(0).cast("bigint")).alias(f"s_{k}") for k in lags]
    wide = sales.where(F.col("month").isin([shifted(as_of, -k) for k in lags])).groupBy("shop", "sku", "spu").agg(*sums)
    missing = {f"s_{k}": F.lit(0).cast("bigint") for k in UNREAD[p.history]}
    return wide.withColumns(missing) if missing else wide


def trend_factor(p: Forecast) -> Column:
    """Hundredths: last months against those a year before, weighed; null without any."""
    num, den = F.lit(0.0), F.lit(0.0)
    for i, w in enumerate(p.weights, 1):
        known = F.col(f"s_{i + 12}") > 0
        num = num + F.when(known, F.lit(w) * (F.col(f"s_{i}").cast("double") / F.col(f"s_{i + 12}").cast("double"))).otherwise(0.0)
        den = den + F.when(known, F.lit(w)).otherwise(0.0)
    return F.when(den > 0, F.floor(clamp(num / den, p.low, p.high) * 100 + 0.5))


def recent_growth(step: int, p: Forecast) -> tuple[Column, Column]:
    """The forecast from the last three months alone, and its method."""
    m1, m2, m3 = (F.col(f"s_{k}").cast("double") for k in (1, 2, 3))
    old, new = F.when(m3 > 0, (m2 - m3) / m3).otherwise(0.0), F.when(m2 > 0, (m1 - m2) / m2).otherwise(0.0)
    growth = F.lit(p.old_growth) * old + F.lit(p.new_growth) * new
    value, g = m1, F.least(growth, F.lit(p.most_growth))
    for i in range(step + 1):
        value = value * (F.lit(1.0) + g * F.lit(p.damping**i))
    total = F.col("s_1") + F.col("s_2") + F.col("s_3")
    forecast = F.when(total < p.least_recent, 0.0).when(growth > p.rising, value).otherwise(total / 3)
    method = F.when(total < p.least_recent, "L3_none").when(growth > p.rising, "L3_damped").otherwise("L3_mean")
    return F.floor(forecast), method


def forecast(sales: DataFrame, as_of: dt.date, p: Forecast = Forecast()) -> DataFrame:
    """shop, sku, spu, month, qty, method: for the month of ``as_of`` and those after it.

    In turn: the year before times the trend factor; the year before (never
    reached, as the factor is clamped above 0); recent growth; the year before
    times the mean factor of the style in the shop; 0.  Null factors fall
    through to recent growth even for old products.
    """
    known = series(sales, as_of, p).withColumn("trend", trend_factor(p))
    style = Window.partitionBy("shop", "spu")  # the products of one style in one shop
    known = known.withColumn("style_trend", F.floor(F.avg("trend").over(style) + 0.5))
    steps = []
    for step in range(p.months):
        year_ago = F.col(f"s_{12 - step}")
        recent, how = recent_growth(step, p)
        usable = (year_ago > 0) & F.coalesce(F.col("trend") > 0, F.lit(False))
        flat = (year_ago > 0) & F.coalesce(F.col("trend") == 0, F.lit(False))
        style = (year_ago > 0) & F.coalesce(F.col("style_trend") > 0, F.lit(False))
        times = lambda f: F.floor(year_ago.cast("double") * (f.cast("double") / 100))  # noqa: B023, E731
        qty = F.when(usable, times(F.col("trend"))).when(flat, year_ago).when(recent > 0, recent).when(style, times(F.col("style_trend"))).otherwise(F.lit(0).cast("bigint"))
        method = F.when(usable, "L1_trend").when(flat, "L2_year_ago").when(recent > 0, how).when(style, "L4_style").otherwise("L5_none")
        steps.append(F.struct(F.lit(shifted(as_of, step)).alias("month"), qty.alias("qty"), method.alias("method")))
    return known.select("shop", "sku", "spu", "trend", F.explode(F.array(*steps)).alias("x")).select("shop", "sku", "spu", "x.*", "trend")


def by_style(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("spu", "shop", "month").agg(F.sum("qty").alias("qty"))


def by_product(forecasts: DataFrame) -> DataFrame:
    """sku, spu, shop, month, qty: products with a forecast above 0."""
    return forecasts.where("qty > 0").groupBy("sku", "spu", "shop", "month").agg(F.sum("qty").alias("qty"))


def comparison(forecasts: DataFrame, planned: DataFrame) -> DataFrame:
    """spu, shop, month, system_qty, planned_qty, difference, difference_ratio; rows without either go."""
    system = by_style(forecasts).withColumnRenamed("qty", "system_qty")
    plan = planned.groupBy("spu", "shop", "month").agg(F.sum("qty").alias("planned_qty"))
    both = system.join(plan, ["spu", "shop", "month"], "full_outer").na.fill(0, ["system_qty", "planned_qty"])
    both = both.where("system_qty <> 0 or planned_qty <> 0").withColumn("difference", F.col("planned_qty") - F.col("system_qty"))
    return both.withColumn("difference_ratio", ratio(F.col("difference"), F.col("system_qty")))
