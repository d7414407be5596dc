"""Fees as rows, files and orders of bounded size; shipment boxes; listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions.nulls import any_nonzero
from loomwright.operators.ranking import chunked, first_wins
from loomwright.operators.reshape import unpivot_named


#: Codes that no product has (fixed values).
INVALID = ("Amazon.Found.B0CJCDHZYN", "Amazon.Found.B0CJCFLXJW", "UNKNOW")


def expanded_fees(records: DataFrame, fees: Mapping[str, str], file_rows: int = 4800, invalid: Sequence[str] = INVALID) -> DataFrame:
    """shop, msku, fee, amount, file: sums of rows with any fee, one row for each that isn't 0, in files of bounded length.

    Rows without a shop or a code, or with an ``invalid`` one, are left out.
    Files are cut over all rows, by shop, code and fee.
    """
    named = (F.coalesce(F.trim("msku"), F.lit("")) != "") & (F.coalesce(F.trim("shop"), F.lit("")) != "") & ~F.trim("msku").isin(*invalid)
    some = records.where(any_nonzero(*(F.col(c) for c in fees)) & named)
    sums = some.groupBy("shop", "msku").agg(*(F.sum(c).alias(c) for c in fees))
    rows = unpivot_named(sums, ["shop", "msku"], fees, "fee", "amount")
    return chunked(rows, [], ["shop", "msku", "fee"], file_rows, "file")


def fee_orders(rows: DataFrame, limit: int = 15) -> DataFrame:
    """shop, order_no, items (struct array of msku, fee, amount), amount: at most ``limit`` codes an order, each with all its fees."""
    fees = rows.groupBy("shop", "msku").agg(F.collect_list(F.struct("msku", "fee", "amount")).alias("fees"), F.sum("amount").alias("amount"))  # a row for each kind of fee
    dealt = chunked(fees, ["shop"], ["msku"], limit, "order_no")
    items = F.array_sort(F.flatten(F.collect_list("fees")))
    return dealt.groupBy("shop", "order_no").agg(items.alias("items"), F.sum("amount").alias("amount"))


def box_contents(rows: DataFrame) -> DataFrame:
    """box, spu, qty, box_qty, main_spu: from (box, spu, qty); the main style has most pieces (ties: the first by name)."""
    held = rows.where("qty > 0").groupBy("box", "spu").agg(F.sum("qty").alias("qty"))
    main = held.groupBy("box").agg(F.min_by("spu", F.struct((-F.col("qty")).alias("q"), "spu")).alias("main_spu"), F.sum("qty").alias("box_qty"))
    return held.join(main, "box")


def deduped_listings(rows: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    """One listing a key: with an owner before without, then undeleted, then the first."""
    return first_wins(rows, keys, [F.col("owner") == "", "deleted", "ordinal", "owner"], take)


def tracked_images(now: DataFrame, before: DataFrame) -> DataFrame:
    """sku, image, previous, changed, changes: the image of now, the one before, and how often it has changed."""
    old = before.select("sku", F.col("image").alias("old_image"), F.col("changes").alias("old_changes"), F.col("previous").alias("old_previous"))
    both = now.select("sku", "image").join(old, "sku", "left")
    differs = F.coalesce((F.trim("image") != "") & (F.trim("old_image") != "") & (F.trim("image") != F.trim("old_image")), F.lit(False))
    count = F.coalesce("old_changes", F.lit(0).cast("bigint"))
    return both.select("sku", "image", F.when(differs, F.col("old_image")).otherwise(F.col("old_previous")).alias("previous"), differs.alias("changed"), (count + differs.cast("bigint")).alias("changes"))
