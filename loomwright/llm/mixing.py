"""Mixing sources to target weights through a domain-language-source tree.

Budgets flow down the tree.  At every node a level is filled like water: a
child takes its weighted share of the node's budget, or all it can supply when
that is less, and what it leaves goes to its siblings.  A node's supply is the
sum of its leaves' supplies, so a shortage leaves a subtree only when all the
siblings inside it are exhausted.  All arithmetic is on integers.

Within a leaf documents are ordered by a seeded hash for each epoch.  A leaf
repeats its whole epochs and then takes the prefix of the next one that fits
into its remaining tokens.  Prefix sums are taken in two levels (hash buckets
of a leaf, then rows of a bucket), so no leaf is ever in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.common import WORD, text_of, written

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Target weights and limits.

    ``weights`` has a table for each level; a label it doesn't list has
    ``other``.  ``share`` is the budget as (numerator, denominator) of all
    tokens, ``max_epochs`` how often a document may be used.
    """

    weights: Mapping[str, Mapping[str, int]] = field(
        default_factory=lambda: {
            "domain": {"books": 4, "web": 3, "code": 2, "talk": 1},
            "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
            "source": {},
        }
    )
    other: int = 1
    share: tuple[int, int] = (1, 1)
    max_epochs: int = 3
    seed: int = 17


def domain_of(source: Column) -> Column:
    """The domain of a source, by the first hex digit of its md5."""
    digit = F.substring(F.md5(source), 1, 1)
    return F.when(digit < "4", "web").when(digit < "8", "books").when(digit < "c", "code").otherwise("talk")


def _weight(level: str, mix: Mix) -> Column:
    found = F.lit(mix.other)
    for label, weight in mix.weights.get(level, {}).items():
        found = F.when(F.col(level) == label, F.lit(weight)).otherwise(found)
    return found.cast("decimal(38,0)")


def fill(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Split ``budget`` (of the parent, on every row) over children by ``weight`` up to ``supply``.

    Adds ``granted``.  The sum of the grants is the budget, or the supply where
    that is less.  Children are taken by rising supply for a unit of weight: as
    long as one can't use its share of what is left, it is granted all it has;
    the rest share by weight, rounded so that nothing is lost.
    """
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col("supply").cast("double") / F.col("weight").cast("double"), F.col(child))
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("decimal(38,0)")
    big = lambda c: c.cast("decimal(38,0)")
    left = F.col("budget") - F.coalesce(F.sum("supply").over(before), zero)
    weight_left = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), zero)
    out = children.withColumn("full", big(F.col("supply")) * big(weight_left) <= big(F.col("weight")) * big(left))
    rest = big(F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(group), zero))
    open_weight = big(F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), zero))
    open_upto = big(F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(upto), zero))
    out = out.withColumns({"rest": rest, "open_weight": open_weight, "open_upto": open_upto})
    share = F.expr(
        "cast((rest * open_upto) div nullif(open_weight, 0) as decimal(38,0)) - cast((rest * (open_upto - weight)) div nullif(open_weight, 0) as decimal(38,0))"
    )
    return out.withColumn("granted", F.when(F.col("full"), F.col("supply")).otherwise(share).cast("decimal(38,0)")).drop("full", "rest", "open_weight", "open_upto")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """From (domain, lang, source, tokens) to each leaf's ``granted`` tokens."""
    leaves = leaves.withColumn("tokens", F.col("tokens").cast("decimal(38,0)")).withColumn("supply", F.col("tokens") * mix.max_epochs).withColumn("supply", F.col("supply").cast("decimal(38,0)"))
    num, den = mix.share
    total = leaves.agg(
        F.least(F.expr(f"cast((coalesce(sum(tokens), 0) * {num}) div {den} as decimal(38,0))"), F.coalesce(F.sum("supply"), F.lit(0)).cast("decimal(38,0)")).alias("budget")
    )
    budget = None
    for depth, level in enumerate(LEVELS):
        keys, parents = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = leaves.groupBy(*keys).agg(F.sum("supply").cast("decimal(38,0)").alias("supply"), F.sum("tokens").cast("decimal(38,0)").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(level, mix))
        nodes = nodes.crossJoin(F.broadcast(total)) if budget is None else nodes.join(budget, parents)  # total is one row
        budget = fill(nodes, parents, level).select(*keys, "tokens", "granted")
        if depth < len(LEVELS) - 1:
            budget = budget.drop("tokens").withColumnRenamed("granted", "budget")
    return budget


def mix_sources(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", domain: Callable[[Column], Column] = domain_of) -> DataFrame:
    """One row for each row of ``docs``: id, domain, lang, source, n_tokens, copies.

    ``copies`` is how often the mixture uses the document (0: not at all);
    ``domain`` gives a source's domain.
    Tokens are runs of characters that aren't white space.  Null text counts as
    empty, null language or source as the label ``none``.  Documents without
    tokens are used once for every epoch or prefix that reaches them.  Repeated
    rows are separate documents; ties in the seeded order go by id.  An empty
    table gives an empty result.
    """
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    rows = docs.select(
        F.col(id_col).alias("id"), label("lang").alias("lang"), label("source").alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("n_tokens")
    ).withColumn("domain", domain(F.col("source")))
    rows = written(rows, "mixing-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, mix).select(
        *LEVELS,
        F.expr("cast(if(tokens = 0, 0, granted div tokens) as long)").alias("epochs"),
        F.expr("cast(if(tokens = 0, 0, granted % tokens) as long)").alias("rest"),
    )
    place = F.md5(F.concat_ws(":", F.lit(mix.seed).cast("string"), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    placed = rows.join(plan, list(LEVELS)).withColumn("place", place).withColumn("bucket", F.substring("place", 1, 3))
    leaf_bucket = Window.partitionBy(*LEVELS, "bucket")
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("s"))
    start = F.coalesce(F.sum("s").over(Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*LEVELS, "bucket", start.alias("start"))
    upto = F.sum("n_tokens").over(leaf_bucket.orderBy("place", "id").rowsBetween(Window.unboundedPreceding, 0))
    ended = placed.join(starts, [*LEVELS, "bucket"]).withColumn("upto", F.col("start") + upto)
    return ended.select(
        F.col("id").alias(id_col), *LEVELS, "n_tokens", F.least(F.col("epochs") + (F.col("upto") <= F.col("rest")).cast("long"), F.lit(mix.max_epochs)).alias("copies")
    )


def apply_mix(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as the mixture uses them, with their columns; rows of one id go by its largest number."""
    used = mix_sources(docs, mix, id_col, text_col).where("copies > 0").groupBy(F.col(id_col).alias("used__")).agg(F.max("copies").cast("int").alias("copies__"))
    joined = docs.join(used, docs[id_col].eqNullSafe(used["used__"]))
    return joined.withColumn("copies__", F.explode(F.sequence(F.lit(1), F.col("copies__")))).select(docs.columns)
