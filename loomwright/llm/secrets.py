"""Secret scans with DataFrame functions only.

Three base patterns (assignments, access keys, long hex runs) are joined by an
entropy scan: over every candidate string a window slides, the counts of its
characters are kept up to date by the character that enters and the one that
leaves, and the Shannon entropy follows from a running sum of c*log2(c).  Each
character class has its own threshold.  An allow-list suppresses candidates
that are known not to be secrets.  Sums are integers (millionths), so results
don't depend on the order of additions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.llm.common import text_of

#: The base patterns, in the order that sorts equal starts.  `[0-9a-f]{24,}` finds the
#: runs of 24 and more that `[0-9a-f]+` has, and likewise for access keys.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20


@dataclass(frozen=True)
class Entropy:
    """A character class: what its candidates look like, and the bits a window must reach."""

    kind: str
    pattern: str
    bits: float


#: A candidate belongs to the first class that fits it whole.
CLASSES = (
    Entropy("entropy_hex", r"^[0-9A-Fa-f]+$", 3.2),
    Entropy("entropy_alnum", r"^[A-Za-z0-9]+$", 3.8),
    Entropy("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
)
#: Candidates that match are no secrets: no digit at all, nothing but digits and
#: signs, uuids, paths of words, and placeholders.
PATH = r"^/?([A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}/?$"
ALLOW = (
    r"^[^0-9]*$",
    r"^[0-9+/_=-]*$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    PATH,
    r"EXAMPLE|example|SAMPLE|sample|0123456789|abcdefghij",
)


def weight(count: int) -> int:
    """count * log2(count) in millionths."""
    return round(1e6 * count * math.log2(count)) if count else 0


def most(bits: float, window: int = WINDOW) -> int:
    """The largest sum of weights with which a window still has ``bits``."""
    return math.floor(1e6 * window * (math.log2(window) - bits))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it, also inside other functions' bodies."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_chunks(array: Column, chunk: int = 64) -> Column:
    """An array that isn't empty, as arrays of ``chunk``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / chunk).cast("int")), lambda k: F.slice(array, k * chunk + 1, chunk))


def running(values: Column, start: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What stands before each value: ``start``, then ``step`` of what stood before and the value."""
    first = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(values, first, lambda acc, v: F.struct(step(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]


def found(text: Column, matches: Column, pattern: str) -> Column:
    """[(start, end, match)] in code points, from the matches and what lies between them.

    Matches are walked in chunks, whose starts come from the sums of the chunks
    before, so the work of a step doesn't grow with a text's matches.
    """
    between = F.split(text, pattern, -1)
    steps = F.zip_with(matches, F.slice(between, 1, F.size(matches)), lambda m, p: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("match")))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def walked(steps: Column, start: Column) -> Column:
        return F.aggregate(
            steps,
            F.struct(start.alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"), x["match"].alias("match"))),
                ).alias("out"),
            ),
        )["out"]

    def spans(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        return F.flatten(F.zip_with(chunks, running(sums, F.lit(0), lambda at, n: at + n, "int"), walked))

    return F.when(F.size(matches) > 0, let(steps, lambda all_: let(in_chunks(all_), spans))).otherwise(empty)


def unhindered(base: Column, candidates: Column) -> Column:
    """The candidates that overlap no base span; both are walked once, in order.

    A candidate is met after the base spans that begin before its end; it is
    free if none of these ends behind its start.
    """
    kind = "array<struct<key:int,is_base:int,start:int,end:int,match:string>>"
    of_base = F.transform(base, lambda b: F.struct(b["start"].alias("key"), F.lit(1).alias("is_base"), b["start"].alias("start"), b["end"].alias("end"), F.lit(None).cast("string").alias("match")))
    others = F.transform(candidates, lambda c: F.struct(c["end"].alias("key"), F.lit(0).alias("is_base"), c["start"].alias("start"), c["end"].alias("end"), c["match"].alias("match")))
    end = lambda x: F.when(x["is_base"] == 1, x["end"]).otherwise(0)

    def walked(met: Column, top: Column) -> Column:
        return F.aggregate(
            met,
            F.struct(top.alias("top"), F.array().cast(kind).alias("out")),
            lambda acc, x: F.struct(
                F.greatest(acc["top"], end(x)).alias("top"),
                F.when((x["is_base"] == 0) & (acc["top"] <= x["start"]), F.concat(acc["out"], F.array(x))).otherwise(acc["out"]).alias("out"),
            ),
        )["out"]

    def free(chunks: Column) -> Column:
        tops = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda top, x: F.greatest(top, end(x))))
        return F.flatten(F.zip_with(chunks, running(tops, F.lit(0), lambda top, n: F.greatest(top, n), "int"), walked))

    met = F.array_sort(F.concat(of_base, others).cast(kind))
    kept = F.when(F.size(candidates) > 0, let(met, lambda all_: let(in_chunks(all_), free))).otherwise(F.array().cast(kind))
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match")))


def is_path(m: Column) -> Column:
    """Whether ``PATH`` fits, without repeating a group, which takes a frame of Java's stack each time.

    It begins with a letter (after a slash), holds digits at its end only, has a
    sign after a letter, and no two signs together but for a slash at the end.
    """
    fits = lambda p: F.rlike(m, F.lit(p))
    return fits("^/?[A-Za-z]") & fits("^[A-Za-z/_-]+[0-9]{0,4}/?$") & fits("[A-Za-z][/_-]") & ~fits("[/_-]([_-]|/.)")


def hot_part(candidate: Column, limit: Column, window: int = WINDOW) -> Column:
    """struct(first, last) of the windows in ``candidate`` whose sum of weights is at most ``limit``.

    ``last`` is 0 if there is none.  Characters come from one array of codes,
    each with that of the one that leaves the window.  The state holds a count
    for each character from ``+`` to ``z`` and the sum of their weights.
    """
    low, high = ord("+"), ord("z")
    weights = F.array(*[F.lit(weight(c)) for c in range(window + 1)])

    def pairs(codes: Column) -> Column:
        leaving = F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), F.lit(1), F.size(codes))
        return F.zip_with(codes, leaving, lambda a, b: F.struct(a.alias("into"), b.alias("out")))

    def step(acc: Column, x: Column) -> Column:
        into, out, at = x["into"], x["out"], acc["at"] + 1
        count = lambda c: F.coalesce(F.get(acc["counts"], c), F.lit(0))
        same = into == out
        total = (
            acc["sum"]
            + F.when(same, 0).otherwise(F.get(weights, count(into) + 1) - F.get(weights, count(into)))
            + F.when(same | (out < 0), 0).otherwise(F.get(weights, count(out) - 1) - F.get(weights, count(out)))
        )
        counts = F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, k: c + (k == into).cast("int") - (k == out).cast("int")))
        hot = (at >= window) & (total <= limit)
        return F.struct(
            at.alias("at"),
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & (acc["last"] == 0), at - window).otherwise(acc["first"]).alias("first"),
            F.when(hot, at).otherwise(acc["last"]).alias("last"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0), high - low + 1).alias("counts"), F.lit(0).alias("sum"), F.lit(0).alias("first"), F.lit(0).alias("last"))
    codes = F.transform(F.regexp_extract_all(candidate, F.lit("."), F.lit(0)), lambda c: F.ascii(c) - low)
    return F.aggregate(let(codes, pairs), start, step, lambda acc: F.struct(acc["first"], acc["last"]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, base, entropy.

    Both are arrays of (start, rank, end, kind), sorted; positions are code
    points, ends exclusive; ``rank`` is the kind's place in the order of kinds.
    Entropy spans reach from the first to the last window of a candidate that
    passes its class's threshold, and are left out where they overlap a base
    span.  Null text counts as empty, which has no spans.  Texts are scanned
    whole; repeated rows are scanned each; other columns aren't read.  An empty
    table gives an empty result.
    """
    kinds = [*BASE, *(c.kind for c in CLASSES)]
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select(
        "id",
        "text",
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)).alias("m_assign"),
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)).alias("values"),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)).alias("m_access"),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)).alias("m_hex"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("m_candidate"),
    )

    def spans(kind: str, array: Column) -> Column:
        return F.transform(array, lambda s: F.struct(s["start"].alias("start"), F.lit(kinds.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    assign = F.zip_with(found(F.col("text"), F.col("m_assign"), ASSIGN), "values", lambda s, v: F.when(F.length(v) >= 6, s))
    base = F.array_sort(
        F.concat(
            spans("assign", F.filter(assign, lambda s: s.isNotNull())),
            spans("access", found(F.col("text"), F.col("m_access"), ACCESS)),
            spans("hex", found(F.col("text"), F.col("m_hex"), HEX)),
        )
    )
    rows = rows.select("id", base.alias("base"), found(F.col("text"), F.col("m_candidate"), CANDIDATE).alias("candidates"))

    others = F.lit("|".join(f"(?:{p})" for p in ALLOW if p != PATH))
    allowed = lambda m: F.rlike(m, others) | is_path(m)
    rows = rows.select("id", "base", F.filter("candidates", lambda s: ~allowed(s["match"])).alias("candidates"))
    rows = rows.select("id", "base", unhindered(F.col("base"), F.col("candidates")).alias("candidates"))

    def scored(s: Column) -> Column:
        rank, limit = F.lit(kinds.index(CLASSES[-1].kind)), F.lit(most(CLASSES[-1].bits))
        for c in reversed(CLASSES[:-1]):
            fits = F.rlike(s["match"], F.lit(c.pattern))
            rank, limit = F.when(fits, kinds.index(c.kind)).otherwise(rank), F.when(fits, most(c.bits)).otherwise(limit)
        return F.struct(s["start"].alias("start"), rank.alias("rank"), hot_part(s["match"], limit).alias("hot"))

    hot = F.filter(F.transform("candidates", scored), lambda s: s["hot"]["last"] > 0)
    names = F.array(*[F.lit(k) for k in kinds])
    entropy = F.transform(
        hot,
        lambda s: F.struct((s["start"] + s["hot"]["first"]).alias("start"), s["rank"].alias("rank"), (s["start"] + s["hot"]["last"]).alias("end"), F.get(names, s["rank"]).alias("kind")),
    )
    return rows.select(F.col("id").alias(id_col), "base", F.array_sort(entropy).alias("entropy"))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
