"""Main text of web pages by markup and nearest-URL page differencing.

Pages of a host are sorted by URL path; each page is paired with the neighbour
whose path is nearer.  The text lines (blocks) of the two are aligned by their
longest common subsequence, and shared lines are deleted: what two pages share
is the host's template.  Every page goes through this.  Markup then checks what
differencing says: a shared line inside an article is put back (copies, quoted
passages), and lines in menus, footers, adverts and the like that differ from
page to page are cut.  Where markup says nothing (outside such containers, on
pages whose marked articles hold less than half of the text, or that mark none)
differencing alone decides.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwright.llm.arrow import slices
from loomwright.llm.common import written

#: Nothing here is tried twice, so a page of any kind is read in time by its length.  A quotation
#: mark counts only as the first character of a value, and only if it is closed.
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
TOLD = frozenset("class id role hidden aria-hidden".split())
WHITE = re.compile(r"\s+")
#: Elements whose content isn't text, that have no end tag, that part no words (fixed values of HTML).
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Containers of what isn't main text, by element and by words of class, id or role.
OUTSIDE = frozenset("nav header footer aside form dialog menu button".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar "
    "aside widget related share social cookie cookies consent notice notices alert popup modal newsletter subscribe signup comments comment replies "
    "discussion disqus form login search complementary contentinfo".split()
)
#: Such words on a heading or paragraph tell its looks, and in a class they follow these what a page has.
LAYOUT = frozenset("header footer sidebar aside navigation masthead share related form".split())
HAS = frozenset("has have with without no not is".split())
#: Inside an article a word of a class cuts only if it says nothing but these and the words above: "ad-slot" does, "login-tutorial" doesn't.
PLAIN = frozenset(
    "area bar block blocks body box btn button buttons container content footnote group holder inner item items links list main outer panel post posts row section "
    "site slot top bottom left right thread unit widgets wrap wrapper page pages global primary secondary sticky media overlay dialog".split()
)
#: Beside these, "article" names something about an article.
ABOUT = frozenset("meta card teaser list item preview link tag tags info date author summary nav header footer".split())
MAIN, OTHER, CUT = 2, 1, 0


def region(tag: str, attributes: str, inside: bool = False) -> int | None:
    """What an element (``inside`` an article or not) says of its content: CUT, MAIN, or nothing."""
    if tag in OUTSIDE:
        return CUT
    words: set[str] = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in TOLD:
            continue
        if name == "hidden" or (name == "aria-hidden" and "true" in value.lower()):
            return CUT
        for token in value.strip("\"'").split():
            parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if parts and parts[0] not in HAS and not (inside and set(parts) - WORDS - PLAIN):
                words.update(parts)
    if tag == "p" or re.fullmatch("h[1-6]", tag):
        words -= LAYOUT
    if tag not in ("body", "html", "article", "main") and words & WORDS:
        return CUT
    return MAIN if tag in ("article", "main") or ("article" in words and not words & ABOUT) else None


def blocks(page: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each with MAIN, OTHER or CUT.

    Markup may be broken: a tag without an end takes the rest of the page, a
    quotation mark that isn't closed is a character like others, an end without
    a beginning counts for nothing.  An article inside comments or another cut container stays cut; ``header``
    inside an article is cut as well.  Where a page's articles hold at least
    half of the text that isn't cut, blocks outside them are cut.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    now = OTHER

    def push(tag: str) -> None:
        stack.append((tag, now))
        opened[tag] += 1

    def pop() -> tuple[str, int]:
        opened[stack[-1][0]] -= 1
        return stack.pop()

    def end_block() -> None:
        # Character references are decoded after the markup is gone; a no-break space is white too.
        text = WHITE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append((text, now))

    at = 0
    while m := TOKEN.search(page, at):
        parts.append(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)  # unclosed, it takes the rest
            continue
        if tag in INLINE:
            inner = region(tag, m[3], now == MAIN) if not m[1] and m[3] else None
            if inner is None and not opened[tag]:
                continue
        elif not m[1] and tag == "br":
            parts.append(" ")
            continue
        end_block()
        if m[1]:
            while opened[tag]:  # it ends what was opened in it and left open, too
                ended, now = pop()
                if ended == tag:
                    break
        elif tag not in VOID and not m[3].endswith("/"):
            if tag == "p" and stack and stack[-1][0] == "p":
                now = pop()[1]
            if tag not in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # their ends are often left out
                push(tag)
                said = region(tag, m[3], now == MAIN)
                now = CUT if now == CUT or said == CUT else said or now
            elif region(tag, m[3], now == MAIN) == CUT:
                push(tag)
                now = CUT
    parts.append(page[at:])
    end_block()
    sizes = [sum(len(text) for text, kind in out if kind == k) for k in (OTHER, MAIN)]
    if sizes[1] and sizes[1] >= sizes[0]:
        out = [(text, kind if kind == MAIN else CUT) for text, kind in out]
    return out


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each beginning of ``b`` the length of its longest common subsequence with ``a``.

    A row of the table is one integer with a bit for each line of ``b``, set
    where the length doesn't grow.
    """
    full = (1 << len(b)) - 1
    order = np.argsort(b, kind="stable")
    lines, firsts = np.unique(b[order], return_index=True)
    places = dict(zip(lines.tolist(), np.split(order, firsts[1:]), strict=True))
    often: dict[int, int] = {}  # lines in many places, of which there are few
    row = full
    for line in a.tolist():
        if (some := places.get(line)) is None:
            continue
        if (at := often.get(line)) is None:
            at = 0
            for k in some.tolist():
                at |= 1 << k
            if len(some) > 64:
                often[line] = at
        up = row & at
        row = ((row + up) | (row - up)) & full
    same = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(1 - same.astype(np.int64))]


def shared_lines(a: np.ndarray, b: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
    """Which lines of ``a`` are on a longest common subsequence with ``b`` (arrays of line hashes).

    Common beginnings and ends are cut off first.  A table of more than
    ``cells`` isn't made: ``a`` is halved, the lengths of both halves' tables
    say where ``b`` is to be parted, and each half is settled by itself.
    """
    out = np.zeros(len(a), bool)
    todo = [(np.arange(len(a)), b)]
    while todo:
        places, y = todo.pop()
        x = a[places]
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        head = int(differ[0]) if len(differ) else n
        rest = n - head
        differ = np.flatnonzero(x[::-1][:rest] != y[::-1][:rest])
        tail = int(differ[0]) if len(differ) else rest
        out[places[:head]] = True
        out[places[len(x) - tail :]] = True
        places, y = places[head : len(x) - tail], y[head : len(y) - tail]
        places = places[np.isin(a[places], y)]
        x = a[places]
        y = y[np.isin(y, x)]
        if not len(x):
            continue
        if len(x) == 1:
            out[places] = True
        elif len(x) * len(y) <= cells:
            out[places[_on_path(x, y)]] = True
        else:
            half = len(x) // 2
            part = int((_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]).argmax())
            todo += [(places[:half], y[:part]), (places[half:], y[part:])]
    return out


def _on_path(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The places of ``x`` on a longest common subsequence with ``y``, from the whole table."""
    table = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i in range(len(x) - 1, -1, -1):
        best = table[i + 1].copy()
        best[:-1] = np.maximum(best[:-1], np.where(y == x[i], table[i + 1, 1:] + 1, 0))
        table[i] = np.maximum.accumulate(best[::-1])[::-1]
    i = j = 0
    found = []
    while i < len(x) and j < len(y):
        if x[i] == y[j] and table[i, j] == table[i + 1, j + 1] + 1:
            found.append(i)
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return np.array(found, np.int64)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    """The path without query, fragment, ending slash and page suffix."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.(?:html?|php|aspx?)$", "")


def nearest_pages(pages: DataFrame) -> DataFrame:
    """From (id, url) to (id, partner): the neighbour in the host whose path is nearer (ties: the one before).

    Keys are sorted over all partitions, so a host of any size is spread; only
    the first and last key of each partition are carried over its borders.
    """
    keys = pages.select("id", host_of("url").alias("host"), path_of("url").alias("path")).where((F.col("host") != "") & F.col("id").isNotNull())
    sorted_keys = keys.distinct().orderBy("host", "path", "id").withColumn("part", F.spark_partition_id())
    placed = written(sorted_keys, "page-keys")
    key = F.struct("host", "path", "id")
    inside = Window.partitionBy("part").orderBy("host", "path", "id")
    edges = placed.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    order = Window.orderBy("part")  # one row for each partition
    edges = edges.select("part", F.lag("last").over(order).alias("left_of"), F.lead("first").over(order).alias("right_of"))
    near = placed.select("*", F.lag(key).over(inside).alias("b"), F.lead(key).over(inside).alias("a")).join(F.broadcast(edges), "part")
    near = near.select("id", "host", "path", F.coalesce("b", "left_of").alias("b"), F.coalesce("a", "right_of").alias("a"))
    far = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.levenshtein("path", F.col(f"{c}.path")))
    near = near.select("id", far("b").alias("db"), far("a").alias("da"), F.col("b.id").alias("bid"), F.col("a.id").alias("aid"))
    partner = F.when(F.col("db").isNotNull() & (F.col("da").isNull() | (F.col("db") <= F.col("da"))), F.col("bid")).when(F.col("da").isNotNull(), F.col("aid"))
    return near.groupBy("id").agg(F.min(partner).alias("partner")).where("partner is not null and partner <> id")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: id, url, text, n_cut, n_shared, n_restored.

    ``text`` joins the main blocks by one space ('' if there are none);
    ``n_shared`` counts the blocks that differencing finds shared with the
    partner, ``n_restored`` those of them that markup puts back, ``n_cut``
    the blocks that markup cuts, shared or not.  Null html counts as empty; pages without a host or
    an id have no partner; repeated ids are each extracted, against the
    smallest of their id's lines as partner.  Whole pages are read; other
    columns aren't.  An empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [blocks(page or "") for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("url"),
                        pa.array([[t for t, k in f if k != CUT] for f in found], pa.list_(pa.string())),
                        pa.array([[k for _, k in f] for f in found], pa.list_(pa.int8())),
                        pa.array([[xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in f] for f in found], pa.list_(pa.int64())),
                    ],
                    ["id", "url", "lines", "kinds", "hashes"],
                )

    def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            columns = (batch.column(c).to_pylist() for c in ("lines", "kinds", "hashes", "other"))
            for lines, kinds, hashes, other in zip(*columns, strict=True):
                kinds = np.array(kinds, np.int8)
                shared = shared_lines(np.array(hashes, np.int64), np.array(other or [], np.int64))
                restored = shared & (kinds == MAIN)
                kept = (~shared | restored) & (kinds != CUT)
                texts.append(" ".join(t for t, stays in zip(lines, kept[kinds != CUT].tolist(), strict=True) if stays))
                counts.append([int((kinds == CUT).sum()), int(shared.sum()), int(restored.sum())])
            numbers = (pa.array([c[k] for c in counts], pa.int64()) for k in range(3))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), *numbers], ["id", "url", "text", "n_cut", "n_shared", "n_restored"])

    read = rows.mapInArrow(parsed, f"id {kind}, url string, lines array<string>, kinds array<byte>, hashes array<long>")
    # Pages are parsed again for their text, which then lies on disk once: as it goes to what it is compared with.
    lines = written(read.select("id", "hashes"), "page-lines")
    partners = nearest_pages(rows.select("id", "url")).select("id", "partner")
    # Hashes go to the pages they are compared with, by ids alone; only the pages' own rows carry text.
    other = partners.join(lines.select(F.col("id").alias("partner"), "hashes"), "partner").groupBy("id").agg(F.min("hashes").alias("other"))
    both = read.join(other, "id", "left").select("id", "url", "lines", "kinds", "hashes", "other")
    return both.mapInArrow(differenced, f"id {kind}, url string, text string, n_cut long, n_shared long, n_restored long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
