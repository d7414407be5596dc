"""Toxicity: a learnt lexicon, matched through Levenshtein automata, weighed by context.

The lexicon is learnt from labelled rows: whole words and stems (word beginnings)
that occur in toxic texts and hardly in others.  It is kept as a trie.  For each
distinct word of the corpus the automaton of all strings within a small edit
distance of it is run down the trie, so misspelled terms are found without
listing variants; of a stem, any beginning of the word may be the misspelling.
Words that clean learning texts use as they are don't count as misspellings.
A match counts by its context window: less between an opening and a closing
quotation mark or after a verb of saying, more beside a word that addresses
somebody.  A logistic model turns the sums into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.llm.arrow import as_text, slices
from loomwright.llm.common import Scratch
from loomwright.llm.hyperminhash import mix, shingle_sets, sketches

WORD = re.compile(r"[^\W\d_]+(?:[0-9@$]+[^\W\d_]+)*")
#: Signs inside a word that stand for letters (fixed values).
LEET = str.maketrans("013457@$", "oieastas")
#: A quotation has its opening and its closing mark on one line, however long it is.  A mark
#: with letters on both sides is an apostrophe.
QUOTED = re.compile(r"""["][^"\n]++["]|“[^“”\n]++”|„[^„“”\n]++[“”]|«[^«»\n]++»|»[^«»\n]++«|(?<!\w)‘[^‘\n]+?’(?!\w)""")
#: Verbs of saying and words of address in the corpus' languages.
SAYING = frozenset("said says wrote writes called quote quoted sagte schrieb nannte zitat dit écrit appelé dijo escribió llamó".split())
ADDRESS = frozenset("you your youre du dich dir ihr euch tu toi vous te ti usted ustedes".split())
FEATURES = 5


@dataclass(frozen=True)
class Fit:
    """``sample_rows`` bounds the labelled rows that are learnt from (in expectation; they are chosen by hash).

    A term must be in ``least_docs`` toxic texts and in ``least_share`` of them, so there are at most
    1 / ``least_share`` times as many terms as a toxic text of the sample has words and stems on average.
    """

    sample_rows: int = 20_000
    least_docs: int = 4
    least_share: float = 0.005
    precision: float = 0.9
    stems: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    seed: int = 29


class Filter:
    """Picks words that may be near a term, by hashes of their parts, for many words at once.

    Strings one edit apart have a string in common once a letter may be left
    out of each, so for terms that allow one edit these strings are held.  Of
    the k + 1 parts of a term that allows k edits one stays whole and moves by
    k places at most, so such parts are held with the places where they may be.
    A word is hashed as a sum of its letters by place: leaving a letter out, or
    moving a part, is then a multiplication.  Words longer than any term are
    judged by their beginnings.
    """

    base = np.uint64(0x9E3779B97F4A7C15)
    back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    by_length = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, terms: Iterable[tuple[str, int, bool]]):
        """``terms`` are a string, its edits, and whether it is a stem; a word has about the length of its term, too."""
        #: Strings and the lengths of words that they may be (a stem's: any, as 0), and parts with places and lengths.
        less: set[tuple[str, int]] = set()
        parts: set[tuple[str, int, int]] = set()
        stems: set[str] = set()
        for t, k, stem in terms:
            lengths = [0] if stem else range(len(t) - k, len(t) + k + 1)
            if k == 1:
                left = (t, *(t[:i] + t[i + 1 :] for i in range(len(t))))
                less.update((w, n) for w in left for n in lengths)
                stems.update(left if stem else ())
            elif k:
                cuts = [len(t) * i // (k + 1) for i in range(k + 2)]
                for at, end in zip(cuts, cuts[1:], strict=False):
                    parts.update((t[at:end], at + move, n) for move in range(-k, k + 1) for n in lengths if at + move >= 0)
        self.lengths = sorted({n for w, _ in less for n in (len(w), len(w) + 1)})
        self.stem_lengths = {n for w in stems for n in (len(w), len(w) + 1)}
        self.places = sorted({(at, len(part)) for part, at, _ in parts})
        self.part_stems = {(at, len(part)) for part, at, n in parts if not n}
        self.width = max([1, *self.lengths, *(at + n for at, n in self.places)])
        self.powers = np.array([pow(int(self.base), j, 1 << 64) for j in range(self.width)], np.uint64)
        self.inverse = [np.uint64(pow(int(self.back), j, 1 << 64)) for j in range(self.width)]
        sized = lambda keys, n: keys + np.array([n], np.uint64) * self.by_length
        keys = [sized(self._sums([w])[:, len(w)], n) for w, n in less] + [sized(self._at(self._sums([part])[:, len(part)], at), n) for part, at, n in parts]
        self.keys = np.unique(np.concatenate([*keys, np.zeros(0, np.uint64)]))
        # A first look by 20 bits of a key.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True

    def _sums(self, words: list[str]) -> np.ndarray:
        """The hash of each beginning of each word (rows by length)."""
        letters = np.array(words, f"U{self.width}").view(np.uint32).reshape(len(words), self.width).astype(np.uint64)
        out = np.zeros((len(words), self.width + 1), np.uint64)
        np.cumsum((letters * letters + letters) * self.powers, 1, out=out[:, 1:])
        return out

    def _at(self, part: np.ndarray, at: int) -> np.ndarray:
        return (part + np.uint64(at + 1)) * self.base

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words), bool)
        if not words or not len(self.keys):
            return out
        sums = np.ascontiguousarray(self._sums(words).T)
        size = np.fromiter(map(len, words), np.uint64, len(words)) * self.by_length

        def look(keys: np.ndarray, stem: bool) -> None:
            for some in [keys + size] + [keys] * stem:
                rows = np.flatnonzero(self.seen[some >> np.uint64(44)])
                out[rows[np.isin(some[rows], self.keys)]] = True

        for n in self.lengths:
            stem = n in self.stem_lengths
            look(sums[n], stem)
            for i in range(n):
                look(sums[i] + (sums[n] - sums[i + 1]) * self.back, stem)
        for at, n in self.places:
            look(self._at((sums[at + n] - sums[at]) * self.inverse[at], at), (at, n) in self.part_stems)
        return out


class Trie:
    """Terms as nested dicts; under ``""`` a node has the term that ends there and whether it is a stem."""

    def __init__(self, terms: Iterable[tuple[str, bool]]):
        self.root: dict = {}
        terms = list(terms)
        for term, stem in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = (term, stem)
        self.may_match = Filter((t, self.errors(t), stem) for t, stem in terms)

    @staticmethod
    def errors(term: str) -> int:
        """How many edits a misspelling may have: the shortest terms none, long ones two."""
        return 0 if len(term) < 4 else 1 if len(term) < 9 else 2

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance; exact terms and stems first, ties by term."""
        return self.match_all([word])[0]

    def match_all(self, words: list[str]) -> list[tuple[str, int] | None]:
        out: list[tuple[str, int] | None] = []
        for k in range(0, len(words), 20_000):  # a filter's arrays have a row for each word
            some = words[k : k + 20_000]
            may = self.may_match(some).tolist()
            out += [self._exact(w) or (self._near(w) if near and len(w) >= 4 else None) for w, near in zip(some, may, strict=True)]
        return out

    def _exact(self, word: str) -> tuple[str, int] | None:
        node = self.root
        for i, c in enumerate(word):
            node = node.get(c)
            if node is None:
                break
            if "" in node and (node[""][1] or i == len(word) - 1):
                return node[""][0], 0
        return None

    def _near(self, word: str) -> tuple[str, int] | None:
        """Walk trie and automaton together.

        Bit i of ``states[e]`` says that i letters of the word can be read
        with e edits.  A whole word must be read to its end, a stem takes any
        beginning of a word that is no shorter than the stem.
        """
        places: dict[str, int] = {}
        for i, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << i
        most, last = 2, 1 << len(word)
        full = (last << 1) - 1
        start = [1]
        for _ in range(most):
            start.append((start[-1] << 1 | start[-1]) & full)
        best: tuple[int, str] | None = None
        stack = [(self.root, start)]
        while stack:
            node, states = stack.pop()
            for c, below in node.items():
                if c == "":
                    term, stem = below
                    ends = last if not stem else full if len(word) >= len(term) else 0
                    for e in range(self.errors(term) + 1):
                        if states[e] & ends:
                            best = min(best or (e, term), (e, term))
                            break
                    continue
                at = places.get(c, 0)
                new = [(states[0] & at) << 1]
                for e in range(1, most + 1):
                    new.append((((states[e] & at) << 1) | states[e - 1] | (states[e - 1] << 1) | (new[e - 1] << 1)) & full)
                if new[most]:
                    stack.append((below, new))
        return (best[1], best[0]) if best else None


@dataclass
class Model:
    """What is sent to the executors: bounded by the texts of the sample, as ``Fit`` says."""

    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = -5.0
    #: Words that are near a term and stand in clean learning texts: as many as the learning rows have.
    clean: frozenset[str] = frozenset()

    def matcher(self) -> Matcher:
        return Matcher(self)


def _vocabulary(low: str) -> set[str]:
    """The distinct words; the list of all words of a long text isn't made."""
    return set(WORD.findall(low)) if len(low) < 1 << 20 else {m[0] for m in WORD.finditer(low)}


class Matcher:
    """Lives in a Python worker; remembers the words it has looked up."""

    remembered = 200_000

    def __init__(self, model: Model):
        self.model, self.trie = model, Trie(model.terms)
        self.clean: set[str] = set()
        self.hits: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        """Match the words that aren't remembered."""
        if len(self.clean) + len(self.hits) > self.remembered:
            self.clean.clear()
            self.hits.clear()
        new = [w for w in words - self.clean if w not in self.hits]
        plain = [w.translate(LEET) for w in new]
        for word, term, found in zip(new, plain, self.trie.match_all(plain), strict=True):
            if found and not (found[1] and term in self.model.clean):
                self.hits[word] = found[1]
            else:
                self.clean.add(word)

    def features(self, texts: list[str]) -> np.ndarray:
        """For each text sums of exact and of misspelled matches, their density, whether there are any, and the share of letters beyond ASCII."""
        lows = [t.lower() for t in texts]
        words = [_vocabulary(low) for low in lows]
        self.learn(set().union(*words) if len(words) > 1 else words[0] if words else set())
        out = np.zeros((len(texts), FEATURES))
        for row, low, own in zip(out, lows, words, strict=True):
            if not self.hits.keys().isdisjoint(own):
                row[:4] = self._in_context(low)
            if not low.isascii():
                row[4] = 1 - sum(len(low[k : k + (1 << 20)].encode("ascii", "ignore")) for k in range(0, len(low), 1 << 20)) / len(low)
        return out

    def _in_context(self, low: str, window: int = 6) -> tuple[float, float, float, float]:
        """One walk over words and quotations that holds the words before a place and the hits whose window is open."""
        quotations = QUOTED.finditer(low)
        quoted = next(quotations, None)
        before: deque[str] = deque(maxlen=window)
        waiting: deque[tuple[int, int, float, bool]] = deque()
        exact = near = 0.0
        i = -1

        def count(hit: tuple[int, int, float, bool], addressed: bool) -> None:
            nonlocal exact, near
            _, distance, factor, _ = hit
            factor *= 1.25 if addressed else 1.0
            if distance:
                near += factor / (1 + distance)
            else:
                exact += factor

        for i, m in enumerate(WORD.finditer(low)):
            word = m[0]
            while waiting and waiting[0][0] + window < i:
                hit = waiting.popleft()
                count(hit, hit[3])
            if waiting and word in ADDRESS:
                waiting = deque((at, distance, factor, True) for at, distance, factor, _ in waiting)
            if (distance := self.hits.get(word)) is not None:
                at = m.start()
                while quoted and quoted.end() <= at:
                    quoted = next(quotations, None)
                factor = 1.0
                if quoted and quoted.start() <= at:
                    factor = 0.3
                elif not SAYING.isdisjoint(before):
                    factor = 0.6
                waiting.append((i, distance, factor, not ADDRESS.isdisjoint(before)))
            before.append(word)
        for hit in waiting:
            count(hit, hit[3])
        both = exact + near
        return math.log1p(exact), math.log1p(near), min(1.0, 20 * both / (21 + i)), float(both > 0.5)

    def score(self, text: str) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str]) -> list[float]:
        z = self.model.bias + self.features(texts) @ np.array(self.model.weights)
        return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit: Fit, job: Scratch) -> DataFrame:
    """id, text, toxic of labelled rows outside the held-out part, by hash of the id."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    rate = fit.sample_rows / max(known.count(), 1)
    if rate < 1:
        known = known.where(F.pmod(F.xxhash64("id", F.lit(fit.seed)), F.lit(1_000_000)) < int(rate * 1_000_000))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return job.written(rows.join(F.broadcast(known), "id"), "labelled")  # sample_rows ids and labels


def _once(sample: DataFrame, alike: float = 0.4, job: Scratch | None = None) -> DataFrame:
    """text, toxic of the sample; near copies with the same label count once.

    In two passes, each by another hash of 3-word shingles, rows whose smallest
    hash is the same are compared with the one of them that has the smallest
    id, on 64 registers; only a row that agrees in a share of ``alike`` is taken
    for its copy.
    """
    kind = sample.schema["id"].dataType.simpleString()
    job = job or Scratch(sample.sparkSession)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(as_text(part.column("text")), 3)
                full = sets.sizes > 0
                signs = np.zeros((2, len(sets.sizes)), np.uint64)
                if full.any():
                    signs[0, full] = sets.hashes[sets.starts[full]]
                    signs[1, full] = np.minimum.reduceat(mix(sets.hashes), sets.starts[full])
                registers = sketches(sets)[:, :64].astype(np.int32)
                told = pa.FixedSizeListArray.from_arrays(pa.array(registers.reshape(-1)), 64).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x.view(np.int64)) for x in signs), told], [*part.schema.names, "sign0", "sign1", "told"])

    rows = sample.mapInArrow(signed, f"id {kind}, text string, toxic int, sign0 long, sign1 long, told array<int>")
    rows = job.written(rows.withColumn("bad", F.col("toxic") > 0).withColumn("row", F.struct("id", F.xxhash64("text").alias("h"))), "labelled-signs")
    same = F.aggregate(F.zip_with("told", "other", lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    for sign in ("sign0", "sign1"):
        first = rows.groupBy(sign, "bad").agg(F.min("row").alias("one"), F.min_by("told", "row").alias("other"))
        rows = rows.join(first, [sign, "bad"]).where((F.col("row") == F.col("one")) | (same < alike * 64)).drop("one", "other")
    return job.written(rows.dropDuplicates(["id", "text"]).select("text", "toxic"), "labelled-once")


def _terms(once: DataFrame, fit: Fit) -> list[tuple[str, bool]]:
    """Words and stems of toxic texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()

        def out() -> pa.RecordBatch:
            terms = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array([t[0] for t in terms], pa.string()), pa.array([t[1] for t in terms], pa.bool_()), *(pa.array([c[t] for t in terms], pa.int64()) for c in seen)]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "stem", "n0", "n1"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                terms = {(w, False) for w in words if len(w) > 2}
                terms.update((w[:n], True) for w in words for n in fit.stems if len(w) > n)
                seen[int(toxic > 0)].update(terms)
                if len(seen[0]) + len(seen[1]) > 100_000:
                    yield out()
        yield out()

    counts = once.mapInArrow(counted, "term string, stem boolean, n0 long, n1 long").groupBy("term", "stem").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    least = max(fit.least_docs, math.ceil(fit.least_share * once.where("toxic > 0").count()))
    good = counts.where((F.col("n1") >= least) & (F.col("n1") >= fit.precision * (F.col("n0") + F.col("n1"))))
    rows = good.collect()  # bounded by the sample, as Fit says
    words = {r["term"]: r["n1"] for r in rows if not r["stem"]}
    stems = {r["term"]: r["n1"] for r in rows if r["stem"]}
    # A stem must reach well beyond any one word; of nested stems the longest that loses little.
    own = Counter()
    for w, n in words.items():
        for k in fit.stems:
            own[w[:k]] = max(own[w[:k]], n)
    stems = {s: n for s, n in stems.items() if own[s] < 0.6 * n and n >= 3 * least}
    beginnings = lambda w, of: [w[:k] for k in fit.stems if k < len(w) and w[:k] in of]
    longer = {s for t, m in stems.items() for s in beginnings(t, stems) if m >= 0.9 * stems[s]}
    stems = {s: n for s, n in stems.items() if s not in longer}
    kept = {s for s in stems if not beginnings(s, stems)}
    return sorted([(w, False) for w in words if w not in kept and not beginnings(w, kept)] + [(s, True) for s in kept])


def _clean(once: DataFrame, terms: list[tuple[str, bool]], fit: Fit) -> frozenset[str]:
    """Words near a term that stand in clean texts more often than ``precision`` allows, in two at least.

    What only one clean text has may be a slip; these are left for the
    logistic model to weigh.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(terms), {}
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [{w.translate(LEET) for w in WORD.findall(t.lower())} for t in part.column("text").to_pylist()]
                new = list(set().union(*texts) - known.keys())
                known.update((w, found is not None and found[1] > 0) for w, found in zip(new, trie.match_all(new), strict=True))
                for words, toxic in zip(texts, part.column("toxic").to_pylist(), strict=True):
                    seen[int(toxic > 0)].update(w for w in words if known[w])
                if len(known) > Matcher.remembered:
                    known.clear()
        words = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in seen)], ["word", "n0", "n1"])

    counts = once.mapInArrow(counted, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return frozenset(r["word"] for r in counts.where((F.col("n0") > 1) & (F.col("n1") < fit.precision * (F.col("n0") + F.col("n1")))).collect())  # words of sample_rows rows


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[list[float], float]:
    """Newton's method with a ridge penalty on all but the bias."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w[:-1]], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit: Fit = Fit()) -> Model:
    """Learn from the labelled rows that aren't held out; without toxic ones every score is near 0.

    Null ids and labels are left out; of several labels of an id the largest
    counts.  The learning reads no other column.
    """
    job = Scratch(docs.sparkSession)
    sample = _sample(docs, labels, id_col, text_col, fit, job)
    if sample.where("toxic > 0").isEmpty():
        job.clear()
        return Model()
    once = _once(sample, job=job)
    model = Model(_terms(once, fit))
    model.clean = _clean(once, model.terms, fit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = matcher.features(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("toxic"), *(pa.array(rows[:, k]) for k in range(FEATURES))], names)

    names = ["id", "toxic", *(f"x{k}" for k in range(FEATURES))]
    kind = sample.schema["id"].dataType.simpleString()
    seen = sample.mapInArrow(work, f"id {kind}, toxic int, " + ", ".join(f"x{k} double" for k in range(FEATURES))).orderBy("id", *names[2:]).toPandas()  # sample_rows rows
    model.weights, model.bias = _logistic(seen[names[2:]].to_numpy(), (seen["toxic"] > 0).to_numpy().astype(float))
    job.clear()
    return model


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score (0 to 1), predicted (score >= 0.5).

    Whole texts are scored; null text counts as empty and has a score too.
    Repeated rows are scored each; a null id isn't held out.  Other columns
    aren't read.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            for part in slices(batch, "text"):
                scores = matcher.scores(as_text(part.column("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    scored = rows.mapInArrow(work, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, whole and unchanged, without an exchange."""
    text_at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            for part in slices(batch, text_at):
                scores = matcher.scores(as_text(part.column(text_at)).to_pylist())
                yield part.filter(pa.array([x < 0.5 for x in scores], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
