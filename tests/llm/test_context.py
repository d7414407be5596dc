"""Context windows of matches, and the learning of terms, against plain models."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest

from loomwright.llm.toxicity import ADDRESS, LEET, QUOTED, SAYING, WORD, Fit, Model, Trie, _clean, _terms

MODEL = Model([("scoundrel", False), ("nitwit", True)], [1.0, 1.0, 1.0, 1.0, 1.0])


def plain_features(low, hits, window=6):
    words = [(m[0], m.start()) for m in WORD.finditer(low)]
    quoted = [m.span() for m in QUOTED.finditer(low)]
    sums = [0.0, 0.0]
    for i, (word, at) in enumerate(words):
        if word not in hits:
            continue
        before, after = ({w for w, _ in words[a:b]} for a, b in ((max(0, i - window), i), (i + 1, i + 1 + window)))
        factor = 0.3 if any(a <= at < b for a, b in quoted) else 0.6 if before & SAYING else 1.0
        factor *= 1.25 if (before | after) & ADDRESS else 1.0
        sums[hits[word] > 0] += factor / (1 + hits[word])
    both = sum(sums)
    return math.log1p(sums[0]), math.log1p(sums[1]), min(1.0, 20 * both / (20 + len(words))), float(both > 0.5)


def test_windows_against_a_plain_model():
    random.seed(3)
    pool = ["scoundrel", "scoundrl", "nitwits", "nitwt", "you", "said", "du", "dit", *"abcdefgh", '"', "\n", "“", "”", "„", "«", "»", "‘", "’", "don’t", "."]
    for n in [0, 1, 2, *(random.randrange(3, 120) for _ in range(400))]:
        text = " ".join(random.choices(pool, k=n))
        matcher = MODEL.matcher()
        got = matcher.features([text])[0]
        want = plain_features(text, matcher.hits) if matcher.hits else (0, 0, 0, 0)
        assert got[:4] == pytest.approx(want, abs=1e-12), text
        assert got[4] == pytest.approx(sum(c > "\x7f" for c in text) / max(len(text), 1))


@pytest.mark.parametrize("filler", [1, 50, 400, 20_000])
@pytest.mark.parametrize("marks", ['""', "“”", "„“", "«»", "»«", "‘’"])
def test_a_quotation_of_any_length_counts_as_one(filler, marks):
    text = f"x {marks[0]}a scoundrel {'w ' * filler}{marks[1]} y"
    assert MODEL.matcher().features([text])[0][0] == pytest.approx(math.log1p(0.3))
    assert MODEL.matcher().features([text.replace(" scoundrel", " scoundrel\n")])[0][0] == pytest.approx(math.log1p(1.0))


def test_words_of_a_text_beyond_a_megabyte():
    long = "scoundrel " + "word " * 300_000 + "you nitwit"
    matcher = MODEL.matcher()
    assert matcher.features([long])[0][:4] == pytest.approx(plain_features(long, {"scoundrel": 0, "nitwit": 0}))


def labelled_texts():
    random.seed(11)
    clean = ["".join(random.choices("abcde", k=random.randint(2, 6))) for _ in range(120)]
    bad = ["scoundrel", "scoundrels", "nitwit", "nitwits", "nitwitted", "blockhead", "knave", "kn4ve"]
    for k in range(300):
        words = random.choices(clean, k=12)
        if k % 3 == 0:
            words += random.sample(bad, 2)
        elif k % 10 == 1:
            words += ["knaves" if k % 20 == 1 else "nitwat"]
        yield " ".join(words), int(k % 3 == 0)


def plain_terms(rows, fit):
    docs: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0])
    for text, toxic in rows:
        words = set(re.findall(WORD, text.lower()))
        for t in {(w, False) for w in words if len(w) > 2} | {(w[:n], True) for w in words for n in fit.stems if len(w) > n}:
            docs[t][toxic] += 1
    least = max(fit.least_docs, math.ceil(fit.least_share * sum(t for _, t in rows)))
    good = {t: n1 for t, (n0, n1) in docs.items() if n1 >= least and n1 >= fit.precision * (n0 + n1)}
    words = {t: n for (t, stem), n in good.items() if not stem}
    stems = {t: n for (t, stem), n in good.items() if stem and n >= 3 * least}
    stems = {s: n for s, n in stems.items() if max((m for w, m in words.items() if w.startswith(s)), default=0) < 0.6 * n}
    stems = {s: n for s, n in stems.items() if not any(t != s and t.startswith(s) and m >= 0.9 * n for t, m in stems.items())}
    kept = [s for s in stems if not any(t != s and s.startswith(t) for t in stems)]
    return sorted([(w, False) for w in words if not any(w.startswith(s) for s in kept)] + [(s, True) for s in kept])


def test_terms_and_clean_words_against_plain_models(spark):
    rows, fit = list(labelled_texts()), Fit()
    frame = spark.createDataFrame(rows, "text string, toxic int").repartition(5)
    terms = _terms(frame, fit)
    assert terms == plain_terms(rows, fit) and any(stem for _, stem in terms) and ("blockhead", False) in terms
    docs: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for text, toxic in rows:
        for w in {w.translate(LEET) for w in re.findall(WORD, text)}:
            docs[w][toxic] += 1
    near = {w for w, found in zip(docs, Trie(terms).match_all(list(docs)), strict=True) if found and found[1] > 0}
    assert _clean(frame, terms, fit) == {w for w in near if docs[w][0] > 1 and docs[w][1] < fit.precision * sum(docs[w])}


def test_more_words_than_a_filter_takes_at_once():
    words = [f"nitwt{k:05d}" for k in range(45_000)] + ["scoundrl", "other"]
    found = Trie(MODEL.terms).match_all(words)
    assert len(found) == len(words) and found[-2:] == [("scoundrel", 1), None] and found[0] == found[44_999] == ("nitwit", 1)
