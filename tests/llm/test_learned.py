"""Toxicity, page text, and the pipeline."""

from __future__ import annotations

import html
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import sentencepiece
import public_tokenizers

import corpus_pipeline
from loomwright.llm.html_text import blocks, main_text, nearest_pages, shared_lines
from loomwright.llm.toxicity import ADDRESS, SAYING, Matcher, Model, Trie, drop_toxic, fit_toxicity, score_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    random.seed(9)
    terms = ["idiot", "worthless", "disgusting", "scum", "trash"]
    trie = Trie([(t, False) for t in terms] + [("lowei", True)])
    words = ["idiot", "idiott", "idoit", "worthles", "wrthlss", "disgustin", "scun", "trsah", "lowei", "loweixyz", "lowe", "idio", "thrash"]
    for t in terms:
        for _ in range(300):
            w = list(t)
            for _ in range(random.randrange(4)):
                k = random.randrange(len(w) + 1)
                w[k : k + random.randrange(2)] = random.choice(["", "a", "s", "t"])
            words.append("".join(w))
    for w in words:
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= Trie.errors(t)]
        want = ("lowei", 0) if w.startswith("lowei") else (min(near)[1], min(near)[0]) if near else None
        if len(w) >= 4:
            assert trie.match(w) == want, w


def test_misspelt_beginnings_are_found():
    random.seed(10)
    stems = ["réeux", "lowe", "achliche"]
    trie = Trie([(t, True) for t in stems] + [("scum", False)])
    words = ["réeaxment", "reeuxment", "réuxment", "scun", "rée", "lowx", "achlxiche", "achlixhe"]
    for t in stems:
        for _ in range(300):
            w = list(t + random.choice(["", "e", "ment", "lowe"]))
            for _ in range(random.randrange(4)):
                k = random.randrange(len(w) + 1)
                w[k : k + random.randrange(2)] = random.choice(["", "a", "é", "e"])
            words.append("".join(w))
    for w in words:
        if len(w) >= 4:
            near = [(min(distance(w[:n], t) for n in range(len(w) + 1)), t) for t in stems if len(w) >= len(t)] + [(distance(w, "scum"), "scum")]
            near = [(e, t) for e, t in near if e <= Trie.errors(t)]
            found = trie.match(w)
            assert found == (min(near)[1], min(near)[0]) if near else found is None, w
    assert trie.match("scun") == ("scum", 1) and trie.match("reeuxment") == ("réeux", 1)


def test_misspellings_are_checked_on_the_learning_rows(spark, docs):
    """Misspelt words of a family count; a word of clean texts beside a term doesn't."""
    random.seed(2)
    rows, labels = [], []
    for k in range(600):
        words = ["".join(random.choice("bdfgkmp") for _ in range(7)) for _ in range(30)]
        words += ["slum", "slum"] if k % 3 else []
        if toxic := k % 6 == 0:
            words += ["scum"] + ["vorrex" + random.choice("bdfgkmpt") + random.choice("aeiou") for _ in range(3)]
            random.shuffle(words)
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, 1, int(toxic)))
    model = fit_toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert ("vorrex", True) in model.terms and model.clean == {"slum"}
    matcher = model.matcher()
    assert matcher.trie.match("worrexta") == ("vorrex", 1)
    clean = matcher.score("bdf dfg bfd mpg")
    assert matcher.score("bdf slum dfg slum") == clean
    assert matcher.score("bdf vorrxexti worrexta vorexda dfg") > 10 * clean and matcher.score("bdf scun scun scun dfg") > 10 * clean


def test_context_separates_quotation():
    matcher = Matcher(Model([("idiot", False)], [1, 1, 1, 0, 0], -1.0))
    plain, quoted, said, address = (matcher.score(t) for t in ("he is an idiot today", 'it has "an idiot here" in it', "she said that an idiot came", "you are an idiot today"))
    assert quoted < said < plain < address
    assert matcher.score("he is an id1ot today") == plain and matcher.score("") < 0.5


def test_apostrophes_are_no_quotation():
    matcher = Matcher(Model([("idiot", False)], [1, 1, 1, 0, 0], -1.0))
    plain = matcher.score("c'est l'idiot d'ici")
    assert matcher.score("c’est l’idiot d’ici") == plain
    assert matcher.score('the "good" idiot "bad"') == matcher.score("the good idiot bad")
    for quoted in ('a "so idiot it" b', "a “so idiot it” b", "a „so idiot it“ b", "a «so idiot it» b", "a ‘so idiot it’ b"):
        assert matcher.score(quoted) < matcher.score("a so idiot it b"), quoted
    assert matcher.score('a "so\nidiot it" b') == matcher.score("a so idiot it b") == matcher.score('a "so idiot it b')


def test_near_copies_are_told_by_more_than_one_hash(spark):
    """Texts that share their smallest hash and little else are all learnt from; copies are once for a label."""
    from loomwright.llm.toxicity import _once

    random.seed(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(base[: 40 * (k + 1)] + [f"x{k}y{i}" for i in range(200)]), 0) for k in range(4)]
    rows += [(10 + k, " ".join(base + ["z", str(k)]), 0) for k in range(5)] + [(20, " ".join(base + ["z", "0"]), 1), (21, "", 0), (22, "", 0)]
    kept = _once(spark.createDataFrame(rows, "id long, text string, toxic int")).collect()
    assert {r["text"] for r in kept} >= {t for k, t, _ in rows if k < 4}
    assert sum("z" in r["text"].split() for r in kept) == 2 and sum(not r["text"] for r in kept) == 1


def test_terms_are_counted_when_the_last_row_fills_the_counters(spark):
    """A task whose last text empties the counters ends with an empty batch of the same schema."""
    from loomwright.llm.toxicity import Fit, _terms

    full = " ".join("".join(chr(97 + (i // 26**j) % 26) for j in range(9)) for i in range(17_000))
    rows = spark.createDataFrame([("a foul word", 1), ("a good one", 0), (f"foul {full}", 1)], "text string, toxic int").coalesce(1)
    assert ("foul", False) in _terms(rows, Fit(least_docs=2))


def plain_score(text, model):
    """The score from edit distances to every term, without trie, automaton, filter or memory."""
    low = text.lower()
    found = list(re.finditer(r"[^\W\d_]+(?:[0-9@$]+[^\W\d_]+)*", low))
    words = [m[0] for m in found]

    def matched(word):
        word = word.translate(str.maketrans("013457@$", "oieastas"))
        exact = [t for t, stem in model.terms if word == t or (stem and word.startswith(t))]
        if exact:
            return 0
        near = [99]
        for t, stem in model.terms:
            if len(word) >= 4 and (not stem or len(word) >= len(t)):
                at = [word[:n] for n in range(len(t) - 2, len(t) + 3)] if stem else [word] if abs(len(word) - len(t)) < 3 else []
                near += [d for d in (distance(w, t) for w in at) if d <= Trie.errors(t)]
        return min(near) if min(near) < 99 and word not in model.clean else None

    known = {w: matched(w) for w in set(words)}
    sums = [0.0, 0.0]
    for i, m in enumerate(found):
        if (d := known[words[i]]) is None:
            continue
        line = low[: m.start()].rpartition("\n")[2], low[m.end() :].partition("\n")[0]
        around = words[max(0, i - 6) : i], words[i + 1 : i + 7]
        factor = 0.3 if line[0].count('"') % 2 and '"' in line[1] else 0.6 if set(around[0]) & SAYING else 1.0
        factor *= 1.25 if set(around[0] + around[1]) & ADDRESS else 1
        sums[d > 0] += factor / (1 + d) if d else factor
    both = sum(sums)
    letters = [0.0] if not low else [sum(ord(c) > 127 for c in low) / len(low)]
    x = [math.log1p(sums[0]), math.log1p(sums[1]), min(1.0, 20 * both / (20 + len(words))) if both else 0.0, float(both > 0.5)] + letters
    return 1 / (1 + math.exp(-max(-30, min(30, model.bias + sum(w * v for w, v in zip(model.weights, x, strict=True))))))


def test_the_query_gives_the_plain_scores(spark, small):
    from loomwright.llm.queries import QUERIES

    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    assert model.terms
    found = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, small).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        got, want = found[r["doc_id"]], plain_score(r["text"] or "", model)
        assert abs(got["score"] - want) < 1e-9 and got["predicted"] == int(want >= 0.5), r["doc_id"]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def labelled(n=400):
    random.seed(1)
    rows, labels = [], []
    for k in range(n):
        words = [f"w{random.randrange(300)}" for _ in range(random.randrange(5, 60))]
        words = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words]
        toxic = k % 9 == 0
        if toxic:
            for _ in range(4):
                words.insert(random.randrange(len(words)), random.choice(["scoundrel", "nitwit", "blockhead"]))
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, docs, odd_rows):
    rows, labels = labelled()
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs(rows), table)
    assert {t for t, _ in model.terms} >= {"scoundrel", "nitwit", "blockhead"}
    found = {r["doc_id"]: r for r in score_toxicity(docs(rows), model).collect()}
    for key, _, toxic in labels:
        assert found[key]["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert found[key]["predicted"] == toxic
    odd = score_toxicity(docs(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 and not (r["doc_id"] is None and r["held_out"]) for r in odd)
    assert drop_toxic(docs(odd_rows), model).count() == len(odd_rows)
    misspelt = score_toxicity(docs([(1, "wa wb scoundrell wc nittwit blokhead wd", "", "")]), model).collect()[0]
    assert misspelt["score"] > 10 * odd[0]["score"] or misspelt["predicted"] == 1


def test_without_labels_nothing_is_toxic(spark, docs, odd_rows):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs(odd_rows), empty)
    assert all(r["predicted"] == 0 for r in score_toxicity(docs(odd_rows), model).collect())
    assert score_toxicity(docs([]), model).count() == 0


def lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    random.seed(6)
    for _ in range(300):
        a, b = (np.array([random.randrange(6) for _ in range(random.randrange(14))], np.int64) for _ in range(2))
        got = a[shared_lines(a, b)].tolist()
        it = iter(b.tolist())
        assert all(x in it for x in got) and len(got) == lcs_length(a.tolist(), b.tolist())


def test_long_pages_are_aligned_by_halves():
    random.seed(12)
    for _ in range(200):
        a, b = (np.array([random.randrange(9) for _ in range(random.randrange(30))], np.int64) for _ in range(2))
        got = a[shared_lines(a, b, cells=6)].tolist()
        it = iter(b.tolist())
        assert all(x in it for x in got) and len(got) == lcs_length(a.tolist(), b.tolist())
    # 100,000 lines a side would be a table of 10 thousand million cells.
    a = np.random.default_rng(1).permutation(100_000)
    b = a.copy()
    b[::7] = -1 - np.arange(len(b[::7]))
    b = np.r_[b[50_000:60_000], b[:50_000], b[60_000:]]
    tracemalloc.start()
    shared = shared_lines(a, b)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert shared.sum() == len(a) - len(a[::7]) - sum(k % 7 > 0 for k in range(50_000, 60_000))


def test_differencing_decides_pages_that_mark_no_article(spark):
    """Hundreds of pages of some hosts; each host's template goes, each article stays."""
    random.seed(13)
    rows, want = [], {}
    for host in range(6):
        template = [f"host {host} line {k}" for k in range(12)]
        for page in range(60):
            own = [f"page {host} {page} says {random.random()}" for _ in range(random.randrange(1, 9))]
            lines = [*template[:7], *own, *template[7:]]
            key = host * 1000 + page
            rows.append((key, f"https://h{host}.example/section/{page // 10}/article-{page}.html", "".join(f"<div>{x}</div>" for x in lines)))
            want[key] = " ".join(own)
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == want and all(r["n_shared"] == 12 for r in found)


def test_words_about_an_article_and_layout_words():
    page = "<div class='article-meta'>by x</div><div class='has-sidebar content'><p>%s</p><article class=teaser>short</article><h2 class='section-header'>Head</h2></div>" % ("long text " * 9)
    assert [k for _, k in blocks(page)] == [1, 1, 2, 1]
    assert [k for _, k in blocks("<div>menu</div><div class='article-body'><h2 class='header'>Head</h2><p class=advert>buy</p>text</div>")] == [0, 2, 0, 2]


def test_markup():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header>site</header><nav><a>m</a></nav><main><h1>Head &amp;\n tail</h1>
      <p class="lead">one <b>two</b><br>three<p>four<aside>side</aside><div class="comments"><p>said</p></div><form>f</form><script>"</p>"</script></main><div class=cookie-notice>c</div><footer>foot</footer>"""
    assert [t for t, k in blocks(page) if k == 2] == ["Head & tail", "one two three", "four"]
    assert blocks("") == [] and blocks("a &am") == [("a &am", 1)]


def test_differencing_decides_unmarked_blocks(spark):
    rows = [(1, "http://h.x/a/1", "<div>Top line</div><div>own one</div><div>End line</div>"), (2, "http://h.x/a/2?q=1", "<div>Top line</div><div>own two</div><div>End line</div>"), (3, "http://other.x/a/1", "<div>Top line</div>"), (4, "http://h.x/a/3", "<nav>n</nav><article><p>Top line</p></article>"), (5, None, None), (6, "no url", "<p>x"), (None, "http://h.x/a/1", "<p>y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as text", "3 as lines")
    found = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    assert found == {1: "own one", 2: "own two", 3: "Top line", 4: "Top line", 5: "", 6: "x", None: "y"}
    assert main_text(frame.limit(0)).count() == 0
    near = {r["id"]: r["partner"] for r in nearest_pages(frame.selectExpr("page_id as id", "url")).collect()}
    assert near[1] == 2 and 3 not in near


def test_pages_table(spark, small):
    from loomwright.llm.queries import QUERIES

    found = {r["page_id"]: r for r in QUERIES["op4_html_text"](spark, small).collect()}
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        inside = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        assert found[r["page_id"]]["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"])


def test_pipeline_stage_by_stage(spark, small):
    """Each stage on what the one before kept, against a plain version."""
    from test_near import components_by_hand

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "pieces"] and corpus_pipeline.ORACLE_SQL is None
    stages = dict(corpus_pipeline.STAGES)
    save = lambda df, n: corpus_pipeline.written(df, n)
    a = save(stages["toxicity"](spark, docs, small), "a")
    matcher = fit_toxicity(docs, labels).matcher()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in a.collect()) == sorted(k for k, t in texts.items() if matcher.score(t or "") < 0.5)
    b = save(stages["exact_dedup"](spark, a, small), "b")
    first = {}
    for k in sorted(r["doc_id"] for r in a.collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[k] or ""), k)
    assert sorted(r["doc_id"] for r in b.collect()) == sorted(first.values())
    c = save(stages["near_dedup"](spark, b, small), "c")
    found = components_by_hand([(k, texts[k]) for k in first.values()])
    assert sorted(r["doc_id"] for r in c.collect()) == sorted(k for k, (_, root) in found.items() if k == root)
    d = save(stages["mixing"](spark, c, small), "d")
    assert a.columns == b.columns == c.columns == d.columns == names
    assert {r["doc_id"] for r in d.collect()} <= {r["doc_id"] for r in c.collect()} and d.count() > 0
    e = stages["pieces"](spark, d, small).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(r["doc_id"] for r in e) == sorted(r["doc_id"] for r in d.collect())
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == library.encode(texts[r["doc_id"]] or "", add_bos=True, add_eos=True) for r in e)
    assert len(corpus_pipeline.run(spark, small).collect()) == len(e)


def test_stages_on_odd_rows_and_on_none(spark, docs, odd_rows, small):
    """Nulls, blanks, repeated rows, a very long text and clashing columns pass every stage; so does an empty table."""
    kept = {"toxicity": 9, "exact_dedup": 6, "near_dedup": None, "mixing": None, "pieces": None}
    for name, stage in corpus_pipeline.STAGES:
        frame = docs(odd_rows)
        found = stage(spark, frame, small)
        rows = found.collect()
        if name != "pieces":
            assert found.columns == frame.columns
        if kept[name] is not None:
            assert len(rows) == kept[name]
        assert {r["doc_id"] for r in rows} <= {r[0] for r in odd_rows}
        assert stage(spark, docs([]), small).count() == 0
