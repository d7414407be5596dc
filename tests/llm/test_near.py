from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from loomwright.llm.components import connected_components
from loomwright.llm.hyperminhash import estimated_jaccard, shingle_sets, sketches
from loomwright.llm.near_dedup import NearDedup, drop_near_copies, near_dedup


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_by_hand(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_by_hand(rows):
    sets = {k: sets_by_hand(t) for k, t, *_ in rows}
    inverted, parent = defaultdict(list), {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in sorted(sets):
        common = Counter(j for s in sets[k] for j in inverted[s])
        for s in sets[k]:
            inverted[s].append(k)
        for j, n in common.items():
            if 100 * n >= 85 * (len(sets[k]) + len(sets[j]) - n):
                a, b = sorted((root(k), root(j)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def corpus():
    """Chains and groups of edited copies around the threshold, short texts, and a passage that many share."""
    random.seed(11)
    rows, key = [], 0
    passage = [f"p{i}" for i in range(60)]
    for _ in range(12):
        text = [f"t{random.randrange(4000)}" for _ in range(random.choice([6, 12, 80, 300]))]
        for _ in range(random.randrange(1, 14)):
            key += 1
            rows.append((key, " ".join(text), "en", "s"))
            text = list(text)
            for _ in range(max(1, len(text) // 120)):
                text[random.randrange(len(text))] = f"e{random.randrange(9000)}"
    for _ in range(60):
        key += 1
        rows.append((key, " ".join([*passage, *(f"q{random.randrange(9000)}" for _ in range(random.randrange(2, 40)))]), "en", "s"))
    rows += [(key + 1, "a b c d e f g", "", ""), (key + 2, "A b C d E f g x", "", ""), (key + 3, "a b", "", ""), (key + 4, " A\tB ", "", ""), (key + 5, None, "", ""), (key + 6, "", "", "")]
    random.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(spark, docs):
    rows = corpus()
    wanted = components_by_hand(rows)
    for p in (NearDedup(), NearDedup(block_sets=8, block_shingles=700)):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup(docs(rows), p=p).collect()}
        assert found == wanted


def test_a_large_group_is_compared_with_its_hub(spark, monkeypatch):
    """Of one component the rows that are moved and compared grow with its sets, not with their pairs."""
    from loomwright.llm import near_dedup as module

    random.seed(14)
    base = [f"b{i}" for i in range(160)]
    moved, written = {}, module.written

    def counted(frame, name):
        made = written(frame, name)
        moved[name] = made.count()
        return made

    monkeypatch.setattr(module, "written", counted)
    for n in (2_000, 20_000):
        texts = [list(base) for _ in range(n)]
        for k in range(1, n):
            texts[k][random.randrange(160)] = f"e{k}"
        rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
        found = near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        assert {r["component_id"] for r in found} == {0} and len(found) == n
        assert moved["stars"] <= 64 * n and moved["stars"] < 12 * n and moved["parted"] < n, moved


def test_rows_of_one_id_are_placed_by_their_own_texts(spark):
    a, b = ([f"{c}{i}" for i in range(100)] for c in "xy")
    near = lambda w: " ".join([*w[:-1], "z"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, "one of its own kind")]
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(1, 96, 1), (1, 96, 1), (2, 96, 1), (3, 96, 1), (4, 1, 4)]


def test_odd_rows(spark, docs, odd_rows):
    found = near_dedup(docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[1]["n_shingles"], by_id[1]["component_id"], by_id[1]["kept"]) == (0, 1, True)
    assert by_id[7]["component_id"] == 4 and not by_id[7]["kept"] and by_id[None]["component_id"] is None
    kept = drop_near_copies(docs(odd_rows))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 4, 5, 6] and "kept" in kept.columns
    assert near_dedup(docs([])).count() == 0


def test_estimates_are_close():
    random.seed(7)
    base = [f"w{i}" for i in range(600)]
    texts = [" ".join(base), " ".join(base[:500] + [f"z{i}" for i in range(100)]), " ".join(f"y{i}" for i in range(600))]
    sets = shingle_sets(pa.array(texts, pa.large_string()))
    r = sketches(sets)
    true = 496 / (596 + 596 - 496)
    assert abs(float(estimated_jaccard(r[0], r[1], sets.sizes[0], sets.sizes[1])) - true) < 0.1
    assert float(estimated_jaccard(r[0], r[2], sets.sizes[0], sets.sizes[2])) < 0.02
    assert sets.sizes.tolist() == [len(sets_by_hand(t)) for t in texts]
    assert np.all(r[0] != 0xFFFF)


def test_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    found = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{k: 100 for k in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
