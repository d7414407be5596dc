"""Direct codes, the Merkle manifest and importance resampling, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from loomwright.llm import importance, merkle
from loomwright.llm.common import shared_dir
from loomwright.llm.direct_codes import Builder, CodeFile, WordEncoder, read_codes, tokens_at, write_codes
from loomwright.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " \t\n", "naïve  Straße\x1cx\x1fy z ́a é İI ΑΣ ΑΣΑ", "a<|endoftext|>b <|startoftext|>", "don't'll x1234 𝔘 ▁\x0b\x0cq", " a\u0085b", "it's" * 50]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


def test_words_have_the_librarys_ids(library):
    random.seed(3)
    letters = "abcXYZ '.,<|>12é́ßΣİ\t\n\x0b\x1c ‍𝔘日本"
    texts = ODD + ["".join(random.choices(letters, k=random.randrange(60))) for _ in range(500)]
    own = WordEncoder(VOCABULARY)
    own.remembered = 50
    for _ in range(2):
        found = own.encode(pa.array(texts, pa.large_string()))
        assert [x.tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    long = " ".join(texts) * 3
    assert own.encode(pa.array([long], pa.large_string()), 100)[0].tolist() == library.encode(long, add_special_tokens=False).ids


@pytest.mark.parametrize("top", [200, 256, 60_000, 1 << 24, 1 << 32])
def test_any_token_and_any_run_is_read(tmp_path, top):
    rng = np.random.default_rng(top)
    file, all_tokens = Builder(), []
    for k in range(40):
        tokens = np.minimum(rng.integers(0, top, rng.integers(0, 300)), rng.choice([255, 256, top - 1])).astype(np.uint32)
        file.add(None if k == 7 else k - 20, tokens)
        all_tokens += tokens.tolist()
    from pyarrow.fs import LocalFileSystem

    file.write(LocalFileSystem(), str(tmp_path / "x.codes"))
    with LocalFileSystem().open_input_file(str(tmp_path / "x.codes")) as opened:
        found = CodeFile(opened)
        assert found.n_tokens == len(all_tokens) and found.n_docs == 40
        assert [found.token(i) for i in range(0, len(all_tokens), 7)] == all_tokens[::7]
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(all_tokens) + 1, 2).tolist())
            assert found.run(a, b).tolist() == all_tokens[a:b]
        ids, missing, starts = found.documents(5, 10)
        assert ids[~missing].tolist() == [-15, -14, -12, -11] and missing.tolist() == [False, False, True, False, False] and len(starts) == 6
        with pytest.raises(IndexError):
            found.token(len(all_tokens))


def test_codes_of_the_table(spark, small, library):
    rows = {r["doc_id"]: r for r in QUERIES["op11_direct_codes"](spark, small).collect()}
    start = 0
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    assert len(rows) == len(docs)
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        assert tuple(rows[r["doc_id"]]) == (r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_codes_of_odd_rows(spark, docs, odd_rows, library):
    path = f"{shared_dir(spark)}/codes-{uuid.uuid4().hex}"
    write_codes(docs([*odd_rows, *((20 + k, t, "en", "s") for k, t in enumerate(ODD))]), path, VOCABULARY, file_tokens=300)
    found = sorted(read_codes(spark, path, 50).collect(), key=lambda r: r["start"])
    texts = [(r[0], r[1] or "") for r in odd_rows] + [(20 + k, t) for k, t in enumerate(ODD)]
    texts.sort(key=lambda r: (r[0] is not None, r[0]))
    assert [r["doc_id"] for r in found] == [k for k, _ in texts]
    ids = [library.encode(t, add_special_tokens=False).ids + [2] for _, t in texts]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == ids
    flat = sum(ids, [])
    places = spark.range(-3, len(flat) + 5, 11).withColumnRenamed("id", "place")
    got = {r["place"]: r["token"] for r in tokens_at(spark, path, places, stretch=1000).collect()}
    assert got == {k: flat[k] if 0 <= k < len(flat) else None for k in range(-3, len(flat) + 5, 11)}
    # A task that is tried again leaves files that no row of the manifest names.
    from pathlib import Path

    folder = Path(path.removeprefix("file:"))
    (folder / "0000000-00000-left.codes").write_bytes(b"half a file")
    assert read_codes(spark, path).count() == len(texts)
    write_codes(docs([]), path + "-none", VOCABULARY)
    assert read_codes(spark, path + "-none").count() == 0


# The manifest


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values) -> str:
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves: list[str], arity: int) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][a : a + arity]) for a in range(0, len(levels[-1]), arity)])
    return levels


def walk(levels: list[list[str]], i: int, arity: int, own: str) -> tuple[str, str]:
    """The siblings up a tree, and the root with another leaf."""
    proof = ""
    for level in levels[:-1]:
        first = i - i % arity
        run = level[first : first + arity]
        proof += "".join(run[: i - first] + run[i - first + 1 :])
        own = H(*run[: i - first], own, *run[i - first + 1 :])
        i //= arity
    return proof, own


def plain_manifest(rows: list[tuple], received: list[tuple], arity: int = 3) -> list[tuple]:
    """rows: doc_id, source and other values; a plain tree for each source, and one over them."""
    pairs = sorted(((r, leaf_of(r), leaf_of(g)) for r, g in zip(rows, received, strict=True)), key=lambda p: (p[0][1] is not None, (p[0][1] or "").encode(), p[0][0] is not None, p[0][0] or 0, p[1]))
    groups: dict = {}
    for r, leaf, got in pairs:
        groups.setdefault(r[1], []).append((r[0], leaf, got))
    trees = {s: levels_of([leaf for _, leaf, _ in g], arity) for s, g in groups.items()}
    top = levels_of([t[-1][0] for t in trees.values()], arity)
    out = []
    for o, (s, g) in enumerate(groups.items()):
        for i, (doc_id, leaf, got) in enumerate(g):
            low, sub = walk(trees[s], i, arity, got)
            high, root = walk(top, o, arity, sub)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], low + high, root, root == top[-1][0]))
    return out


COLUMNS = ("doc_id", "source", "lang", "text")


@pytest.mark.parametrize("stride, fan", [(8, 16), (2, 2)])
def test_manifest_is_that_of_plain_trees(spark, monkeypatch, stride, fan):
    """Sources of 1, 3, 4, 9, 10, 28 and 300 rows, null ones among them, with ties and repeated rows."""
    monkeypatch.setattr(merkle, "STRIDE", stride)
    rows = [(k, s, "en" if k % 3 else None, f"text {k}\n") for s, n in (("a", 1), (None, 3), ("é", 4), ("z", 9), ("B", 10), ("", 28), ("hot", 300)) for k in range(n)]
    rows += [(None, "z", None, None), (5, "hot", "en", "other"), (5, "hot", "en", "other"), (None, None, None, None)]
    random.Random(5).shuffle(rows)
    received = [(a, b, c, d if d is None or (a or 0) % 2 else d.replace("\n", "")) for a, b, c, d in rows]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").repartition(7).withColumns({c: F.lit(1) for c in ("n", "tree", "idx", "digest", "block", "level", "g", "p", "leaf")})
    changed = F.when(F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))
    found = merkle.merkle_manifest(frame, COLUMNS, received={"text": changed}, fan=fan)
    got = sorted(map(str, (tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect())))
    assert got == sorted(map(str, plain_manifest(rows, received)))


def test_many_partitions_merge_in_rounds(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [(k, f"s{k % 2 * (k % 40)}", "en", str(k)) for k in range(2000)]
        frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
        found = merkle.merkle_manifest(frame, COLUMNS, fan=4)
        got = sorted(tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted(plain_manifest(rows, rows)) and all(r[-1] for r in got)


def test_additions_in_any_order_give_the_same_forest():
    leaves = [(t, n, 0, i, H(f"{t}:{i}")) for t, n in ((0, 1), (1, 7), (2, 27), (3, 28)) for i in range(n)]
    made = set()
    for seed in range(20):
        random.Random(seed).shuffle(leaves)
        parts = [merkle.Forest(4, 3) for _ in range(4)]
        nodes = [x for k, leaf in enumerate(leaves) for x in parts[k % 4].add(leaf)]
        whole = parts[0]
        for other in parts[1:]:
            nodes += [x for node in other.nodes() for x in whole.add(node)]
        assert not whole.open
        made.add(frozenset(nodes))
    assert len(made) == 1


def test_manifest_of_few_rows(spark, docs, odd_rows):
    assert merkle.merkle_manifest(docs([]), COLUMNS).count() == 0
    one = merkle.merkle_manifest(docs(odd_rows[:1]), COLUMNS).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] == leaf_of((1, None, None, None)) and one["proof"] == "" and one["verified"]
    found = merkle.merkle_manifest(docs(odd_rows), COLUMNS)
    wanted = plain_manifest([(a, d, c, b) for a, b, c, d in odd_rows], [(a, d, c, b) for a, b, c, d in odd_rows])
    assert sorted(str(r["leaf"]) for r in found.collect()) == sorted(w[1] for w in wanted) and {r["root"] for r in found.collect()} == {wanted[0][3]}


# Importance


def words_of(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def runs(text: str | None, longest: int) -> list[str]:
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain_resample(docs, target, longest=1, buckets=10_000, seed=2024, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in runs(text, longest):
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        found = runs(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank: dict = {}
    for i, r in enumerate(able):
        rank.setdefault(r, []).append(i + 1 if i < percent * len(able) // 100 else None)
    return [(*r[:4], rank[r].pop() if r in rank else None) for r in rows]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_scores_are_those_of_plain_counts(spark, docs, odd_rows, small, longest, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 300)  # long texts are read in pieces
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").limit(80).collect()]
    rows = [(None if k is None else k + 10**6, t) for k, t, *_ in odd_rows] + table
    target = ["Quick Brown fox", None, "", "ÄÖ é 12x"] + [t for _, t in table[:5]]
    frame = docs([(k, t, "en", "s") for k, t in rows])
    found = importance.importance_resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, percent=30)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain_resample(rows, target, longest, percent=30)))


def test_resampling_without_rows_or_target(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance.importance_resample(docs([]), none).count() == 0
    rows = [(k, " ".join(f"w{k + i}" for i in range(25))) for k in range(30)]
    found = importance.importance_resample(docs([(k, t, None, None) for k, t in rows]), none)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain_resample(rows, [])))
