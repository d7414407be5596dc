"""Secrets, exact dedup, mixing, pieces and token counts on odd rows and against plain models."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from loomwright.llm import secrets
from loomwright.llm.exact_dedup import drop_exact_copies, exact_dedup
from loomwright.llm.mixing import Mix, apply_mix, leaf_budgets, mix_sources
from loomwright.llm.piece_bpe import encode_pieces
from loomwright.llm.token_files import TokenFormat, _encoding, byte_ranges, count_tokens, write_token_files
from loomwright.sinks.files import fresh_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def spans_by_hand(text):
    out = []
    for rank, (kind, pattern) in enumerate((("assign", secrets.ASSIGN), ("access", secrets.ACCESS), ("hex", secrets.HEX))):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if kind != "assign" or len(m[2]) >= 6]
    base = sorted(out)
    for m in re.finditer(secrets.CANDIDATE, text):
        if any(re.search(p, m[0]) for p in secrets.ALLOW) or any(s < m.end() and e > m.start() for s, _, e, _ in base):
            continue
        k, c = next((i, c) for i, c in enumerate(secrets.CLASSES) if re.search(c.pattern, m[0]))
        w = secrets.WINDOW
        hot = []
        for i in range(len(m[0]) - w + 1):
            counts = Counter(m[0][i : i + w]).values()
            if sum(secrets.weight(n) for n in counts) <= secrets.most(c.bits):
                hot.append(i)
        if hot:
            out.append((m.start() + hot[0], 3 + k, m.start() + hot[-1] + w, c.kind))
    return base, sorted(out)


def test_secrets_against_a_plain_model(spark, docs, odd_rows):
    random.seed(2)
    letters = "abcdefXYZ0123456789+/_=-"
    texts = ["password = 'abc123' token:xy", "AKIA" + "A1" * 9, "é" + "0f" * 20 + "𝔘 API_KEY=\"zzzzzzz", "123e4567-e89b-12d3-a456-426614174000"]
    texts += ["".join(random.choices(letters, k=random.randint(15, 60))) + " x " + "".join(random.choices(letters, k=30)) for _ in range(150)]
    rows = [*odd_rows, *((100 + i, t, None, None) for i, t in enumerate(texts))]
    found = secrets.scan_secrets(docs(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for key, text, *_ in rows:
        base, both = spans_by_hand(text or "")
        assert [tuple(s) for s in by_id[key]["base"]] == base
        assert sorted([*(tuple(s) for s in by_id[key]["base"]), *(tuple(s) for s in by_id[key]["entropy"])]) == both
    assert math.isclose(secrets.weight(4), 8e6)


def test_exact_dedup(spark, docs, odd_rows):
    found = exact_dedup(docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for r in found:
        text = next(t for k, t, *_ in odd_rows if k == r["doc_id"])
        same = [k for k, t, *_ in odd_rows if norm(t) == norm(text)]
        assert r["group_size"] == len(same) and r["keep_id"] == min((k for k in same if k is not None), default=None)
        assert r["text_sha256"] == hashlib.sha256(norm(text).encode()).hexdigest()
    kept = drop_exact_copies(docs(odd_rows))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6] and "keep_id" in kept.columns
    assert exact_dedup(docs([])).count() == 0
    same = [(1, "a  b", None, "s"), (1, "a b", None, "t"), (1, "a b", None, "s"), (2, "a b", "en", "s")]
    assert len({tuple(drop_exact_copies(docs(some)).select("doc_id", "text", "source").collect()[0]) for some in (same, same[::-1])}) == 1


def test_shortages_go_to_siblings_first(spark):
    """web/en/a can't use its share; web/en/b takes what is left before another language does."""
    leaves = spark.createDataFrame([("web", "en", "a", 10), ("web", "en", "b", 1000), ("web", "de", "c", 1000), ("books", "en", "d", 1000)], "domain string, lang string, source string, tokens long")
    mix = Mix(weights={"domain": {"web": 1, "books": 1}, "lang": {"en": 1, "de": 1}, "source": {}}, share=(800, 3010), max_epochs=1)
    found = {r["source"]: int(r["granted"]) for r in leaf_budgets(leaves, mix).collect()}
    assert found == {"a": 10, "b": 190, "c": 200, "d": 400}


def test_mixture_meets_its_budget(spark, docs, odd_rows):
    random.seed(5)
    rows = [(i, "word " * random.randint(1, 30), random.choice(["en", "de", None]), f"s{i % 7}") for i in range(300)]
    mix = Mix()
    found = mix_sources(docs(rows), mix).collect()
    total = sum(r["n_tokens"] for r in found)
    used = sum(r["n_tokens"] * r["copies"] for r in found)
    assert len(found) == 300 and 0 <= used <= total
    leaves = {(r["domain"], r["lang"], r["source"]) for r in found}
    assert total - used <= 30 * len(leaves)
    odd = mix_sources(docs(odd_rows)).collect()
    assert len(odd) == len(odd_rows) and {r["lang"] for r in odd if r["doc_id"] in (1, 6)} == {"none"}
    assert apply_mix(docs(rows)).count() == sum(r["copies"] for r in found)
    assert mix_sources(docs([])).count() == 0


def test_pieces_are_the_library_s(spark, docs, odd_rows):
    random.seed(4)
    chars = "abc éß▁ \n\t  日本𝔘-1.,THE the "
    rows = [*odd_rows, *((100 + i, "".join(random.choices(chars, k=random.randint(0, 80))), None, None) for i in range(300))]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {r["doc_id"]: r for r in encode_pieces(docs(rows), MODEL).collect()}
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(found[key]["ids"], "<u4").tolist() == ids
        assert found[key]["decoded"] == library.decode(ids) and found[key]["n_tokens"] == len(ids)
    assert encode_pieces(docs([]), MODEL).count() == 0


def test_token_counts_of_a_whole_table_over_ranges(spark):
    """Files are read by several tasks each, and documents cross their borders."""
    path, ranks = fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(2)
    write_token_files(frame, path, ranks, public_tokenizers.PATTERN)
    assert byte_ranges(spark, path, 700).groupBy("path").count().agg({"count": "max"}).collect()[0][0] > 100
    encode = _encoding(ranks, public_tokenizers.PATTERN).encode_ordinary
    want = sorted((r["doc_id"], len(encode(r["text"] or "")), True) for r in frame.collect())
    for ranged in (700, 1 << 22):
        assert sorted((r["doc_id"], r["n_tokens"], r["closed"]) for r in count_tokens(spark, path, range_tokens=ranged, block_tokens=64).collect()) == want


def test_ids_that_are_no_integers_are_null(spark):
    path = fresh_path(spark, "tokens")
    write_token_files(spark.createDataFrame([("x", "one"), ("7", "two")], "doc_id string, text string"), path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {r["doc_id"] for r in count_tokens(spark, path).collect()} == {None, 7}


def test_many_matches_of_a_text(spark):
    """Spans are those of the plain scan however many chunks of matches a text has."""
    random.seed(8)
    texts = [" ".join(random.choice(["0f" * 13, "é" * random.randrange(4), "token=abcdef" + "x" * random.randrange(3)]) for _ in range(n)) for n in (63, 64, 65, 129, 3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan_secrets(frame).collect():
        want = [(m.start(), m.end()) for m in re.finditer(r"(?i:token)=[A-Za-z0-9]{6,}|(?<![0-9a-f])[0-9a-f]{24,}", texts[r["doc_id"]])]
        assert [(s["start"], s["end"]) for s in r["base"]] == want


@pytest.mark.parametrize("block", [3, 1000, 1 << 16])
def test_token_counts_over_block_borders(spark, docs, odd_rows, block):
    path, ranks = fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    frame = docs(odd_rows)
    write_token_files(frame, path, ranks, public_tokenizers.PATTERN)
    found = sorted(((r["doc_id"] or 0), r["n_tokens"]) for r in count_tokens(spark, path, range_tokens=2 * block, block_tokens=block).collect())
    encode = _encoding(ranks, public_tokenizers.PATTERN).encode_ordinary
    assert found == sorted(((k or 0), len(encode(t or ""))) for k, t, *_ in odd_rows)


def test_files_of_others(spark, tmp_path):
    f = TokenFormat(end=9, digit=0, header=0)
    for name, ids in (("a", [1, 2, 9, 9, 3]), ("b", []), ("c", [9]), ("d", [5, 5, 5])):
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    found = sorted((r["path"][-1], r["n_tokens"], r["closed"]) for r in count_tokens(spark, str(tmp_path), f, 2).collect())
    assert found == [("a", 0, True), ("a", 1, False), ("a", 2, True), ("c", 0, True), ("d", 3, False)]


def test_no_documents_no_tokens(spark, docs):
    path = fresh_path(spark, "none")
    write_token_files(docs([]), path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert count_tokens(spark, path).count() == 0


def test_paths_are_told_without_repeated_groups(spark):
    random.seed(7)
    words = {"".join(random.choices("aB1/_-", k=random.randrange(1, 9))) for _ in range(6000)} | {"ab/" * 3 + "c12/", "/ab-cd/1234/", "/ab-cd/12345", "ab-/", "ab//", "//ab", "ab--"}
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "m string").select("m", secrets.is_path(F.col("m")).alias("is_path")).collect()
    assert [r["m"] for r in rows if r["is_path"] != bool(re.search(secrets.PATH, r["m"]))] == []
    long = spark.createDataFrame([("abc/de_f-" * 100_000 + "12",), ("abc/de_f-" * 100_000 + "x1y",)], "m string")
    assert [r["p"] for r in long.select(secrets.is_path(F.col("m")).alias("p")).collect()] == [True, False]


def test_long_candidates_and_many_spans(spark, docs):
    """The rows of the plain model, for a candidate of 30,000 characters and for 5,000 runs and candidates in one text."""
    random.seed(8)
    some = lambda letters, k: "".join(random.choices(letters, k=k))
    mixed = " ".join(some("0123456789abcdef" if k % 2 else string.ascii_letters + string.digits, 22 + k % 9) for k in range(5_000))
    texts = [some(string.ascii_letters + string.digits, 30_000), some("0123456789ABCDEF", 3_000), mixed, "token=" + some(string.ascii_letters + string.digits, 2_000)]
    found = {r["doc_id"]: r for r in secrets.scan_secrets(docs([(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    for k, text in enumerate(texts):
        base, both = spans_by_hand(text)
        assert [tuple(s) for s in found[k]["base"]] == base
        assert sorted([*(tuple(s) for s in found[k]["base"]), *(tuple(s) for s in found[k]["entropy"])]) == both
