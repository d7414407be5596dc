"""Partitions rewritten in place, and egress in batches."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomwright.sinks import merge, outbox
from loomwright.sinks.files import fresh_path


def test_only_touched_partitions_are_replaced(spark):
    path = fresh_path(spark, "parts")
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c/d e", 4), (None, 5)], "k string, v long")
    old.write.partitionBy("k").parquet(path)
    schema = spark.read.parquet(path).schema
    files = lambda k: {f for f in spark.read.parquet(path).inputFiles() if f"k={k}" in f}
    kept = files("b")
    new = spark.createDataFrame([(9, "a"), (8, "new")], "v long, k string")
    touched = spark.createDataFrame([("a",), ("new",), ("c/d e",), (None,)], "k string")
    for _ in range(2):
        merge.rewrite_partitions(spark, path, schema, "k", touched, lambda held: held.where("v = 1").unionByName(new))
        assert {(r["k"], r["v"]) for r in spark.read.schema(schema).parquet(path).collect()} == {("a", 1), ("a", 9), ("b", 3), ("new", 8)}
        assert files("b") == kept
    with pytest.raises(ValueError, match="aren't touched"):
        merge.rewrite_partitions(spark, path, schema, "k", touched.where("k = 'a'"), lambda held: new)
    assert spark.read.schema(schema).parquet(path).count() == 4


def test_null_keys_stay_apart(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    new = spark.createDataFrame([(None, "c"), (None, "d"), (1, "e"), (1, "f")], "k long, v string")
    assert sorted(map(str, map(tuple, merge.upsert(old, new, ["k"]).collect()))) == sorted(map(str, [(None, "a"), (None, "c"), (None, "d"), (1, "f")]))
    assert sorted(map(str, map(tuple, merge.upsert(old, new, ["k"], keep=["v"]).collect()))) == sorted(map(str, [(None, "a"), (None, "c"), (None, "d"), (1, "b")]))


def test_cells_take_the_shape_of_their_fields():
    assert outbox.cell("http://x", "link") == {"link": "http://x", "text": "http://x"} and outbox.cell(" ", "link") is None
    assert outbox.cell("a, b,,", "person") == [{"id": "a"}, {"id": "b"}] == outbox.cell(["a", None, "b"], "person") and outbox.cell("", "person") is None
    assert [outbox.cell(v, "number") for v in ("3.0", "x", 2.5, None)] == [3, None, 2.5, None]
    assert outbox.record({"a": 1, "b": 2}, {"a": "text", "z": "text"}) == {"a": "1"}


@pytest.mark.parametrize("bad", [set(), {3}, {0, 499}, set(range(0, 500, 7)), set(range(500))])
def test_batches_are_halved_down_to_the_refused_rows(bad):
    sent, calls = [], []

    def send(batch):
        calls.append(len(batch))
        if any(r["id"] in bad for r in batch):
            raise outbox.Refused("bad")
        sent.extend(r["id"] for r in batch)

    taken, refused = outbox.send_halving([{"id": k} for k in range(500)], send)
    assert [r["id"] for r in taken] == sent == [k for k in range(500) if k not in bad]
    assert [r["id"] for r in refused] == sorted(bad) and len(calls) <= 1 + 2 * 9 * max(len(bad), 1)


def test_rows_are_sent_once_and_refused_ones_named(spark):
    path = fresh_path(spark, "box")
    rows = spark.range(1203).select(F.col("id"), F.when(F.col("id") % 100 != 5, F.concat(F.lit("n"), "id")).alias("name"), F.lit("http://x").alias("url"), F.lit("u1,u2").alias("owner"), F.lit(1).alias("unknown"))
    fields = {"name": "text", "url": "link", "owner": "person"}
    outbox.write_outbox(rows.repartition(3), path, "loomwright.sinks.outbox:check_required", fields, ("id",), required="name")
    record = "name string, url struct<link:string,text:string>, owner array<struct<id:string>>"
    taken = outbox.read_outbox(spark, path, record, "id long").collect()
    assert sorted(r["id"] for r in taken) == [k for k in range(1203) if k % 100 != 5]
    assert all(r["name"] == f"n{r['id']}" and r["url"]["link"] == "http://x" and [p["id"] for p in r["owner"]] == ["u1", "u2"] for r in taken)
    refused = outbox.read_outbox(spark, path, record, "id long", refused=True).collect()
    assert sorted(r["id"] for r in refused) == list(range(5, 1203, 100)) and {r["why"] for r in refused} == {"no name"}
    # What a lost task has left is named by no commit.
    from pathlib import Path

    folder = Path(path.removeprefix("file:"))
    (folder / "taken-left.jsonl").write_text(json.dumps({"record": {"name": "x"}, "id": 1}) + "\n")
    assert outbox.read_outbox(spark, path, record, "id long").count() == len(taken)
    raw = [json.loads(x) for f in folder.glob("taken-*") for x in f.read_text().splitlines()]
    assert all("unknown" not in r["record"] for r in raw)


def test_a_failed_job_leaves_nothing_that_counts(spark):
    path = fresh_path(spark, "box")
    rows = spark.range(20).select("id", F.lit("x").alias("name")).repartition(2)
    with pytest.raises(Exception, match="unknown_column|KeyError"):
        outbox.write_outbox(rows, path, "loomwright.sinks.outbox:check_required", {"name": "text"}, ("unknown_column",), required="name")
    outbox.write_outbox(rows, path, "loomwright.sinks.outbox:check_required", {"name": "text"}, ("id",), required="name")
    assert sorted(r["id"] for r in outbox.read_outbox(spark, path, "name string", "id long").collect()) == list(range(20))


def test_fewest_moves_bring_fields_into_order():
    import itertools

    from loomwright.sinks.fields import apply_changes, fewest_changes

    wanted = ["a", "b", "c", "d", "e"]
    for have in itertools.permutations([*wanted[:4], "other"]):
        changes = fewest_changes(have, wanted)
        after = apply_changes(have, changes)
        assert [f for f in after if f != "other"] == wanted and sorted(after) == sorted([*wanted, "other"])
        known = [wanted.index(f) for f in have if f != "other"]
        longest = max(n for n in range(5) if any(list(c) == sorted(c) for c in itertools.combinations(known, n)))
        assert sum(c.kind == "move" for c in changes) == 4 - longest and [c.field for c in changes if c.kind == "add"] == ["e"]
    assert fewest_changes(wanted, wanted) == [] and [c.kind for c in fewest_changes([], ["x", "y"])] == ["add", "add"]
    with pytest.raises(ValueError, match="twice"):
        fewest_changes(["a", "a"], ["a"])
