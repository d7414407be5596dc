from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, blanks, repeated rows, ties and columns whose names clash with those made."""

    def make(rows, schema="doc_id long, text string, lang string, source string"):
        frame = spark.createDataFrame(rows, schema)
        clash = {c: F.lit(1) for c in ("id", "kept", "n", "node", "score", "copies", "keep_id", "html", "norm", "x", "a", "b", "media")}
        return frame.withColumns({c: v for c, v in clash.items() if c not in frame.columns})

    return make


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows():
    return [(1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", "s"), (4, "one two", "de", None), (4, "one two", "de", None), (5, LONG, "en", "s"), (6, "naïve ▁ 𝔘   text", None, "s"), (None, "no id here at all", "fr", "t"), (7, "one  two", "de", "t")]
