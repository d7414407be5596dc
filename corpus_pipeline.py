"""From raw documents to token ids: five stages over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  A caller may write each result as
Parquet and give the next stage what it reads back; :func:`run` does so in the
folder that the executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm.common import table, written
from loomwright.llm.exact_dedup import drop_exact_copies
from loomwright.llm.mixing import apply_mix
from loomwright.llm.near_dedup import drop_near_copies
from loomwright.llm.piece_bpe import encode_pieces
from loomwright.llm.queries import tokenizer_path
from loomwright.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (learnt from their labels) rejects go."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are used as often as the target weights say."""
    return apply_mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each use of a document, and digests of them and of their decoding."""
    encoded = encode_pieces(docs, tokenizer_path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("pieces", pieces)]

#: The toxicity model has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"stage-{name}")
    return docs
