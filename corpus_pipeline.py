"""From raw documents to packed training windows.

Each stage takes the documents that the one before it kept, written as Parquet and read
again; the last one returns the pieces of the training windows. All but the last return the
columns of their documents, whatever they are called.

Odd inputs, in any stage: an empty table gives an empty one. A null text counts as an empty one. Rows
with a null id are documents of their own and stay through all stages unless a stage's own rule drops
them; further columns may be null or have the names of inner columns. Repeated rows are copies of each other:
``exact_dedup`` leaves one of them. The stages' docstrings say what else happens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftspark.llm import decontamination, exact_dedup, jaccard, packing, quality
from driftspark.llm.common import stored


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null or empty text has no evidence of its own and stays where the rate of its source and
    language is low; a null source or language is a group. Without labels nothing is rejected.
    Repeated rows are judged each.
    """
    labels = quality.rejected_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.drop_rejected(docs, labels, F.col("source"), F.col("lang"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without blanks one document stays: the one with the most characters, then
    the smallest id. Null, empty and blank texts are equal, so one of them stays. Null ids come last."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8 one stays, that with the smallest
    id. A text without words is linked with nothing and stays; one of fewer than five words is linked with
    those of the same words."""
    return jaccard.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go. A text without words holds none; an empty benchmark
    drops nothing."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest is packed into training windows; a text without words is its end id only."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

#: The classifier, the tokenizer and the packing cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
