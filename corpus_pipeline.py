"""Cleans a corpus for training: each stage reads what the one before has kept.

1. toxicity: documents that the grammar scores 0.7 or more go;
2. near_dedup: one document of each group of near duplicates stays (five-word shingles, 0.8);
3. decontamination: documents that cover half of a benchmark item go;
4. secrets: found spans are replaced by a mark, the documents stay;
5. byte_bpe: token ids of every document, and whether decoding gives the text back.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcart.llm.byte_bpe import decoded, encoded
from starcart.llm.decontamination import without_leaks
from starcart.llm.near_dedup import one_of_each
from starcart.llm.queries import rank_file, table
from starcart.llm.secrets import redacted
from starcart.llm.toxicity import fit_toxicity, without_toxic
from starcart.llm.words import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from labels that are not held out."""
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redacted(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document. A null text counts as empty.

    Ids are stored before they are decoded, so that a task never has two Python workers at once.
    """
    ranks, pattern = rank_file(), public_tokenizers.PATTERN
    found = encoded(docs, ranks, pattern, ("doc_id", "lang", "source", "text")).drop("starts")
    found = decoded(stored(found, "encoded"), ranks)
    return found.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("byte_bpe", byte_bpe),
]

#: No SQL: the stages hash, train and tokenize; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that come out of the last stage, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
