"""A corpus from raw documents to packed batches, stage by stage.

Every stage takes what the one before it kept, written as Parquet and read again. All but
the last return the columns of the documents, whatever these are. Null texts and empty
ones have no language and end at the first stage; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patronlens.llm import exact_dedup, language_id, mixing, ngram_join, packing
from patronlens.llm.common import reachable
from patronlens.operators.lineage import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The near-duplicate stage links more than op10_ngram_join does, which has a contract of its own.
NEAR = (80, 100)  # linked when 100 * intersection >= 80 * union
NEAR_GRAM = 5


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter, and the undecided, go."""
    return language_id.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id goes on."""
    return exact_dedup.kept_rows(docs, exact_dedup.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of word ``NEAR_GRAM``-grams are ``NEAR`` similar, the one with the smallest doc_id goes on."""
    return ngram_join.representatives(docs, similar=NEAR, n=NEAR_GRAM)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents in padded batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", languages),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Language identification is a trained model, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
