"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the documents of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqspark.llm import chunk_dedup, language, mixing, ngram_join, packing
from seqspark.llm.common import read_table, stored
from seqspark.llm.queries import MIXING_SEED, TARGET_WEIGHTS
from seqspark.llm.registry import query


# Parts of texts whose ids a packing worker keeps: the stages before have left the executors little memory.
KEPT_PARTS = 100_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return language.drop_unknown_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return chunk_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the least id stays."""
    return ngram_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources reach their weights, and shuffled."""
    return mixing.mix_sources(docs, TARGET_WEIGHTS, 1.0, MIXING_SEED).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens."""
    return packing.pack_documents(docs, kept=KEPT_PARTS)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The language, near-copy and packing stages cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
