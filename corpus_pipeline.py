"""Corpus pipeline: documents through five operators to packed token sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import lang_id, mixing, packing, pii, simhash
from larder.llm.common import stage, table


#: Fewer remembered words than the operator's default: the Python workers also hold what earlier stages left.
PACK_CACHE_WORDS = 500_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    return lang_id.drop_rejected(docs, lang_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.simhash_dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind."""
    return pii.redact(docs, pii.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each time."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return packing.pack_documents(docs, cache_words=PACK_CACHE_WORDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix),
          ("pack", pack)]

#: The stages are learned or drawn, which SQL can't express; the tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
