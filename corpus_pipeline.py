"""A training corpus from the documents: quality rules, language, exact and near duplicates, packed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsight.llm import exact_dedup, langid, near_sets, packing, quality
from flowsight.llm.queries import VOCABULARIES, WORD_VOCABULARY
from flowsight.session import written

# How much of a language's n-grams a text must have, of what the language's own texts have on average.
MIN_LANGUAGE_SCORE = 0.3
# What a worker holds while it packs: executors come to this stage with the heap that near copies took.
PACKED_WORDS = 100_000
PACKED_ROWS = 500


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_rows(docs, VOCABULARIES)


def documents_of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the languages that the documents state."""
    return langid.known_language(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of each group of equal texts."""
    return exact_dedup.one_of_each(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies: five-word shingles, similarity 0.8 or more.

    SimHash groups come first and are checked exactly; bands of MinHash add what lies beyond its 3 bits.
    """
    return near_sets.first_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training windows, with their ids."""
    return packing.pack(docs, WORD_VOCABULARY, words=PACKED_WORDS, rows_at_once=PACKED_ROWS)


STAGES = [
    ("quality rules", good_documents),
    ("language ID", documents_of_known_language),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("packing", packed),
]

# Merges, fingerprints and windows cannot be expressed in SQL: tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
