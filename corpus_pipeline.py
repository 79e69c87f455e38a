"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns a DataFrame that is written
as Parquet and read again as the next one's documents. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitpanel.functions.stages import stage
from pitpanel.llm import exact_dedup, language_id, mixing, ngram_join, packing


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; blank and noise-like texts go."""
    return language_id.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, the one with the smallest id."""
    return ngram_join.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as it is drawn."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per token piece with its place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mixture),
    ("best-fit packing", packed),
]

#: Models, draws and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
