"""Queries of the numbered operators over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import (
    chat_format, exact_dedup, html_extract, language_id, mixing, ngram_join, packing, quality_nbsvm, spelling_variants,
    toxicity, url_filter, vector_search, whitening,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("low_id").alias("component_id")
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.document_languages(read(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.page_languages(read(spark, sf_dir, "pages"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(read(spark, sf_dir, "pages"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(read(spark, sf_dir, "conversations"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.searched(read(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged_pages(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.document_spellings(read(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_nbsvm.scored_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_embeddings(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op4_chat_format": op4_chat_format,
    "op7_vector_search": op7_vector_search,
    "op5_url_filter": op5_url_filter,
    "op10_toxicity": op10_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_embedding_whitening": op13_embedding_whitening,
    "language_id_pages": language_id_pages,
}

SQL = {
    "op4_chat_format": chat_format.SQL,
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
}
