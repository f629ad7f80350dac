"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.llm import (conversation_repair, jaccard_join, language_id, license_scan, mixing, packing, pii, quality,
                          token_counts, topk, toxicity, url_filters, vector_codes)
from moodlake.llm.common import read_table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are 75 % alike."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents")).drop("text_key")


def op2_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact length histogram of all documents with its suffix sums."""
    return token_counts.length_histogram(token_counts.lengths(read_table(spark, sf_dir, "documents")))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    return packing.digest(packing.pack_documents(read_table(spark, sf_dir, "documents")))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every 50th vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5, 256.0)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing words in every document."""
    return pii.digest(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four of five folds of the labels."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = language_id.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.learn(docs, labels, ~held)
    return toxicity.score(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held})


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated weight, probability and draw of every document."""
    return mixing.report(read_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections of every document."""
    return license_scan.digest(license_scan.scan(read_table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = read_table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.learn(docs.where(~held))
    return language_id.predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held})


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the outlier verdict of every document."""
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    return url_filters.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), url_filters.fixed_rules(spark)).drop("url")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest edits of every damaged conversation."""
    return conversation_repair.audit(conversation_repair.damage(read_table(spark, sf_dir, "conversations")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every vector under codebooks of eight parts."""
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_token_histogram, op3_top_k, op4_pack, op5_personal_data, op6_toxicity, op7_mixture, op8_license_scan,
                                   op9_language, op10_quality, op11_url_filters, op12_conversation_repair,
                                   op13_vector_codes)}
