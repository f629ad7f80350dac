"""The corpus pipeline: documents through quality rules, near-duplicate
removal, personal-data removal, mixing and packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; its result is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents. Stages set
the bound of Arrow batches, as their caller may have read the documents by other means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodlake.llm import jaccard_join, mixing, packing, pii, quality
from moodlake.llm.common import bound_batches, materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    bound_batches(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    bound_batches(spark)
    return jaccard_join.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and words that disclose it are replaced or removed."""
    bound_batches(spark)
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the target weights of sources, languages and topics."""
    bound_batches(spark)
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in windows of 4096 tokens."""
    bound_batches(spark)
    return packing.digest(packing.pack_documents(docs))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("packed", packed)]

# Stages fit robust estimates and call a tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
