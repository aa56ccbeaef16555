"""Corpus pipeline: toxic documents go, then poor ones, then near-duplicates, and what stays is packed.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's documents.  All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stepstone.llm import packing, quality, simhash, toxicity
from stepstone.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: rows that score below the threshold."""
    return toxicity.keep_clean(docs, toxicity.labels_of(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rows that score at the threshold or more."""
    return quality.keep_good(docs, toxicity.labels_of(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one row of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token pieces with their sequence and offset."""
    return packing.packed(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Trained scores and an order of decisions: SQL can't say the same; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
