"""Bounded samples of labelled documents, and rows held out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a row without an id counts as one with an empty id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: tuple[int, int], seed: int = 7) -> DataFrame:
    """(text, label) of at most ``sample`` rows of class 0 and class 1, those with the smallest hash of the id.

    Ids of ``labels`` are cut to the sample first, so what is broadcast is bounded by ``sample``.  Rows without a
    label, or whose id is in no document, are left out; of an id with several documents the first text in binary order is taken.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train).select("doc_id", F.col(label).cast("int").alias("label"))
    order = F.xxhash64("doc_id", F.lit(seed))
    parts = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(most) for k, most in enumerate(sample)]
    picked = parts[0].unionAll(parts[1]).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
