"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import texts

PARTS = 1 << 30


def fold(modulus: int) -> Column:
    """crc32 of the doc_id written as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def held_out(modulus: int, remainder: int) -> Column:
    return F.coalesce(fold(modulus) == remainder, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int,
                  most: int) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled documents outside the held-out fold,
    or of all if there are fewer: ids are drawn by hash, the same ones in every run. An id
    with several label rows takes the largest; one with several texts the smallest text."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(fold(modulus) != remainder).groupBy("doc_id").agg(F.max("label").alias("label")))
    share = most / max(1, known.count())
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(PARTS)) < int(min(1.0, share) * PARTS))
    return texts(docs).join(drawn, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
