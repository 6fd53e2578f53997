"""Bounded, repeatable samples of labelled documents for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound of every training sample, in documents.
SAMPLE_ROWS = 20_000


def held_out(parts: int, part: int) -> Column:
    """Whether a row is outside the training fold: crc32 of the id as text, modulo ``parts``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def label_sample(labels: DataFrame, label: str, parts: int, part: int, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``most`` (doc_id, label) rows of the training fold, by hash; a doc_id labelled twice is its smaller label."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(parts, part))
    each = told.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("double").alias("label"))
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def training_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text and label of the sampled documents. The sample has at most its bound of rows, so it is broadcast."""
    return docs.join(F.broadcast(sample), "doc_id")
