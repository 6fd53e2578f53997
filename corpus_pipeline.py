"""A training-data pipeline: each stage works on what the one before kept, written as Parquet in between.

Defined results: a null text is empty; empty texts are equal, so one of them stays, and it has no tokens; a null doc_id counts
as largest among equal texts and is never a near copy; without labels of both kinds nothing is toxic; an empty benchmark
drops nothing; further columns of documents, whatever their names, stay until the last stage; an empty table gives an empty
result.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tenderline.llm.bpe import token_digests
from tenderline.llm.common import read_table, shared_folder
from tenderline.llm.decontaminate import drop_contaminated
from tenderline.llm.exact import drop_copies
from tenderline.llm.jaccard import one_of_each
from tenderline.llm.toxicity import drop_toxic

TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the smallest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is connected by a similarity of 0.8 or more on five-word shingles."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens and the digests of ids and decoded text."""
    return token_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# A learned stage and a similarity join cannot be said in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(shared_folder(spark), f"stage-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
