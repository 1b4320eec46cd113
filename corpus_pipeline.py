"""A training-data pipeline: quality, near duplicates, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; the last one returns packed
pieces with their token ids.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from cadastra.llm import mixing, ngram_join, packing, pii, resampling, tokens
from cadastra.operators.materialize import materialize

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling (9): documents that the sample leaves out go."""
    return resampling.resample(docs, spark.read.parquet(os.path.join(sf_dir, "labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): one document of each group stays."""
    return ngram_join.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Candidate boosting (3): found spans are replaced by their kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Efraimidis-Spirakis mixing (2): documents repeat as often as the mix takes them."""
    return mixing.apply(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two packing (7): pieces with token ids, each a sequence."""
    return packing.pack(docs, tokens.public_path(TOKENIZER), end_id=END_ID)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("pack", pack),
]

#: SQL cannot express the tokenizer, the boosted trees or the sampled quality model
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
