"""The training-corpus pipeline: documents in, packed sequences out.

Each stage takes the documents that the one before it kept, does its work on
all of them, and returns a frame with the columns of documents (the last one:
packed pieces). Between stages the rows are written as Parquet to the shared
checkpoint folder and read again, so a stage never runs twice and a lost
executor costs no more than its own tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from landfall.llm import exact, near, packing, passages, quality
from landfall.llm.common import read, staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (learned from ``labels``) accepts."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return exact.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the least id."""
    return near.drop_near(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that stand elsewhere first."""
    return passages.cut_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_copies), ("MinHash near-dedup", drop_near),
          ("suffix-array dedup", cut_repeats), ("packing", pack)]

#: Not expressible in SQL (learned rules, similarity groups, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = staged(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows
