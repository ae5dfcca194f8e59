"""A corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token output.

Each stage gets what the one before has written and returns documents, with their
columns; the last returns, for each document of the mix, its place in the token
files and the checksum of its ids, as read back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import base, decontaminate, huffman, mixing, neardup, repetition


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base.prepare(spark)
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base.prepare(spark)
    return neardup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, base.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base.prepare(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    base.prepare(spark)
    return huffman.round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Shingle similarity, apportionment and the tokenizer have no SQL; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
