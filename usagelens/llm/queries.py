"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import alignment, base, decontaminate, huffman, lines, mixing, neardup, phrases, postings, repeats, repetition, secrets, surrogates, urls


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.documents_secrets(base.table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(base.table(spark, sf_dir, "documents"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(base.table(spark, sf_dir, "pages"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(base.table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.judge(base.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(base.table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicated(base.table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "benchmark"))


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judge(base.table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.judge(base.table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.judge(base.table(spark, sf_dir, "documents"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.judge(base.table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.judge(base.table(spark, sf_dir, "documents"))


QUERIES = [
    op1_secrets,
    op2_quality,
    op3_urls,
    op4_surrogates,
    op5_mixing,
    op6_tokens,
    op7_repeats,
    op8_decontamination,
    op9_line_spread,
    op10_near_duplicates,
    op11_phrases,
    op12_neighbours,
    op13_alignment,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op9_line_spread": lines.SQL, "op11_phrases": phrases.SQL}
