"""Line deduplication by distinct-site spread.

A HyperLogLog sketch for each line's hash counts the sites (sources) that have it;
sketches merge as they are aggregated, so a line in every document moves a few
kilobytes a task. Where an estimate is within ``NEAR`` standard errors of the
threshold, the line's sites are counted exactly. Lines on ``MIN_SITES`` or more
sites are boilerplate and go from all documents.

Lines are the texts' parts between ``\\n``; those without a word are neither
counted nor removed.

Defined cases: null is the empty text; a null source is no site; a line repeated
in a text counts its site once and goes wherever it stands; repeated rows get the
same result; an empty table gives no rows; extra columns are not read by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm import base

MIN_SITES = 8
SKETCH_BITS = 10
NEAR = 4
WORD = r"[^ \x09-\x0D]"


def text_lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(WORD))


def hashes(docs: DataFrame, *keep: str) -> DataFrame:
    """A row for each distinct line with a word of a document."""
    own = F.array_distinct(F.transform(F.filter(text_lines(), has_word), lambda x: F.xxhash64(x)))
    return docs.select(*keep, F.explode(own).alias("line"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines that at least min_sites sites have."""
    by_site = hashes(docs.filter("source is not null"), "source")
    sketches = by_site.groupBy("line").agg(F.hll_sketch_agg("source", F.lit(SKETCH_BITS)).alias("sketch"))
    counted = sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") > 1)
    counted = base.saved(counted, "spread")
    room = max(1.0, NEAR * 1.04 / 2 ** (SKETCH_BITS / 2) * min_sites)
    near = counted.filter(F.abs(F.col("sites") - min_sites) <= room).select("line")
    exact = by_site.join(near, "line", "left_semi").distinct().groupBy("line").count().filter(F.col("count") >= min_sites)
    far = counted.filter(F.col("sites") > min_sites + room).select("line")
    return base.saved(far.unionByName(exact.select("line")), "boilerplate")


def cleaned(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, the lines of its text that stay (kept) and the numbers of lines with a word and of those removed."""
    found = hashes(docs, "doc_id").join(boilerplate(docs, min_sites), "line", "left_semi")
    own = found.groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    texts = docs.select("doc_id", "text").alias("d")
    joined = texts.join(own.hint("merge").alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")), "left").select("d.doc_id", "d.text", "gone")
    stays = lambda x: ~(has_word(x) & F.coalesce(F.array_contains("gone", F.xxhash64(x)), F.lit(False)))
    every = text_lines()
    table = joined.select("doc_id", F.filter(every, stays).alias("kept"), F.size(F.filter(every, has_word)).cast("long").alias("n_lines"), F.size(every).alias("n"))
    return table.withColumn("n_removed", (F.col("n") - F.size("kept")).cast("long")).drop("n")


def judge(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    table = cleaned(docs, min_sites)
    return table.select("doc_id", "n_lines", "n_removed", F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


SQL = rf"""
WITH lines AS (
    SELECT DISTINCT source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents WHERE source IS NOT NULL
), boilerplate AS (
    SELECT line FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), gone AS (
    SELECT coalesce(list(line), []) AS all_lines FROM boilerplate
), texts AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS every FROM documents
)
SELECT doc_id,
    CAST(len(list_filter(every, lambda x: regexp_matches(x, '{WORD}'))) AS BIGINT) AS n_lines,
    CAST(len(every) - len(list_filter(every, lambda x: NOT list_contains(all_lines, x))) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_filter(every, lambda x: NOT list_contains(all_lines, x)), chr(10))) AS kept_sha256
FROM texts, gone
"""
