"""Repetitive texts, clashing names, overlapping scans, workers without the package."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from usagelens.llm import base, decontaminate, huffman, mixing, neardup, secrets

SCHEMA = "doc_id long, text string"


def plain_hits(words, items):
    """Mask and items by looking at every place."""
    mask, found = [False] * len(words), set()
    for key, item in items:
        size = min(len(item), decontaminate.WINDOW)
        windows = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
        for i in range(len(words) - size + 1):
            if item and tuple(words[i : i + size]) in windows:
                mask[i : i + size] = [True] * size
                found.add(key)
    return mask, found


def test_automaton_is_linear_on_repetitive_text():
    n = decontaminate.MAX_ITEM_WORDS
    start = time.process_time()
    machine = decontaminate.Automaton([("zeros", [b"0"] * n), ("ab", [b"a", b"b"] * (n // 20)), ("short", [b"0"] * 4)])
    mask, found = machine.hits([b"0"] * n + [b"x"] + [b"a", b"b"] * 50_000)
    assert mask.sum() == 2 * n and found == {"zeros", "ab", "short"}
    assert time.process_time() - start < 60


def test_automaton_equals_plain_version_on_small_alphabets():
    r = random.Random(8)
    for _ in range(150):
        items = [(str(k), [r.choice([b"a", b"b", b"c"]) for _ in range(r.choice([0, 1, 2, 5, 9, 10, 11, 30]))]) for k in range(r.randint(1, 5))]
        machine = decontaminate.Automaton(items)
        for _ in range(4):
            words = [r.choice([b"a", b"b", b"c", b"d"]) for _ in range(r.randint(0, 60))]
            words += r.choice(items)[1]
            mask, found = machine.hits(words)
            assert (mask.tolist(), found) == plain_hits(words, items)


def test_columns_with_the_operators_own_names(spark):
    base.prepare(spark)
    item = "one two three four five six seven eight nine ten eleven twelve"
    benchmark = spark.createDataFrame([(i, f"{item} {i}") for i in range(30)], "item_id long, text string")
    rows = [(1, f"before {item} after and more words that stay here " * 2, 7, "m", "i", "k"), (2, "clean text", 8, "m", "i", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long, __hit_masks string, __HIT_ITEMS string, kept_id string")
    for limit in (decontaminate.MAX_ITEM_WORDS, 50):  # one automaton, several chunks
        cleaned = decontaminate.clean(docs, benchmark, 0.9, limit)
        got = {x.doc_id: x for x in cleaned.collect()}
        assert cleaned.columns == docs.columns and (got[1]["__row"], got[2]["__row"], got[1].kept_id) == (7, 8, "k")
        assert "seven" not in got[1].text and got[2].text == "clean text"
    kept = neardup.deduplicate(docs.unionByName(docs))
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [1, 2]


def test_findings_of_overlapping_scans_count_once(spark, tmp_path):
    base.prepare(spark)
    docs = spark.createDataFrame([(1, 'password = "abcdefghijkl"')], SCHEMA)
    texts = docs.select(F.col("doc_id").alias("path"), "text")
    more = (*secrets.RULES, secrets.Rule("short", "abc", 0, 1))
    secrets.update(texts, f"{tmp_path}/ledger")
    secrets.update(texts, f"{tmp_path}/other", more)
    both = secrets.read_ledger(spark, f"{tmp_path}/ledger").unionByName(secrets.read_ledger(spark, f"{tmp_path}/other"))
    (row,) = secrets.digest(secrets.findings(texts, both)).collect()
    assert row.n_assign == 1 and row.spans.count("assign") == 1


def test_versions_of_one_blob_can_be_split(spark, tmp_path):
    """Both sides of the join come straight from a shuffle, which is what the runtime needs to split a blob that many rows share."""
    docs = spark.createDataFrame([(i, "the same") for i in range(50)], SCHEMA)
    texts = docs.select(F.col("doc_id").alias("path"), "text")
    found = secrets.findings(texts, secrets.update(texts, f"{tmp_path}/ledger"))
    plan = found.hint("merge")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and found.count() == 50


def test_sources_with_several_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 300)
    r = random.Random(6)
    rows = [(i, " ".join("w" * r.randint(1, 5) for _ in range(r.randint(1, 60))), f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.judge(docs).collect()
    for source in range(3):
        own = [x for x in got if x.doc_id % 3 == source]
        assert sum(x.taken for x in own) == pytest.approx(own[0].target, rel=0.02)
        assert all(x.taken <= 2 * x.size for x in own)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.judge(docs).collect()))


def test_pieces_in_use_outlive_a_full_cache(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(huffman, "CACHED_PIECES", 50)
    encode = huffman.encoder(public_tokenizers.path(huffman.TOKENIZER))
    cache = base.worker_state("encoder")[public_tokenizers.path(huffman.TOKENIZER)]
    cache.clear()
    cache.old = {}
    want = {t: cache.whole(t) for t in (f"Größe {i} straße naïve" for i in range(300))}
    assert {t: encode(t) for t in want} == want
    assert len(cache) <= 50 and len(cache.old) <= 50 and "größe".encode() in cache.keys() | cache.old.keys()


ALONE = """
import os, sys
sys.path.insert(0, {repo!r})
from usagelens.llm import alignment, base, decontaminate, huffman, mixing, neardup, phrases, postings, repeats, repetition, secrets, surrogates, urls
from usagelens.session import local_session
spark = local_session("2", 2)
docs = spark.createDataFrame([(i, "some text of words that goes on for a while " + str(i % 3), "en", "s", "http://a.b/c") for i in range(12)], "doc_id long, text string, lang string, source string, url string")
items = docs.selectExpr("doc_id AS item_id", "text").limit(2)
vectors = spark.createDataFrame([(i, [float(i + 1), 2.0]) for i in range(12)], "vec_id long, embedding array<float>")
for make in (lambda: repetition.judge(docs), lambda: secrets.documents_secrets(docs), lambda: mixing.judge(docs), lambda: mixing.mix(docs), lambda: huffman.round_trip(docs), lambda: repeats.deduplicated(docs),
             lambda: decontaminate.judge(docs, items), lambda: neardup.judge(docs), lambda: surrogates.replace(docs), lambda: phrases.judge(docs), lambda: alignment.judge(docs), lambda: postings.judge(vectors)):
    make().collect()
print("all ran")
"""


def test_bucketed_tables_leave_no_name_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = spark.range(2000).select((F.col("id") % 50).alias("page"), "id")
    saved = base.saved_by(rows, "pages", "page")
    assert {t.name for t in spark.catalog.listTables()} == before
    joined = saved.join(rows.groupBy("page").count().hint("merge"), "page")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 2000 and saved.count() == 2000
    assert "SelectedBucketsCount" in plan  # the saved side is read by bucket


def test_workers_need_not_have_the_package(tmp_path):
    """The driver finds the package by its own path, which workers don't get."""
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(repo=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))))
    clean = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
