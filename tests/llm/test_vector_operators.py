"""Nearest neighbours against brute force, with dirty rows."""

from __future__ import annotations

import numpy as np
import pytest

from usagelens.llm import base, postings

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, list int, query string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 0, "clash") for i, v in rows], SCHEMA).repartition(3)


def brute_force(rows, every=100, k=10):
    """Of distinct rows that take part: the k nearest to each query, by distance, then id."""
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    sizes = [len(v) for i, v in rows if usable(i, v)]
    common = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    kept = sorted({(i, tuple(np.array(v, np.float32).tolist())) for i, v in rows if usable(i, v) and len(v) == common})
    ids, vectors = np.array([i for i, _ in kept]), np.array([v for _, v in kept], np.float64).reshape(len(kept), max(1, common))
    out = {}
    for q, (i, v) in enumerate(kept):
        if i % every == 0:
            d = np.sqrt(((vectors - np.array(v)) ** 2).sum(1))
            order = [x for x in np.lexsort((ids, d)) if x != q][:k]
            out.setdefault(i, []).append([(int(ids[x]), float(d[x])) for x in order])
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(got, want):
    hits = [len({v for _, v, _ in got.get(q, [])} & {i for i, _ in w[0]}) / max(1, len(w[0])) for q, w in want.items()]
    return sum(hits) / len(hits)


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(postings, "LIST_ROWS", 64)
    monkeypatch.setattr(postings, "PART_ROWS", 50)
    monkeypatch.setattr(postings, "QUERY_ROWS", 7)
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 24))
    flat = [(i, r.normal(size=24).tolist()) for i in range(2000)]
    clumps = [(2000 + i, (centres[i % 12] + 0.05 * r.normal(size=24)).tolist()) for i in range(2000)]
    rows = flat + clumps
    got, want = found(postings.judge(table(spark, rows), every=20)), brute_force(rows, 20)
    assert set(got) == set(want) and all([x[0] for x in g] == list(range(1, 11)) for g in got.values())
    assert recall(got, want) >= 0.9
    exact = {q: dict(w[0]) for q, w in want.items()}
    for q, g in got.items():
        assert [(s, v) for _, v, s in g] == sorted((s, v) for _, v, s in g)
        assert all(abs(exact[q][v] - s) < 1e-12 for _, v, s in g if v in exact[q])


def test_dirty_rows_and_ties(spark):
    r = np.random.default_rng(2)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot) for i in range(0, 400)]  # a third of all rows are equal
    rows += [(1000 + i, r.normal(size=3).round(1).tolist()) for i in range(300)]
    rows += [(5000, None), (5100, [0.0, 0.0, 0.0]), (5200, [1.0, None, 2.0]), (5300, [1.0, float("nan"), 2.0]), (5400, [float("inf"), 1.0, 1.0])]
    rows += [(None, [9.0, 9.0, 9.0]), (5500, [1.0, 2.0]), (5600, []), (100, hot), (100, hot), (1000, [5.0, 5.0, 5.0]), (-100, [0.5, 0.5, 0.5])]
    want = brute_force(rows)
    got = {}
    for x in postings.judge(table(spark, rows)).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    assert set(got) == set(want) == {-100, 0, 100, 200, 300, 1000, 1100, 1200}
    for q, lists in want.items():
        parts = sorted(got[q], key=lambda x: x[0])
        assert sorted((v, round(s, 9)) for _, v, s in parts) == sorted((i, round(s, 9)) for w in lists for i, s in w)
    assert [v for _, v, _ in sorted(got[200])] == list(range(10))  # ties go to the smaller id


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_few_candidates(spark, n):
    rows = [(100 * i, [float(i + 1), 1.0]) for i in range(n)]
    got, want = found(postings.judge(table(spark, rows))), brute_force(rows)
    assert {q: [(v, s) for _, v, s in g] for q, g in got.items()} == {q: w[0] for q, w in want.items() if w[0]}


def test_search_with_queries_of_their_own(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=4).tolist()) for i in range(200)]
    asked = [(7, r.normal(size=4).tolist())]
    got = found(postings.search(table(spark, rows), table(spark, asked), k=3))
    d = sorted((float(np.sqrt(((np.array(v, np.float32).astype(float) - np.array(asked[0][1], np.float32).astype(float)) ** 2).sum())), i) for i, v in rows)[:3]
    assert [(v, pytest.approx(s)) for _, v, s in got[7]] == [(i, s) for s, i in d]


def test_splits_are_balanced():
    r = np.random.default_rng(3)
    skewed = np.concatenate((r.normal(size=(900, 6)) * 0.01, r.normal(size=(100, 6)) + 5)).astype(np.float32)
    part = postings.split(skewed, 8, 5)
    assert set(np.bincount(part, minlength=8)) == {125}
    assert len(postings.fit(skewed, 16)) == 16
    assert len(postings.fit(np.ones((50, 3), np.float32), 8)) == 1  # equal rows have one centroid


def test_graph_search_finds_what_is_in_range():
    r = np.random.default_rng(5)
    graph = postings.Graph.of(r.normal(size=(700, 8)).astype(np.float32))
    vectors = r.normal(size=(60, 8)).astype(np.float32)
    true = postings.squared(vectors, graph.centroids)
    seen = total = 0
    for row, (at, far) in zip(true, graph.search(vectors, 1.3, 3, 5), strict=True):
        limit = max(1.3**2 * np.sort(row)[2], np.sort(row)[4])
        inside = set(np.flatnonzero(row <= limit).tolist())
        assert set(at.tolist()) <= inside | {int(x) for x in at[np.isclose(far, limit, rtol=1e-4)]} and list(far) == sorted(far)
        seen, total = seen + len(inside & set(at.tolist())), total + len(inside)
    assert seen >= 0.99 * total


def test_every_vector_is_in_a_list(spark, monkeypatch):
    monkeypatch.setattr(postings, "LIST_ROWS", 20)
    r = np.random.default_rng(6)
    rows = base.saved(postings.usable(table(spark, [(i, r.normal(size=5).tolist()) for i in range(500)])), "v")
    entries = postings.entries(rows, 11)
    graph = postings.index(entries)
    kind = "list long, first boolean, entry long, vector array<double>, ids array<long>"
    placed = postings.listed(entries, graph, postings.assign, kind).collect()
    assert sorted(x.entry for x in placed if x.first) == list(range(500))
    assert 500 < len(placed) <= postings.REPLICAS * 500
