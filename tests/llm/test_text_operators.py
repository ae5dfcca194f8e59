"""Phrases and alignment against plain versions, over dirty rows."""

from __future__ import annotations

import bisect
import collections
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from usagelens.llm import alignment, base, phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, page long, keys string"


def word(r):
    return "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 5)))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    frequent = [word(r) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "New York\tcity. new  york CITY! ÄPFEL und Äpfel", "a" * 300, "<|endoftext|> <s> </s> <unk> <0x41>", "x▁y z", "tab\there\n\n  two  spaces   nbsp 　 wide"]
    texts += ["naïve café — “quotes” 漢字かな交じり文 emoji 😀👍🏽 עברית العربية", "\x00 nul \x1c \x85 odd", "it's they'll 1234567 3.14 don't", "\n\n\n", "  lead and trail  "]
    for _ in range(240):
        texts.append(". ".join(" ".join(r.choice(frequent) for _ in range(r.randint(1, 14))) for _ in range(r.randint(1, 9))) + r.choice(["", "\n", "?!"]))
    texts += ["of the rings lord of the rings, " * 12, "".join(r.choice("ABCdef123/+") for _ in range(4000)), " ".join(word(r) for _ in range(3000)), "語" * 900 + " end"]
    out = [(i, t, [None, "en", "de"][i % 3], "clash", 0, 0, "clash") for i, t in enumerate(texts)]
    return [*out, out[20], out[20], (None, texts[30], None, "clash", 0, 0, "clash")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    base.prepare(spark)
    return base.saved(spark.createDataFrame(rows, SCHEMA).repartition(3), "test-docs")


def as_rows(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


# --- Phrases ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def by_sql(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows if "\x00" not in (r[1] or "")])
    result = db.execute(phrases.SQL)
    names = [d[0] for d in result.description]
    found = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    return sorted((tuple(x[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in found), key=str)


@pytest.mark.parametrize("bits, page_bytes", [(64, phrases.PAGE_BYTES), (64, 500), (8, 2000), (1, 700)])
def test_phrases_equal_sql_whatever_collides(docs, by_sql, bits, page_bytes):
    clean = docs.filter("text IS NULL OR NOT contains(text, '\\0')")
    assert as_rows(phrases.judge(clean, bits=bits, page_bytes=page_bytes)) == by_sql
    assert len(by_sql) > 50 and {x[0] for x in by_sql} == {"und", "en", "de"}


def plain_collocations(counts, max_words, explained):
    """counts: phrase (tuple of words) -> number, frequent ones only."""
    out = {}
    for p, a in counts.items():
        if len(p) > 1:
            cuts = [((1_000_000 * a * a) // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = [b for q, b in counts.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= explained * a for b in inside):
                out[" ".join(p)] = (a, counts[p[:k]], counts[p[k:]], score)
    return out


def test_phrases_of_four_words(spark):
    texts = ["to be or not to be, that is. to be or not"] * 7 + ["be or not to, or not to be"] * 3
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    counts = collections.Counter()
    for t in texts:
        for piece in t.replace(",", ".").split("."):
            ws = piece.split()
            counts.update(tuple(ws[i : i + n]) for n in range(1, 5) for i in range(len(ws) - n + 1))
    counts = {p: n for p, n in counts.items() if n >= 3}
    want = plain_collocations(counts, 4, 60)
    found = phrases.frequent_phrases(phrases.pages(docs, 64), 3, 4, bits=5)
    assert {(r.phrase, r.a) for r in found.collect()} == {(" ".join(p), n) for p, n in counts.items()}
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in phrases.collocations(found, 4, 60).collect()}
    assert got == want


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.createDataFrame([("en", "a", 1, big + 7), ("en", "b", 1, big + 11), ("en", "a b", 2, big)], phrases.PHRASES)
    (r,) = phrases.collocations(found, 3).collect()
    assert r.score == 1_000_000 * big * big // ((big + 7) * (big + 11))


def test_top_breaks_ties_by_count_and_bytes(spark):
    given = [("x", p, a, 1, 1, s) for p, a, s in (("é b", 5, 9), ("z b", 5, 9), ("a b", 4, 9), ("B c", 5, 9), ("q r", 1, 10))]
    df = spark.createDataFrame(given, "lang string, phrase string, a long, l long, r long, score long")
    assert [r.phrase for r in phrases.top(df, 4).orderBy("rank").collect()] == ["q r", "B c", "z b", "é b"]


def test_parts_lose_nothing():
    text = b"one\ntwo three\n" + b"x" * 50 + b"\nfour"
    for size in (1, 4, 9, 100):
        cut = list(phrases.parts(text, size))
        assert b"".join(cut) == text and all(not p[:1].isalpha() for p in cut[1:])


def test_phrases_of_empty_tables(spark):
    assert phrases.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(1, None, None, "", 0, 0, "")], SCHEMA)
    assert phrases.judge(nothing).collect() == []


# --- Alignment --------------------------------------------------------------------


def letters():
    """The byte-level vocabulary's signs and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_alignment(rows):
    signs, per = letters(), []
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc, text in rows:
        a = first.encode(f" {text}", add_special_tokens=False) if text else None
        a = [(i, bytes(signs[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)] if text else []
        b = [(i, second.id_to_piece(i)) for i in second.encode(text or "")]
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i, p in b]
        if not text or any(b"".join(x for _, x in t) != f" {text}".encode() for t in (a, b)):
            per.append((doc, 0, 0, 0, "", collections.Counter()))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b))
        ends = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in ends]
        for side, (tokens, at) in enumerate(((a, ends_a), (b, ends_b))):
            for (i, _), end in zip(tokens, at, strict=True):
                groups[bisect.bisect_left(ends, end)][side].append(i)
        links = collections.Counter((i, j) for x, y in groups for i in x for j in y)
        text_ = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        per.append((doc, len(a), len(b), len(ends), hashlib.sha256(text_.encode()).hexdigest(), links))
    counts = collections.Counter(k for x in per for k in x[5])
    best = collections.defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = [
        (d, n_a, n_b, n, sum(c.values()), sum(v for k, v in c.items() if counts[k] == best[k[0]]), sum(v * counts[k] for k, v in c.items()), h)
        for d, n_a, n_b, n, h, c in per
    ]
    return sorted(out, key=str)


@pytest.mark.parametrize("size, fan, page_links", [(32 << 10, 8, 1 << 20), (700, 2, 200), (40, 3, 1)])
def test_alignment_equals_plain_version(docs, rows, size, fan, page_links):
    got = as_rows(alignment.judge(docs, size, fan, page_links))
    assert got == plain_alignment([r[:2] for r in rows])
    assert sum(x[1] > 0 for x in got) > 60


def test_a_task_of_alignment_has_one_worker(docs, monkeypatch):
    """Pages are filled where documents are aligned: no Python step feeds another in a task."""
    plans, saved = {}, base.saved

    def watch(df, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return saved(df, name, **options)

    monkeypatch.setattr(base, "saved", watch)
    alignment.judge(docs, 700, 2, 200)
    steps = [len(line) - len(line.lstrip(" :+-")) for line in plans["aligned"] if "MapInArrow" in line]
    assert len(steps) == 2 and steps[0] == steps[1]  # short and long texts, side by side


def test_fragments_compose_in_any_grouping():
    t = alignment.tokenizers()
    r = random.Random(3)
    text = " " + " ".join(r.choice(["Straße", "漢字", "they'll", "x=1;", "naïve…", "tokenizers", "ab\n\ncd"]) for _ in range(60))
    a, b, same = t.both(text)
    assert same
    ends_a, ends_b = np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b])
    whole = alignment.fragment(a, b, ends_a, ends_b, t, True)
    total = len(text.encode())
    opened = 0
    for _ in range(30):
        cuts = sorted({0, total, *(r.randrange(1, total) for _ in range(r.randint(1, 40)))})
        parts = []
        for start, end in zip(cuts, cuts[1:], strict=False):
            own_a, own_b = ((e > start) & (e <= end) for e in (ends_a, ends_b))
            parts.append(alignment.fragment(a[own_a], b[own_b], ends_a[own_a], ends_b[own_b], t, start == 0))
        opened += sum(len(p.tail[0]) + len(p.tail[1]) > 0 for p in parts)
        while len(parts) > 1:  # neighbours in random order, with neutral elements among them
            i = r.randrange(len(parts) - 1)
            parts[i : i + 2] = [alignment.compose([alignment.EMPTY, parts[i], alignment.EMPTY, parts[i + 1]], t)]
        assert alignment.whole(parts[0]) == alignment.whole(whole)
        assert not alignment.compose([parts[0], alignment.INVALID], t).valid
    assert opened > 30  # ranges did end inside groups


def test_ranges_cover_a_text_once():
    data = (" word" * 100 + "x" * 400 + " tail" * 30 + "   b").encode()
    for size in (7, 64, 350, 5000):
        found = alignment.ranges(data, size)
        assert [x[2] for x in found] == [0, *(x[3] for x in found[:-1])] and found[-1][3] == len(data)
        assert all(low <= start < end <= high and alignment.is_cut(data, low) and alignment.is_cut(data, high) for low, high, start, end in found)
    assert len(alignment.ranges(b" " + b"x" * 5000, 100)) == 1


def test_alignment_of_empty_tables(spark):
    assert alignment.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(1, None, None, "", 0, 0, ""), (None, "", None, "", 0, 0, "")], SCHEMA)
    assert as_rows(alignment.judge(nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
