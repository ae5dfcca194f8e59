"""Quality rules with suffix-array repetition.

Each text is a string of words. A suffix array over its words, with the longest
common prefix (LCP) of neighbours, gives the LCP intervals, and those the maximal
repeated substrings. The deepest interval that holds the suffix at word i has the
LCP ``reach[i]``, the longest repeat that starts there; shorter repeats at i lie
inside it. So the union of the spans ``[i, i + reach[i])`` with a reach of at
least ``min_repeat`` is the union of all occurrences of maximal repeats.

A text is rejected by the base rules (too few words, too many words in repeated
3-word windows), or if the repeats cover more than ``max_fraction`` of it, or if
the longest is over ``max_repeat`` words.

Defined cases: null and empty texts have no words and fail the base rules; the
result has a row for every input row, also for repeated ones; extra columns are
ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from usagelens.llm import base

MIN_WORDS = 50
WINDOW = 3
MAX_WINDOW_PERCENT = 50
MIN_REPEAT = 10
MAX_FRACTION = 0.3
MAX_REPEAT = 200

# Texts are taken together up to so many words; a longer text is taken alone.
CHUNK_WORDS = 200_000

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_covered_words long, longest_repeat long"
)
SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"


def word_ids(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = defaultdict(itertools.count().__next__)
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def reaches(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word the length of the longest repeat, within its text, that starts there.

    words: ids; text: the number of the text that each word belongs to, ascending.
    Ranks by the first 2^k words come from prefix doubling, in which only suffixes
    that still share their rank are sorted again. Texts have words of their own, so
    no match crosses a text's end.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    rank = np.unique(text * (words.max() + 1) + words, return_inverse=True)[1].astype(np.int64)
    counts = np.bincount(rank)
    rank = (np.cumsum(counts) - counts)[rank]  # a group's rank is its first place in the suffix array
    levels, h = [rank], 1
    active = np.flatnonzero(counts[np.searchsorted(np.cumsum(counts), rank, "right")] > 1)
    while len(active):
        after = active + h
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.lexsort((follow, rank[active]))
        at, first, second = active[order], rank[active][order], follow[order]
        new_group = np.concatenate(([True], first[1:] != first[:-1]))
        new_part = new_group | np.concatenate(([True], second[1:] != second[:-1]))
        place = np.arange(len(at))
        group_start = np.maximum.accumulate(np.where(new_group, place, 0))
        part_start = np.maximum.accumulate(np.where(new_part, place, 0))
        rank = rank.copy()
        rank[at] = first + part_start - group_start
        levels.append(rank)
        part = np.cumsum(new_part) - 1
        active = at[np.bincount(part)[part] > 1]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]])
    a, b = suffixes[near].copy(), suffixes[near + 1].copy()
    length = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside.copy()
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = same * (1 << k)
        length, a, b = length + step, a + step, b + step
    lcp[near + 1] = length
    return np.maximum(lcp[rank], lcp[rank + 1])


def covered(reach: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Mask of the union of ``[i, i + spans[i])`` where reach[i] is not 0."""
    place = np.arange(len(reach))
    return np.maximum.accumulate(np.where(reach > 0, place + spans, 0)) > place if len(reach) else np.zeros(0, bool)


def measure(texts: list[bytes], min_repeat: int) -> dict[str, np.ndarray]:
    """Words, words in repeated windows, words under repeats and the longest repeat of each text."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    out = {k: np.zeros(len(texts), np.int64) for k in ("window", "covered", "longest")}
    start = 0
    while start < len(texts):
        end, total = start + 1, sizes[start]
        while end < len(texts) and total + sizes[end] <= CHUNK_WORDS:
            total, end = total + sizes[end], end + 1
        if total:
            own = sizes[start:end]
            text = np.repeat(np.arange(end - start), own)
            reach = reaches(word_ids(list(itertools.chain.from_iterable(split[start:end]))), text)
            window = covered(np.where(reach >= WINDOW, reach, 0), np.full(len(reach), WINDOW))
            long = np.where(reach >= min_repeat, reach, 0)
            out["window"][start:end] = np.bincount(text, window, len(own))
            out["covered"][start:end] = np.bincount(text, covered(long, long), len(own))
            np.maximum.at(out["longest"], start + text, reach)
        start = end
    return out | {"words": sizes}


def repeat_spans(text: str, min_repeat: int = MIN_REPEAT) -> list[tuple[int, int]]:
    """The united spans of maximal repeats, in words from start to end."""
    ids = word_ids(text.encode().split())
    reach = reaches(ids, np.zeros(len(ids), np.int64))
    long = np.where(reach >= min_repeat, reach, 0)
    return [(int(a), int(b)) for a, b in zip(*base.spans_of(covered(long, long)), strict=True)]


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _columns(batch: pa.RecordBatch, min_repeat: int, max_fraction: float, max_repeat: int) -> list:
    texts = [x or "" for x in batch.column("text").to_pylist()]
    m = measure([t.encode() for t in texts], min_repeat)
    failed = (m["words"] < MIN_WORDS) | (100 * m["window"] > MAX_WINDOW_PERCENT * m["words"])
    kept = ~failed & (m["covered"] <= max_fraction * m["words"]) & (m["longest"] <= max_repeat)
    return [
        m["words"],
        [len(t) - sum(map(t.count, SPACES)) for t in texts],
        [sum(map(t.count, SYMBOLS)) for t in texts],
        [duplicate_lines(t) for t in texts],
        m["window"],
        failed,
        kept,
        m["covered"],
        m["longest"],
    ]


def judge(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_fraction: float = MAX_FRACTION, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: the base figures, the repeats' figures and the verdict."""

    def make():
        return lambda batch: [batch.column("doc_id"), *_columns(batch, min_repeat, max_fraction, max_repeat)]

    return base.map_batches(docs.select("doc_id", "text"), make, SCHEMA)


def keep_good(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_fraction: float = MAX_FRACTION, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_columns(batch, min_repeat, max_fraction, max_repeat)[6]))

    return docs.mapInArrow(run, docs.schema)
