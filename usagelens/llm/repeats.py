"""Deduplication of repeated bytes by prefix-free parsing and hashed windows.

The parse is that of prefix-free suffix sorting; the suffix arrays of dictionary and
parse, and their merge into corpus order, are not built. Which strings repeat, and in
which smallest document, needs equal strings side by side, not their order, so keys of
8 bytes are shuffled where sorted suffixes would carry SIZE bytes each.

A byte goes if a ``SIZE``-byte string that covers it also starts in a document with
a smaller id. Three rounds find these strings in the whole corpus; in each, pages
of documents put distinct keys with the smallest document that holds them, and get
a byte back for each key (see base.answers).

1. *Parse.* A rolling hash of ``SIZE - 1`` bytes sets triggers, and a phrase runs
   from one trigger to the end of the next. Neighbours overlap by the trigger, so
   each SIZE-byte string lies in one phrase, and phrases are the same wherever the
   text is. The dictionary has each phrase once; its owner is the smallest document
   that holds it. In all others, all of its strings go. So the work that follows is
   on the dictionary, however often the corpus repeats it.
2. *Filter.* Suffixes of dictionary phrases that share SIZE bytes share the
   smallest hash of their first ``SIZE - ANCHOR + 1`` ANCHOR-byte strings. Strings
   whose smallest hash only one document's phrases have are in that document only.
3. *Compare.* The strings that are left are sorted by their key, which is a hash, and
   those with a key that a smaller document has go.

Keys are 64-bit hashes of the bytes; two different strings have the same key with
a chance of 2^-64 (the 32 bits of round 2 only filter).

Defined cases: null is the empty text; texts shorter than SIZE keep all; rows that
share an id don't take from one another; a null id counts as the largest; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from usagelens.llm import base

SIZE = 50
ANCHOR = 24
GAP = 64  # bytes between triggers, on average
PAGE_BYTES = 1 << 19

PAGES = "page long, doc_ids array<long>, sizes array<long>, data binary"
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
LAST = np.iinfo(np.int64).max


def paged(docs: DataFrame) -> DataFrame:
    """Documents packed into pages of about PAGE_BYTES; a longer document has a page alone."""
    types = base.arrow_schema(StructType.fromDDL(PAGES))

    def run(batches):
        ids, texts, size, count = [], [], 0, 0

        def page():
            return base.record_batch([[base.page_number(count)], [ids], [list(map(len, texts))], [b"".join(texts)]], types)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), base.text_bytes(batch), strict=True):
                if ids and size + len(text) > PAGE_BYTES:
                    yield page()
                    ids, texts, size, count = [], [], 0, count + 1
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if ids:
            yield page()

    return docs.select("doc_id", "text").mapInArrow(run, StructType.fromDDL(PAGES))


class Page:
    """The strings of a page. Positions are those where a string of SIZE bytes starts inside its document."""

    def __init__(self, row: dict):
        self.number, self.ids = row["page"], row["doc_ids"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.raw = row["data"]
        self.doc_ids = np.array([LAST if x is None else x for x in self.ids], np.int64)
        self.rolling = base.Rolling(np.frombuffer(self.raw, np.uint8))
        self.last = np.repeat(self.ends - SIZE, self.sizes)  # of the document at each byte: its last position
        self.inside = np.arange(len(self.last)) <= self.last
        self.doc = np.repeat(self.doc_ids, self.sizes)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each phrase with a string in it."""
        cut = np.zeros(len(self.inside), bool)
        trigger = self.rolling.windows(SIZE - 1) % np.uint64(GAP) == 0
        cut[: len(trigger)] = trigger
        cut[self.starts[self.sizes > 0]] = True
        starts = np.flatnonzero(cut & self.inside)
        following = np.append(starts[1:], len(cut)) + SIZE - 1
        return starts, np.minimum(following, self.last[starts] + SIZE)

    def smallest(self) -> np.ndarray:
        """By position, the smallest hash of the ANCHOR-byte strings in its string."""
        low = self.rolling.windows(ANCHOR)
        n, width = SIZE - ANCHOR + 1, 1
        while 2 * width <= n:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[: len(low) - (n - width)], low[n - width :]) if n > width else low


def firsts(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted; the smallest document of each; for each input its key's number."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(begins)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(begins) - 1
    return ordered[first], np.minimum.reduceat(docs[order], first) if len(first) else docs, number


def _earlier(group: np.ndarray, first: np.ndarray, more: bytes) -> np.ndarray:
    """1 for entries whose key has a smaller document on another page."""
    docs = np.frombuffer(more, "<i8")
    return (np.minimum.reduceat(docs, first)[group] < docs).astype(np.uint8)


def _shared(group: np.ndarray, first: np.ndarray, more: bytes) -> np.ndarray:
    """1 for entries whose key several documents have."""
    several = np.maximum.reduceat(np.frombuffer(more, np.uint8), first) | (np.diff(np.append(first, len(group))) > 1)
    return several.astype(np.uint8)[group]


def parse(page: Page):
    """Round 1: phrase keys, their smallest documents, and the phrases."""
    starts, ends = page.phrases()
    keys, docs, number = firsts(page.rolling(starts, ends), page.doc[starts])
    return keys, docs, (starts, number)


def owned(page: Page, told: np.ndarray) -> np.ndarray:
    """By byte: a position in a phrase that its document owns."""
    keys, docs, (starts, number) = parse(page)
    own = (told[number] == 0) & (page.doc[starts] == docs[number])
    spread = np.zeros(len(page.inside), bool)
    if len(starts):
        spread = np.repeat(own, np.diff(np.append(starts, len(spread))))
        spread = np.concatenate((np.zeros(len(page.inside) - len(spread), bool), spread))
    return spread & page.inside


def anchors(page: Page, own: np.ndarray):
    """Round 2: keys of the owned strings' anchors, whether several documents of the page have them, and the strings' key numbers."""
    at = np.flatnonzero(own)
    low = page.smallest()[at]
    turn = np.concatenate(([True], (low[1:] != low[:-1]) | (page.doc[at[1:]] != page.doc[at[:-1]]))) if len(at) else np.zeros(0, bool)
    head = np.flatnonzero(turn)
    keys, docs, number = firsts(low[head], page.doc[at[head]])
    several = np.zeros(len(keys), np.uint8)
    several[number[page.doc[at[head]] != docs[number]]] = 1
    return keys, several, (at, number[np.cumsum(turn) - 1] if len(at) else number)


def strings(page: Page, own: np.ndarray, told: np.ndarray):
    """Round 3: keys of the owned strings with shared anchors, and their smallest documents."""
    at, number = anchors(page, own)[2]
    at = at[told[number] == 1]
    keys, docs, number = firsts(page.rolling.windows(SIZE)[at], page.doc[at])
    return keys, docs, (at, number)


def remove(page: Page, own: np.ndarray, told: np.ndarray, late: np.ndarray) -> list[tuple]:
    """What goes from each document of the page."""
    hit = page.inside & ~own
    _, docs, (at, number) = strings(page, own, told)
    hit[at[(late[number] == 1) | (page.doc[at] > docs[number])]] = True
    place = np.arange(len(hit))
    gone = np.maximum.accumulate(np.where(hit, place + SIZE, 0)) > place if len(hit) else hit
    raw, out = np.frombuffer(page.raw, np.uint8), []
    for doc, a, b in zip(page.ids, page.starts.tolist(), page.ends.tolist(), strict=True):
        own_gone = gone[a:b]
        spans = int(np.count_nonzero(own_gone[1:] & ~own_gone[:-1])) + int(b > a and own_gone[0])
        out.append((doc, b - a, int(own_gone.sum()), spans, sha256(raw[a:b][~own_gone].tobytes()).hexdigest()))
    return out


def _rows(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        answers = [base.answer_bytes(row[f"answers_{k}"]) for k in range(3) if f"answers_{k}" in row]
        yield Page(row), answers


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: its bytes, those removed, their runs, and a digest of the rest."""
    pages = base.saved_by(paged(docs), "pages", "page")
    n = base.parts(docs.sparkSession)

    def ask(batch, keys_of, width):
        rows = [x for page, told in _rows(batch) for x in base.ask(page.number, *keys_of(page, told), n, width)]
        return list(map(list, zip(*rows, strict=True))) or [[]]

    def asked(table, keys_of, width=8):
        return base.map_batches(table, lambda: lambda batch: ask(batch, keys_of, width), base.ASKED)

    def told(table, k):
        return table.withColumnRenamed("answers", f"answers_{k}")

    first = base.answers(asked(pages, lambda page, _: parse(page)[:2]), _earlier, "<u8", "phrases")
    with_first = pages.join(told(first, 0), "page", "left")
    second = base.answers(asked(with_first, lambda page, told: anchors(page, owned(page, told[0]))[:2], 4), _shared, "<u4", "anchors")
    with_second = with_first.join(told(second, 1), "page", "left")
    third = base.answers(asked(with_second, lambda page, told: strings(page, owned(page, told[0]), told[1])[:2]), _earlier, "<u8", "strings")
    with_third = with_second.join(told(third, 2), "page", "left")

    def act(batch):
        rows = [x for page, (a, b, c) in _rows(batch) for x in remove(page, owned(page, a), b, c)]
        return list(map(list, zip(*rows, strict=True))) or [[]]

    return base.map_batches(with_third, lambda: act, REMOVED)
