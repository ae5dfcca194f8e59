"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one suffix automaton. Documents
stream through it: after each word the automaton's state and length give the
longest run of words ending there that also occurs in an item. A length of
``WINDOW`` or more means that a whole window of an item ends there; an item of
fewer words must match whole. The words of such matches are hit.

Before the automaton, word pairs are looked up in the sorted pairs of the items:
a run of document words whose pairs do not all occur in items can't hold a
window. Only runs that pass are streamed.

Tasks build the automata. A benchmark of up to ``MAX_ITEM_WORDS`` words goes to them
with their code; that bounds what passes through the driver. The items of a larger one
are dealt by their hash to chunks of about half as many words. Hashes of item windows,
and of short items whole, are joined with those of the documents' windows by shuffle;
a chunk's automaton then sees only documents that share a hash with it, and confirms
them on their words. Documents are written once, whatever the number of chunks, and a
chunk that many of them meet is dealt to several tasks.

Defined cases: null and empty texts have no words and no hits; items without words
are ignored; repeated rows are judged each on its own; repeated items count once
by their id; an empty benchmark hits nothing; extra columns are kept by ``clean``.
"""

from __future__ import annotations

import itertools
import math
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from usagelens.llm import base

WINDOW = 10
MAX_ITEM_WORDS = 100_000
# Documents with more than this fraction of their words hit are dropped by clean.
MAX_FRACTION = 0.5
# Documents that one task holds against a chunk, on average at most.
CHUNK_DOCS = 20_000
# Columns that carry the row's number, and the hits of all chunks where there are several; longer names where a table has these.
ROW, CARRIED = "__row", ("__hit_masks", "__hit_items")
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

# A-Z become a-z; a-z, 0-9 and all bytes of other characters stay; the rest is space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton of word-id sequences, by online extension."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(key, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for key, words in items if words]
        for _, ids in sequences:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # By state: of the suffixes of its words, the state of that of WINDOW words, and the longest that ends a whole short item.
        self.window_at, self.short_at = [-1] * len(self.next), [-1] * len(self.next)
        ends = [self._end(ids) for _, ids in sequences]
        self.short: dict[int, list[tuple[int, object]]] = {}  # whole short items by state: their length and id
        for (key, ids), state in zip(sequences, ends, strict=True):
            if len(ids) < WINDOW:
                self.short.setdefault(state, []).append((len(ids), key))
        for at in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[at]
            if self.length[at] >= WINDOW:
                self.window_at[at] = at if self.length[up] < WINDOW else self.window_at[up]
            self.short_at[at] = at if at in self.short else self.short_at[up]
        self.items: dict[int, set] = {}  # by the state of a window: the items that it occurs in
        for key, ids in sequences:
            state = 0
            for c in ids:
                state = self.next[state][c]
                if self.window_at[state] > 0:
                    self.items.setdefault(self.window_at[state], set()).add(key)
        self.least = min([WINDOW, *(len(ids) for _, ids in sequences)])
        size = max(1, len(self.vocabulary))
        self.pairs = np.unique(np.array([a * size + b for _, ids in sequences for a, b in itertools.pairwise(ids)], np.int64))

    def _end(self, ids: list[int]) -> int:
        state = 0
        for c in ids:
            state = self.next[state][c]
        return state

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            q = self.next[at][c]
            self.link[new] = q if self.length[q] == self.length[at] + 1 else self._split(at, c, q)
        return new

    def _state(self, length: int, following: dict[int, int], link: int = 0) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, c: int, q: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while at >= 0 and self.next[at].get(c) == q:
            self.next[at][c] = copy
            at = self.link[at]
        return copy

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of words (unknown: -1) that may hold a window."""
        if not len(self.vocabulary) or len(ids) < self.least:
            return []
        known = ids >= 0
        pair = ids[:-1] * len(self.vocabulary) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        linked = known[:-1] & known[1:] & (self.pairs[at] == pair if len(self.pairs) else False)
        # A stretch is a maximal run of known words in which all neighbours are pairs of items.
        breaks = np.concatenate(([True], ~linked, [True]))
        edges = np.flatnonzero(breaks)
        fit = (np.diff(edges) >= self.least) & known[edges[:-1]]
        return [(int(a), int(b)) for a, b in zip(edges[:-1][fit], edges[1:][fit], strict=True)]

    def matches(self, ids: list[int], offset: int):
        """Yields (start, end, items) of each window or whole short item that ends at a word: a bounded number a word."""
        state, length = 0, 0
        for i, c in enumerate(ids, offset + 1):
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            if length >= WINDOW:
                yield i - WINDOW, i, self.items[self.window_at[state]]
            at = self.short_at[state]
            while at > 0:
                for size, key in self.short[at]:
                    if size <= length:
                        yield i - size, i, {key}
                at = self.short_at[self.link[at]]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Mask of the hit words, and the items that hit them."""
        mask, found = np.zeros(len(words), bool), set()
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
        for a, b in self.runs(ids):
            for start, end, items in self.matches(ids[a:b].tolist(), a):
                mask[start:end] = True
                if not items <= found:
                    found |= items
        return mask, found


def items_of(benchmark: DataFrame) -> DataFrame:
    """Distinct items that have words: id, normalised words, and their size in words of 64 bytes at most."""

    def act(batch: pa.RecordBatch) -> list:
        words = [words_of(t) for t in base.text_bytes(batch)]
        joined = [b" ".join(w) for w in words]
        return [batch.column("item"), joined, list(map(len, words)), [max(len(w), -(-len(t) // 64)) for w, t in zip(words, joined, strict=True)]]

    items = base.map_batches(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"), lambda: act, "item string, words binary, n_words long, size long")
    return base.saved(items.filter("n_words > 0").distinct(), "items")


def machine_of(items: list[tuple[str, bytes]] | None) -> Automaton | None:
    """The automaton of items; a Python worker keeps the last one."""
    if items is None:
        return None
    state, key = base.worker_state("automaton"), tuple(items)
    if state.get("key") != key:
        state.update(key=key, machine=Automaton([(item, words.split()) for item, words in items]))
    return state["machine"]


def window_hashes(words: list[bytes], lengths: list[int]) -> np.ndarray:
    """Distinct hashes of all windows of so many words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    rolling, starts = base.Rolling(np.frombuffer(b" ".join(words), np.uint8)), ends - sizes
    found = [rolling(starts[: len(words) - n + 1], ends[n - 1 :]) for n in lengths if n <= len(words)]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *found])).view(np.int64)


def _hashed(batch: pa.RecordBatch, number: str, lengths: list[int] | None) -> list:
    """Numbers of rows with the hashes of their windows; without lengths those of an item."""
    numbers, out = [], []
    for n, text in zip(batch.column(number).to_pylist(), base.text_bytes(batch), strict=True):
        if words := words_of(text):
            out.append(window_hashes(words, lengths or [min(WINDOW, len(words))]))
            numbers.append(np.full(len(out[-1]), n, np.int64))
    return [pa.array(np.concatenate(x)) for x in (numbers, out)] if out else [[], []]


def _by_chunk(batches):
    """Row, hit mask and items of documents that come after the items of their chunk."""
    key, items, machine = None, [], None
    for batch in batches:
        out = []
        for chunk, part, item, row, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (chunk, part) != key:
                key, items, machine = (chunk, part), [], None
            if row is None:
                items.append((item, data.split()))
                continue
            machine = machine or Automaton(items)
            mask, found = machine.hits(words_of(data))
            if mask.any():
                out.append((row, np.packbits(mask).tobytes(), sorted(x for x in found if x is not None)))
        if out:
            rows, masks, found = map(list, zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(masks, pa.binary()), pa.array(found, pa.list_(pa.string()))], ["row", "mask", "items"])


def own_names(columns: list[str]) -> tuple[str, str, str]:
    """ROW and CARRIED, made longer until no column has such a name."""
    names = (ROW, *CARRIED)
    while {x.lower() for x in names} & {x.lower() for x in columns}:
        names = tuple(f"{x}_" for x in names)
    return names


def _chunked(docs: DataFrame, items: DataFrame, chunks: int) -> DataFrame:
    """docs with what all chunks of the items hit in them."""
    row_, masks_, items_ = own_names(docs.columns)
    items = base.saved(items.withColumn("chunk", F.pmod(F.xxhash64("item", "words"), F.lit(chunks)).cast("int")), "chunks")
    lengths = sorted(x[0] for x in items.select(F.least("n_words", F.lit(WINDOW))).distinct().collect())
    numbered = base.saved(docs.withColumn(row_, F.monotonically_increasing_id()), "numbered")
    asked = base.map_batches(items.select("chunk", F.col("words").alias("text")), lambda: lambda x: _hashed(x, "chunk", None), "chunk int, hash long").distinct()
    there = base.map_batches(numbered.select(F.col(row_).alias(ROW), "text"), lambda: lambda x: _hashed(x, ROW, lengths), f"{ROW} long, hash long")
    pairs = base.saved(there.join(asked, "hash").select(ROW, "chunk").distinct(), "candidates")
    parts = pairs.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK_DOCS).cast("int").alias("parts"))
    texts = numbered.select(F.col(row_).alias(ROW), F.col("text").cast("binary").alias("data")).join(pairs.join(parts, "chunk"), ROW)
    met = texts.select("chunk", F.pmod(F.xxhash64(ROW), F.col("parts")).cast("int").alias("part"), F.lit(None).cast("string").alias("item"), F.col(ROW).alias("row"), "data")
    own = items.join(parts, "chunk").select("chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "item", F.lit(None).cast("long").alias("row"), F.col("words").alias("data"))
    dealt = own.unionByName(met).repartition(base.parts(docs.sparkSession), "chunk", "part").sortWithinPartitions("chunk", "part", F.col("row").asc_nulls_first())
    hits = base.saved(dealt.mapInArrow(_by_chunk, "row long, mask binary, items array<string>"), "hits")
    by_row = hits.groupBy(F.col("row").alias(row_)).agg(F.collect_list("mask").alias(masks_), F.array_distinct(F.flatten(F.collect_list("items"))).alias(items_))
    return numbered.join(by_row, row_, "left").drop(row_)


def _prepared(docs: DataFrame, benchmark: DataFrame, max_words: int) -> tuple[DataFrame, list[tuple[str, bytes]] | None]:
    """docs and the items of one automaton, or docs with all hits."""
    items = items_of(benchmark)
    size = items.agg(F.sum("size")).first()[0] or 0
    if size > max_words:
        return _chunked(docs, items, math.ceil(2 * size / max_words)), None
    return docs, [(x.item, bytes(x.words)) for x in items.select("item", "words").collect()]


def _judged(batch: pa.RecordBatch, machine: Automaton | None, carried: tuple[str, str] = CARRIED) -> list[tuple[bytes, int, np.ndarray, set]]:
    """Text, number of words, hit mask and item ids of each row; without an automaton, as the row carries them."""
    out = []
    masks, ids = ([None] * batch.num_rows,) * 2 if machine else [batch.column(c).to_pylist() for c in carried]
    for text, own, found in zip(base.text_bytes(batch), masks, ids, strict=True):
        words = words_of(text)
        if machine:
            mask, found = machine.hits(words)
        else:
            mask = np.zeros(len(words), bool)
            for x in own or ():
                mask |= np.unpackbits(np.frombuffer(x, np.uint8), count=len(words)).astype(bool)
        out.append((text, len(words), mask, {x for x in found or () if x is not None}))
    return out


def items_digest(items: set[str]) -> str:
    return sha256(",".join(sorted(items)).encode()).hexdigest()


def judge(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """One row per document: its words, those hit, and the items that hit them."""
    docs, items_ = _prepared(docs.select("doc_id", "text"), benchmark, max_words)

    def act(batch):
        rows = _judged(batch, machine_of(items_))
        hit = [int(mask.sum()) for _, _, mask, _ in rows]
        items = [x for _, _, _, x in rows]
        return [batch.column("doc_id"), [n for _, n, _, _ in rows], hit, list(map(len, items)), list(map(items_digest, items)), [h > 0 for h in hit]]

    return base.map_batches(docs, lambda: act, SCHEMA)


def without(text: bytes, mask: np.ndarray) -> bytes:
    """text without the words of mask and without what stands between words that go together."""
    normal = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    starts, ends = base.spans_of(normal)
    out, at = [], 0
    for a, b in zip(*base.spans_of(mask), strict=True):
        out.append(text[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*out, text[at:]])


def clean(docs: DataFrame, benchmark: DataFrame, max_fraction: float = MAX_FRACTION, max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """The documents with hit spans removed; those hit in more than max_fraction of their words are dropped.

    All columns are kept; only ``text`` changes, and only where a span is hit. A
    whole-number column ``n_chars``, if there, is set to the new length in such rows.
    """
    names, schema = docs.columns, docs.schema
    counted = "n_chars" in names and isinstance(schema["n_chars"].dataType, IntegralType)

    docs, items = _prepared(docs, benchmark, max_words)
    carried = own_names(names)[1:]

    def run(batches):
        for batch in batches:
            rows = _judged(batch, machine_of(items), carried)
            columns = {name: batch.column(i) for i, name in enumerate(names)}
            hit = [mask.any() for _, _, mask, _ in rows]
            if any(hit):
                new = [without(t, mask).decode() if h else None for (t, _, mask, _), h in zip(rows, hit, strict=True)]
                put = pa.array(hit)
                columns["text"] = pc.if_else(put, pa.array(new, columns["text"].type), columns["text"])
                if counted:
                    columns["n_chars"] = pc.if_else(put, pa.array([x and len(x) or 0 for x in new], columns["n_chars"].type), columns["n_chars"])
            keep = pa.array([n == 0 or mask.sum() <= max_fraction * n for _, n, mask, _ in rows])
            yield base.record_batch(list(columns.values()), base.arrow_schema(schema)).filter(keep)

    return docs.mapInArrow(run, schema)
