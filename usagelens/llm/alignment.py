"""Alignment of two tokenizers' ids.

Both token streams of a text lie over the same bytes; where a token of either ends,
a group closes. Aligning is a monoid of fragments: a byte range of a text yields the
tokens up to its first common end (``head``, open to the left), the closed groups,
and the tokens after its last common end (``tail``, open to the right); ``compose``
joins neighbours and is associative. Texts of up to ``CHUNK_BYTES`` are one range.
Longer ones are cut into ranges anywhere, also inside tokens: each range is tokenized
in a task of its own, with as much text around it as reaches the next places where
both tokenizers always cut, and keeps the tokens that end in it (``cut``). The
fragments of a text are then composed as a tree over Spark tasks (``reduce_tree``).

Linked id pairs are counted by documents over the corpus (``pair_counts``): a page
of documents posts each pair once, and gets back the counts of its own pairs.

Defined cases: texts that are null, empty, or that a tokenizer does not give back
byte by byte have no tokens and no links; rows may repeat, each counts as a document
and keeps its own row; ids may be null; an empty table gives no rows; extra columns
are not read. A run of text without a place to cut that is longer than a range stays
in one range.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm import base

BYTE_BPE = "byte_bpe_50k"
PIECES = "piece_bpe_32k.model"
CHUNK_BYTES = 32 << 10
FAN = 8  # fragments that a task composes at once
PAGE_LINKS = 1 << 20  # links of the documents of a page

CHUNKS = "row long, doc_id long, chunk long, text binary, low long, start long, end long"
FRAGMENTS = "row long, doc_id long, chunk long, valid boolean, closes boolean, head_a binary, head_b binary, tail_a binary, tail_b binary, n_a long, n_b long, n_groups long, n_links long, groups binary, keys binary, times binary"
DOCUMENTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys binary, times binary"
PAGES = f"page long, documents array<struct<{DOCUMENTS.replace(' ', ':').replace(',:', ',')}>>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

ID_BITS = 32  # a pair's key is its A id above its B id


# --- Tokens -----------------------------------------------------------------------


# Letters and signs that both libraries of the byte-level tokenizer class alike; other texts go to the slower, exact one.
COMMON = re.compile("[^\\x00-\\u024f\\u2010-\\u2027]")


@dataclass
class Tokenizers:
    """Both tokenizers, and by id: each token's bytes and number of bytes, and its decimal text before each sign."""

    def __post_init__(self):
        import base64

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(public_tokenizers.path(f"{BYTE_BPE}.json"))
        exact.encode_special_tokens = True
        with open(public_tokenizers.path(f"{BYTE_BPE}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        quick = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
        self.encode_a = lambda text: exact.encode(text, add_special_tokens=False).ids if COMMON.search(text) else quick.encode_ordinary(text)
        self.encode_b = model.encode
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_b = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # Texts of an id followed by: a comma (A), a bar (A), a comma (B), a semicolon (B).
        self.shift = len(self.bytes_a)
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        signs = [f"{i},".encode() for i in a] + [f"{i}|".encode() for i in a] + [f"{i},".encode() for i in b] + [f"{i};".encode() for i in b]
        self.signs, self.spell_a, self.spell_b = (np.array(x, object) for x in (signs, self.bytes_a, self.bytes_b))

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """A and B ids of a text that begins with a space, and whether they give it back."""
        a, b, raw = np.array(self.encode_a(text), np.int64), np.array(self.encode_b(text[1:]), np.int64), text.encode()
        return a, b, all(b"".join(spell[x].tolist()) == raw for spell, x in ((self.spell_b, b), (self.spell_a, a)))


def tokenizers() -> Tokenizers:
    """The worker's tokenizers."""
    state = base.worker_state("alignment")
    if "tokenizers" not in state:
        state["tokenizers"] = Tokenizers()
    return state["tokenizers"]


# --- Ranges of long texts ---------------------------------------------------------


def is_cut(data: bytes, i: int) -> bool:
    """Whether both tokenizers always cut before byte i: a space there, and no white space before it."""
    if i == 0 or i >= len(data):
        return True
    before = data[max(0, i - 4) : i].decode("utf-8", "ignore")[-1:]
    return data[i] == 32 and before != "" and not before.isspace()


def cut_before(data: bytes, i: int) -> int:
    while not is_cut(data, i):
        i = max(0, data.rfind(b" ", 0, i))
    return i


def cut_after(data: bytes, i: int) -> int:
    while not is_cut(data, i):
        i = data.find(b" ", i + 1)
        i = len(data) if i < 0 else i
    return i


def ranges(data: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Byte ranges of a text and what must be tokenized for them: (low, high, start, end).

    A range ends every ``size`` bytes, but for those in a run of over ``size`` bytes without a cut.
    """
    ends, around = [], {0: (0, 0), len(data): (len(data), len(data))}
    for end in range(size, len(data), size):
        low, high = cut_before(data, end), cut_after(data, end)
        if high - low <= size:
            ends.append(end)
            around[end] = low, high
    return [(around[a][0], around[b][1], a, b) for a, b in zip([0, *ends], [*ends, len(data)], strict=True)]


def cut(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """Rows for the byte ranges of every text, which begins with a space; ``row`` is new for each row of docs."""

    def make():
        count = 0

        def act(batch):
            nonlocal count
            out = [[] for _ in range(7)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), base.text_bytes(batch), strict=True):
                count += 1
                row, data = base.page_number(count), b" " + text
                for k, (low, high, start, end) in enumerate(ranges(data, size)):
                    for column, value in zip(out, (row, doc, k, data[low:high], low, start, end), strict=True):
                        column.append(value)
            return out

        return act

    return base.map_batches(docs.select("doc_id", "text"), make, CHUNKS)


# --- The monoid -------------------------------------------------------------------


@dataclass
class Fragment:
    """A stretch of two token streams. Without a common end (``closes`` false) all of its tokens are in the head."""

    valid: bool
    closes: bool
    head: tuple[np.ndarray, np.ndarray]
    tail: tuple[np.ndarray, np.ndarray]
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes  # the closed groups, a semicolon after each
    keys: np.ndarray  # linked pairs, ascending
    times: np.ndarray


NO_IDS = np.zeros(0, np.int64)
EMPTY = Fragment(True, False, (NO_IDS, NO_IDS), (NO_IDS, NO_IDS), 0, 0, 0, 0, b"", NO_IDS, NO_IDS)
INVALID = Fragment(False, False, (NO_IDS, NO_IDS), (NO_IDS, NO_IDS), 0, 0, 0, 0, b"", NO_IDS, NO_IDS)


def merged(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their times."""
    all_keys, all_times = np.concatenate(keys), np.concatenate(times)
    found, place = np.unique(all_keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, all_times)
    return found, total


def links(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Keys of all pairs of A and B occurrences within groups; n_a and n_b are the groups' numbers of tokens."""
    group = np.repeat(np.arange(len(n_a)), n_a)
    times = n_b[group]
    first = np.repeat((np.cumsum(n_b) - n_b)[group], times)
    inside = np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(a, times) << ID_BITS | b[first + inside]


def spelled(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, t: Tokenizers) -> list[bytes]:
    """The tokens' decimal ids in order of groups, A before B, each with the sign that follows it."""
    out = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.zeros(len(x), np.int64) for x in (a, b))
    last_a[np.cumsum(n_a) - 1] = 1
    last_b[np.cumsum(n_b) - 1] = 1
    out[np.arange(len(a)) + np.repeat(np.cumsum(n_b) - n_b, n_a)] = a + last_a * t.shift
    out[np.arange(len(b)) + np.repeat(np.cumsum(n_a), n_b)] = b + 2 * t.shift + last_b * len(t.bytes_b)
    return t.signs[out].tolist()


def closed(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, t: Tokenizers) -> Fragment:
    """A fragment of closed groups only."""
    keys, times = np.unique(links(a, b, n_a, n_b), return_counts=True)
    return Fragment(True, True, (NO_IDS, NO_IDS), (NO_IDS, NO_IDS), len(a), len(b), len(n_a), int(times.sum()), b"".join(spelled(a, b, n_a, n_b, t)), keys, times)


def fragment(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, t: Tokenizers, begins: bool = False) -> Fragment:
    """The fragment of neighbouring tokens that end at these bytes. Where a text begins both streams do, so that its first fragment has no head."""
    place = np.searchsorted(ends_b, ends_a)
    common = np.flatnonzero(ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a) if len(ends_b) else NO_IDS
    cut_a, cut_b = common + 1, place[common] + 1
    if begins:
        cut_a, cut_b = np.append(0, cut_a), np.append(0, cut_b)
    if not len(cut_a):
        return Fragment(True, False, (a, b), (NO_IDS, NO_IDS), len(a), len(b), 0, 0, b"", NO_IDS, NO_IDS)
    first_a, last_a, first_b, last_b = cut_a[0], cut_a[-1], cut_b[0], cut_b[-1]
    own = EMPTY
    if len(cut_a) > 1:
        own = closed(a[first_a:last_a], b[first_b:last_b], np.diff(cut_a), np.diff(cut_b), t)
    return Fragment(True, True, (a[:first_a], b[:first_b]), (a[last_a:], b[last_b:]), len(a), len(b), own.n_groups, own.n_links, own.groups, own.keys, own.times)


def one_group(a: np.ndarray, b: np.ndarray, t: Tokenizers) -> Fragment:
    return closed(a, b, np.array([len(a)]), np.array([len(b)]), t)


def compose(parts: list[Fragment], t: Tokenizers) -> Fragment:
    """Neighbouring fragments as one."""
    if not all(x.valid for x in parts):
        return INVALID
    head, tail, inner, closes = ([], []), ([], []), [], False

    def joined(open_: tuple[list, list]) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(x) if x else NO_IDS for x in open_)

    for x in parts:
        into = tail if closes else head
        for side in (0, 1):
            into[side].append(x.head[side])
        if x.closes:
            if closes:  # what was open between two common ends is a group
                inner.append(one_group(*joined(tail), t))
            closes, tail = True, ([x.tail[0]], [x.tail[1]])
            inner.append(x)
    keys, times = merged([x.keys for x in inner], [x.times for x in inner]) if inner else (NO_IDS, NO_IDS)
    groups, links_ = sum(x.n_groups for x in inner), sum(x.n_links for x in inner)
    return Fragment(True, closes, joined(head), joined(tail), sum(x.n_a for x in parts), sum(x.n_b for x in parts), groups, links_, b"".join(x.groups for x in inner), keys, times)


def whole(x: Fragment) -> tuple:
    """A document's row from the fragment of its whole text."""
    if not x.valid or not x.closes:
        return 0, 0, 0, 0, "", b"", b""
    return x.n_a, x.n_b, x.n_groups, x.n_links, hashlib.sha256(x.groups[:-1]).hexdigest(), x.keys.tobytes(), x.times.tobytes()


def packed(x: Fragment) -> list:
    raw = [y.tobytes() for y in (*x.head, *x.tail)]
    return [x.valid, x.closes, *raw, x.n_a, x.n_b, x.n_groups, x.n_links, x.groups, x.keys.tobytes(), x.times.tobytes()]


def unpacked(r: dict) -> Fragment:
    ids = {c: np.frombuffer(r[c], np.int64) for c in ("head_a", "head_b", "tail_a", "tail_b", "keys", "times")}
    return Fragment(r["valid"], r["closes"], (ids["head_a"], ids["head_b"]), (ids["tail_a"], ids["tail_b"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], ids["keys"], ids["times"])


def fragments(chunks: DataFrame) -> DataFrame:
    """The fragment of each byte range."""

    def make():
        t = tokenizers()

        def act(batch):
            rows = []
            for r in batch.to_pylist():
                a, b, same = t.both(r["text"].decode())
                if same:
                    ends_a, ends_b = r["low"] + np.cumsum(t.size_a[a]), r["low"] + np.cumsum(t.size_b[b])
                    own_a, own_b = ((e > r["start"]) & (e <= r["end"]) for e in (ends_a, ends_b))
                    found = fragment(a[own_a], b[own_b], ends_a[own_a], ends_b[own_b], t, r["start"] == 0)
                else:
                    found = INVALID
                rows.append([r["row"], r["doc_id"], r["chunk"], *packed(found)])
            return list(zip(*rows, strict=True))

        return act

    return base.map_batches(chunks, make, FRAGMENTS)


def reduce_tree(parts: DataFrame, longest: int, fan: int = FAN) -> DataFrame:
    """One fragment for each text: in every turn a task composes up to ``fan`` neighbours. longest: fragments of a text at most."""
    types = base.arrow_schema(StructType.fromDDL(FRAGMENTS))

    def act(rows: pa.Table) -> pa.Table:
        found = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
        first = found[0]
        one = compose([unpacked(r) for r in found], tokenizers())
        batch = base.record_batch([[x] for x in (first["row"], first["doc_id"], first["chunk"] // fan, *packed(one))], types)
        return pa.Table.from_batches([batch])

    while longest > 1:
        parts = parts.groupBy("row", (F.col("chunk") / fan).cast("long").alias("next")).applyInArrow(act, StructType.fromDDL(FRAGMENTS))
        parts, longest = base.saved(parts, "fragments"), -(-longest // fan)
    return parts


# --- Documents and pages ----------------------------------------------------------


def aligned(docs: DataFrame, size: int = CHUNK_BYTES, fan: int = FAN, n_links: int = PAGE_LINKS) -> DataFrame:
    """Pages of documents: for each document its numbers, the digest of its groups, its linked pairs and their times."""

    def short():
        t = tokenizers()

        def act(batch):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = INVALID
                if text:
                    a, b, same = t.both(f" {text}")
                    if same:
                        found = fragment(a, b, np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b]), t, True)
                yield doc, *whole(found)

        return act

    def finish():
        return lambda batch: ((r["doc_id"], *whole(unpacked(r))) for r in batch.to_pylist())

    docs = docs.select("doc_id", "text")
    is_long = F.octet_length("text") >= size
    done = pages(docs.filter(~F.coalesce(is_long, F.lit(False))), short, n_links)
    chunks = base.saved(cut(docs.filter(is_long), size), "chunks", compression="zstd")
    longest = chunks.agg(F.max("chunk")).first()[0]
    if longest is not None:
        spread = fragments(chunks.repartition(base.parts(docs.sparkSession), "row", "chunk"))
        whole_texts = reduce_tree(base.saved(spread, "fragments"), longest + 1, fan)
        done = done.unionByName(pages(whole_texts, finish, n_links))
    return base.saved(done, "aligned", compression="zstd")


def pages(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[tuple]]], n_links: int) -> DataFrame:
    """Documents in pages: rows that hold about n_links linked pairs.

    ``make()`` returns a function that yields the documents of a batch. They go into
    their pages in the worker that makes them, so that a task has one worker.
    """
    types = base.arrow_schema(StructType.fromDDL(PAGES))
    names = StructType.fromDDL(DOCUMENTS).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]):
        act, held, size, count = make(), [], 0, 0
        for batch in batches:
            for document in act(batch):
                held.append(dict(zip(names, document, strict=True)))
                size += len(held[-1]["keys"]) // 8
                if size >= n_links:
                    count += 1
                    yield base.record_batch([[base.page_number(count)], [held]], types)
                    held, size = [], 0
        if held:
            yield base.record_batch([[base.page_number(count + 1)], [held]], types)

    return df.mapInArrow(run, StructType.fromDDL(PAGES))


def posts(paged: DataFrame) -> DataFrame:
    """Each page's pairs, ascending, and the number of its documents that hold them."""

    def make():
        def act(batch):
            pairs, counts = [], []
            for documents in batch.column("documents").to_pylist():
                keys, n = np.unique(np.frombuffer(b"".join(d["keys"] for d in documents), np.int64), return_counts=True)
                pairs.append(keys)
                counts.append(n)
            return [batch.column("page"), pairs, counts]

        return act

    return base.map_batches(paged, make, "page long, keys array<long>, counts array<long>")


def pair_counts(posted: DataFrame) -> DataFrame:
    """Every linked pair's number of documents, and whether it is the highest of its A id."""
    each = posted.select(F.explode(F.arrays_zip("keys", "counts")).alias("p")).select("p.keys", "p.counts")
    counted = each.groupBy(F.col("keys").alias("key")).agg(F.sum("counts").alias("n")).withColumn("a", F.shiftright("key", ID_BITS))
    counted = base.saved(counted, "pairs")
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"))
    return counted.join(highest, "a").select("key", "n", (F.col("n") == F.col("highest")).alias("best"))


def judge(docs: DataFrame, size: int = CHUNK_BYTES, fan: int = FAN, page_links: int = PAGE_LINKS) -> DataFrame:
    """Each document's alignment, and how common its links are over the corpus."""
    paged = aligned(docs, size, fan, page_links)
    posted = base.saved(posts(paged), "posts", compression="zstd")
    wanted = posted.select("page", F.explode("keys").alias("key"))
    # A page's pairs come back to it: no more than it has posted.
    told = wanted.join(pair_counts(posted), "key").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("key", "n", "best"))).alias("told"))

    def make():
        def act(batch):
            out = [[] for _ in range(8)]
            # The answers stay Arrow arrays: a page has many.
            told = batch.column("told")
            flat, offsets = told.flatten(), np.concatenate(([0], np.cumsum(np.array(told.value_lengths().fill_null(0)))))
            keys, n, best = (np.array(flat.field(c)) for c in ("key", "n", "best"))
            for i, documents in enumerate(batch.column("documents").to_pylist()):
                own = slice(offsets[i], offsets[i + 1])
                for d in documents:
                    times = np.frombuffer(d["times"], np.int64)
                    at = np.searchsorted(keys[own], np.frombuffer(d["keys"], np.int64))
                    values = (d["doc_id"], d["n_a"], d["n_b"], d["n_groups"], d["n_links"], int(times[best[own][at]].sum()), int((times * n[own][at]).sum()), d["groups_sha256"])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            return out

        return act

    return base.map_batches(paged.join(told, "page", "left").select("documents", "told"), make, RESULT)
