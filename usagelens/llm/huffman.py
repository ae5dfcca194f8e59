"""Token ids in canonical, length-limited Huffman coding.

Texts become ids with a public tokenizer; the counts of all ids give one code,
of which only the lengths are stored (``codes``). Documents lie in ascending
order in shards, and a shard is a list of independent blocks (``blocks``): the
documents' ids and lengths, the coded ids (each document starts at a byte), and
the bit offset of every ``STEP``-th id of a document. From these checkpoints a
block is decoded in as many lanes at once, one table look-up for an id.

Ids are written once before they are counted, packed; what is sorted by document
is already coded.

Defined cases: null and empty texts hold the end id only; documents without an id
come first; equal ids are ordered by their tokens' number and checksum and each
keeps its own row; an empty table gives no blocks; extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens import session
from usagelens.llm import base

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAX_BITS = 20  # of a code; look-up tables have 2^MAX_BITS rows
STEP = 128  # ids between checkpoints
BLOCK_BYTES = 1 << 19  # a block ends with the document that reaches this
CACHED_PIECES = 300_000  # of each generation
CACHED_BYTES = 64  # of a piece that is kept

TOKENS = "doc_id long, n_tokens int, crc long, low binary, high binary"
CODES = "id long, bits int"
CODED = "shard int, doc_id long, n_tokens int, crc long, offsets binary, data binary"
BLOCKS = "shard int, block int, first_token long, doc_ids array<long>, n_tokens array<int>, n_bytes array<int>, offsets binary, data binary"
DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


# --- Tokens ---------------------------------------------------------------------


# A text is cut into pieces here if it holds nothing but these: ASCII without most control characters and without
# apostrophes and "<|" (contractions, special tokens), and letters that have one lower-case letter each.
OTHER = re.compile("[^\\t-\\r\\x20-\\x7e\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u024f]")
# Kinds of bytes: 0 white space, 1 letter, 2 other, 3 digit (a piece of its own), 4 not plain.
KIND = np.full(256, 2, np.uint8)
KIND[[*range(9), *range(14, 32), 39, 127]] = 4
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 3


def pieces(text: str) -> list[bytes] | None:
    """The runs of letters, single digits and runs of other characters of a text in lower case; None if it isn't plain."""
    if "<|" in text or not text.isascii() and OTHER.search(text):
        return None
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    kind = KIND[raw]
    if not len(kind) or kind.max() == 4:
        return None
    a, b = kind[:-1], kind[1:]
    cut = np.flatnonzero((a != b) & (a > 0) & (b > 0) | (a == 3) & (b == 3)) + 1
    return np.insert(raw, cut, 32).tobytes().split()


class Pieces(dict):
    """The ids of pieces as little-endian 16-bit numbers, encoded when first asked for.

    Two generations: when this one is full it becomes the old one, and pieces that are
    asked for again come back from there, so that those in use stay.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.tokens, self.old = tokenizer, tokenizer.model.tokenize, {}
        self.ids = [i.to_bytes(2, "little") for i in range(tokenizer.get_vocab_size())]
        # The tokenizer's model has a letter for each byte; printable ASCII stands for itself.
        letters = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
        others = [b for b in range(256) if b not in letters]
        self.letters = letters | {b: chr(256 + i) for i, b in enumerate(others)}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __missing__(self, piece: bytes) -> bytes:
        found = self.old.get(piece)
        if found is None:
            text = piece.decode("latin-1")
            ids = self.ids
            found = b"".join([ids[t.id] for t in self.tokens(text if piece.isascii() else text.translate(self.letters))])
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


def encoder(path: str):
    """A function from a text to its ids.

    The tokenizer works on each run of letters, digit or run of other characters
    by itself, after normalisation, so a plain text is encoded piece by piece with
    a bounded cache, which a worker keeps. Any other goes to the library whole.
    """
    from tokenizers import Tokenizer

    state = base.worker_state("encoder")
    if path not in state:
        state[path] = Pieces(Tokenizer.from_file(path))
    cache = state[path]

    def encode(text: str | None) -> bytes:
        cut = pieces(text or "")
        return cache.whole(text or "") if cut is None else b"".join(map(cache.__getitem__, cut))

    return encode


def tokenize(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Each document's ids, with the end id, as low and high bytes."""
    path = path or public_tokenizers.path(TOKENIZER)
    end = int(end_id).to_bytes(2, "little")

    def make():
        encode = encoder(path)

        def act(batch):
            ids = [encode(x) + end for x in batch.column("text").to_pylist()]
            return [batch.column("doc_id"), [len(x) // 2 for x in ids], list(map(zlib.crc32, ids)), [x[::2] for x in ids], [x[1::2] for x in ids]]

        return act

    return base.map_batches(docs.select("doc_id", "text"), make, TOKENS)


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch of tokens, end to end."""
    low, high = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("low", "high"))
    return low | high.astype(np.uint16) << np.uint16(8)


# --- The code -------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of the best prefix code of at most limit bits, by package-merge.

    A level's list merges the symbols with pairs of the level before; a symbol's
    length is the number of levels in whose chosen part it lies.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    merged, leaves = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packed = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((weights, packed))
        place = np.argsort(both, kind="stable")
        merged = both[place]
        leaves.append(place < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id; ids ascending."""
    order = np.lexsort((ids, bits))
    sizes = bits[order]
    steps = np.left_shift(1, MAX_BITS - sizes)  # in units of the last bit
    codes = np.empty(len(ids), np.int64)
    codes[order] = (np.cumsum(steps) - steps) >> (MAX_BITS - sizes)
    return codes


def count_ids(tokens: DataFrame) -> DataFrame:
    """Counts of all ids: each task sums its own first, so a group has a row for each task at most."""
    types = base.arrow_schema(StructType.fromDDL("id long, n long"))

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(ids_of(batch), minlength=len(total))
            own[: len(total)] += total
            total = own
        found = np.flatnonzero(total)
        if len(found):
            yield base.record_batch([found, total[found]], types)

    return tokens.select("low", "high").mapInArrow(run, StructType.fromDDL("id long, n long")).groupBy("id").agg(F.sum("n").alias("n"))


def make_code(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and their code lengths. The rows are bounded by the tokenizer's vocabulary."""
    counts = count_ids(tokens).orderBy("id").toPandas()
    return counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64))


# --- Blocks ---------------------------------------------------------------------


def encode(ids: np.ndarray, n_tokens: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Coded bytes of documents, each from a byte on; their numbers of bytes; the bit in its document where each id starts.

    ids of all documents end to end; codes and bits are by id.
    """
    size = bits[ids]
    ends = np.cumsum(size)
    first = np.cumsum(n_tokens) - n_tokens
    doc_bits = np.add.reduceat(size, first)
    inside = ends - size - np.repeat(ends[first] - size[first], n_tokens)
    n_bytes = (doc_bits + 7) // 8
    doc_start = 8 * (np.cumsum(n_bytes) - n_bytes)
    starts = inside + np.repeat(doc_start, n_tokens)
    # A code lies in the 32-bit word where it starts and may run into the next.
    value = codes[ids] << (np.uint64(64) - size.astype(np.uint64) - (starts & 31).astype(np.uint64))
    word = starts >> 5
    out = np.zeros(int(n_bytes.sum()) // 4 + 3, np.uint32)
    head = np.flatnonzero(np.diff(word, prepend=-1))
    joined = np.bitwise_or.reduceat(value, head)
    at = word[head]
    out[at] |= (joined >> np.uint64(32)).astype(np.uint32)
    out[at + 1] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out.astype(">u4").tobytes()[: int(n_bytes.sum())], n_bytes, inside


def decode_table(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string of MAX_BITS bits: the id whose code it begins with, and that code's length."""
    order = np.lexsort((ids, bits))
    repeat = np.left_shift(1, MAX_BITS - bits[order])
    symbols, sizes = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.int64)
    symbols[: repeat.sum()] = np.repeat(ids[order].astype(np.uint32), repeat)
    sizes[: repeat.sum()] = np.repeat(bits[order], repeat)
    return symbols, sizes


def decode(data: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of all stretches end to end: counts[i] ids from bit starts[i] on. All stretches advance together."""
    symbols, sizes = table
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.empty(int(counts.sum()), np.uint16)
    order = np.argsort(-counts, kind="stable")
    at, to = starts[order], (np.cumsum(counts) - counts)[order]
    longer = len(counts) - np.searchsorted(np.sort(counts), np.arange(int(counts.max(initial=0))), "right")
    for k, n in enumerate(longer.tolist()):  # the first n stretches have an id number k
        at, to = at[:n], to[:n]
        code = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[to + k] = symbols[code]
        at = at + sizes[code]
    return out


def shard_bounds(tokens: DataFrame, n: int) -> list[int]:
    """Ids that cut the documents into about n shards of equal rows."""
    cuts = tokens.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000).alias("x")).first().x or []
    return sorted(set(cuts))


def write_blocks(tokens: DataFrame, path: str) -> None:
    """Write codes, shards and blocks under path; tokens is a saved table."""
    spark = tokens.sparkSession
    ids, bits = make_code(tokens)
    base.local_table(spark, [ids.tolist(), bits.tolist()], CODES).coalesce(1).write.parquet(f"{path}/codes")
    cuts = shard_bounds(tokens, base.parts(spark))
    # Shard k holds the ids from cut k-1 up to below cut k; nulls go to shard 0.
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    shard = F.coalesce(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))), F.lit(0)).cast("int")
    placed = tokens.withColumn("shard", shard)
    # One row a shard, as many shards as shuffle partitions: bounded.
    totals = {r.shard: r.n for r in placed.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    first_token = dict(zip(sorted(totals), itertools.accumulate((totals[k] for k in sorted(totals)), initial=0), strict=False))
    codes, sizes = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64)
    codes[ids], sizes[ids] = canonical(ids, bits), bits

    def make():
        def act(batch):
            n_tokens = np.array(batch.column("n_tokens"), np.int64)
            data, n_bytes, inside = encode(ids_of(batch), n_tokens, codes, sizes)
            ends, rows = np.cumsum(n_bytes), np.cumsum(n_tokens)
            coded = [data[b - n : b] for b, n in zip(ends.tolist(), n_bytes.tolist(), strict=True)]
            offsets = [inside[b - n : b : STEP].astype("<u4").tobytes() for b, n in zip(rows.tolist(), n_tokens.tolist(), strict=True)]
            return [*(batch.column(c) for c in ("shard", "doc_id", "n_tokens", "crc")), offsets, coded]

        return act

    types = base.arrow_schema(StructType.fromDDL(BLOCKS))

    def pack(batches: Iterator[pa.RecordBatch]):
        held, shard, block, start, size = [], None, 0, 0, 0

        def packed():
            docs, n_tokens, offsets, coded = zip(*held, strict=True)
            n_bytes = list(map(len, coded))
            return base.record_batch([[shard], [block], [start], [list(docs)], [list(n_tokens)], [n_bytes], [b"".join(offsets)], [b"".join(coded)]], types)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "doc_id", "n_tokens", "offsets", "data"))
            for own, *row in zip(*columns, strict=True):
                if held and (own != shard or size >= BLOCK_BYTES):
                    yield packed()
                    block, start, size = block + 1, start + sum(x[1] for x in held), 0
                    held.clear()
                if own != shard:
                    shard, block, start = own, 0, first_token[own]
                held.append(row)
                size += len(row[3])
        if held:
            yield packed()

    coded = base.map_batches(placed, make, CODED)
    rows = coded.repartition(base.parts(spark), "shard").sortWithinPartitions("shard", "doc_id", "n_tokens", "crc")
    rows.drop("crc").mapInArrow(pack, StructType.fromDDL(BLOCKS)).write.parquet(f"{path}/blocks")


def read_code(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.read.schema(CODES).parquet(f"{path}/codes").orderBy("id").toPandas()
    return rows["id"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Decode all blocks under path: a row per document with its place and the checksum of its ids."""
    ids, bits = read_code(spark, path)

    def make():
        table = decode_table(ids, bits)

        def act(batch):
            out = [[], [], [], []]
            for row in batch.to_pylist():
                n_tokens, n_bytes = np.array(row["n_tokens"], np.int64), np.array(row["n_bytes"], np.int64)
                steps = (n_tokens + STEP - 1) // STEP
                start = np.frombuffer(row["offsets"], "<u4").astype(np.int64) + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), steps)
                place = np.arange(len(start)) - np.repeat(np.cumsum(steps) - steps, steps)
                counts = np.minimum(STEP, np.repeat(n_tokens, steps) - STEP * place)
                tokens = decode(row["data"], start, counts, table).astype("<u4")
                ends = np.cumsum(n_tokens)
                for doc, a, b in zip(row["doc_ids"], (ends - n_tokens).tolist(), ends.tolist(), strict=True):
                    for column, value in zip(out, (doc, row["first_token"] + a, b - a, zlib.crc32(tokens[a:b].tobytes())), strict=True):
                        column.append(value)
            return out

        return act

    return base.map_batches(spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), make, DECODED)


def write(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode documents into Huffman blocks under path."""
    write_blocks(base.saved(tokenize(docs, tokenizer), "tokens", compression="zstd"), path)


def round_trip(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write documents' ids and read them back from the files."""
    spark = docs.sparkSession
    path = path or session.scratch_dir(spark, "huffman")
    write(docs, path, tokenizer)
    return read_blocks(spark, path)
