"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set holds its distinct 5-word shingles. Equal sets form a class,
which one document represents. A representative is posted under each coordinate
and value of its MinHash signature of ``COORDINATES`` values; two that are similar
by ``PERCENT`` / 100 collide in three quarters of them on average, and in fewer
than ``COLLISIONS`` with a chance of 1.2e-6 at exactly that similarity, less above.

Prefix and skip: two signatures with at least ``COLLISIONS`` common postings share
one among the rarest ``COORDINATES - COLLISIONS + 1`` postings of each. So only
those are listed, ordered by how often they occur over all documents, and the
frequent ones are skipped; they count when the collisions of a candidate are
counted. Postings that occur once are dropped.

Lists are joined without all pairs: every member of a list is held against the
list's pivot, what is linked becomes one component, and only lists that still
hold several components go on, with another pivot and without the last. Short
lists compare all members of different components at once, and after ``TURNS``
turns so do the few long ones that are left. Candidates with enough collisions
are confirmed on their full sets.

Defined cases: texts without words, and null, have an empty set and stay alone;
fewer than 5 words make one shingle; repeated rows are equal; rows that share an
id are one node; a null id is only equal to itself and stays alone if no equal
text has an id; an empty table gives no rows; extra columns are kept by ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm import base

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
COLLISIONS = 72
SHORT_LIST = 32
TURNS = 2
BLOCK = 512
COLUMNS = 4096  # shingles of two blocks that are compared at once
PAGE_ROWS = 1024
# Texts are hashed together up to so many bytes; a longer text is hashed alone. A byte takes some 60 while it is hashed.
CHUNK_BYTES = 128 << 10

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FACTORS = np.random.default_rng(20240131).integers(1 << 62, 1 << 63, COORDINATES + SHINGLE, np.uint64) | np.uint64(1)

SIGNED = "doc_id long, n_shingles long, set_id binary, signature binary"


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in order, cut into lists of CHUNK_BYTES at most or of one text."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > CHUNK_BYTES:
            yield texts[start:i]
            start, total = i, 0
        total += len(text)
    if texts:
        yield texts[start:]


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [x for chunk in chunks(texts) for x in _shingles(chunk)]


def _shingles(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join([*texts, b""]).translate(_LOWER), np.uint8)
    starts, ends = base.spans_of(~_SPACE[data])
    words = base.Rolling(data)(starts, ends)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    cut = np.concatenate(([0], np.searchsorted(starts, np.cumsum(lengths))))
    n = len(words)
    padded = np.concatenate((words, np.zeros(SHINGLE, np.uint64)))
    with np.errstate(over="ignore"):
        whole = base.mix(sum(padded[j : n + j] * _FACTORS[COORDINATES + j] for j in range(SHINGLE)) if n else words)
        out = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                out.append(np.unique(whole[a : b - SHINGLE + 1]))
            elif b > a:
                own = sum((words[a + j] * _FACTORS[COORDINATES + j] for j in range(b - a)), np.uint64(b - a))
                out.append(base.mix(np.array([own], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of COORDINATES minima for each set; sets must not be empty."""
    flat = np.concatenate(sets)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    first = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for j in range(COORDINATES):
        out[:, j] = np.minimum.reduceat((flat * _FACTORS[j]) >> np.uint64(32), first)
    return out


def signed(docs: DataFrame) -> DataFrame:
    """Each document's set size, the set's digest, and the signature."""

    def act(batch: pa.RecordBatch) -> list:
        sets = shingles(base.text_bytes(batch))
        full = [x for x in sets if len(x)]
        rows = iter(signatures(full)) if full else iter(())
        return [
            batch.column("doc_id"),
            [len(x) for x in sets],
            [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets],
            [next(rows).astype("<u4").tobytes() if len(x) else None for x in sets],
        ]

    return base.map_batches(docs.select("doc_id", "text"), lambda: act, SIGNED)


PAGES = "page long, nodes binary, signatures binary"


def paged(nodes: DataFrame) -> DataFrame:
    """Representatives packed into pages."""
    types = base.arrow_schema(StructType.fromDDL(PAGES))

    def run(batches):
        count = 0
        for batch in batches:
            ids, own = batch.column("node").to_numpy(zero_copy_only=False), batch.column("signature").to_pylist()
            for a in range(0, len(own), PAGE_ROWS):
                row = [[base.page_number(count)], [ids[a : a + PAGE_ROWS].astype("<i8").tobytes()], [b"".join(own[a : a + PAGE_ROWS])]]
                yield base.record_batch(row, types)
                count += 1

    return nodes.select("node", "signature").mapInArrow(run, StructType.fromDDL(PAGES))


def _keys(signatures: bytes) -> np.ndarray:
    """A 64-bit key for each coordinate and value."""
    values = np.frombuffer(signatures, "<u4").reshape(-1, COORDINATES).astype(np.uint64)
    return base.mix(values | np.arange(COORDINATES, dtype=np.uint64)[None, :] << np.uint64(32))


def postings(nodes: DataFrame) -> DataFrame:
    """(key, node) for the rarest postings of each node, without those that no other node has."""
    pages, n = base.saved(paged(nodes), "signature-pages"), base.parts(nodes.sparkSession)
    types = base.arrow_schema(StructType.fromDDL(base.ASKED))

    def asks(batches):
        for batch in batches:
            for page, own in zip(batch.column("page").to_pylist(), batch.column("signatures").to_pylist(), strict=True):
                keys, counts = np.unique(_keys(own), return_counts=True)
                rows = base.ask(page, keys, np.minimum(counts, 65535).astype("<u2"), n)
                yield base.record_batch(list(map(list, zip(*rows, strict=True))), types)

    def reply(group: np.ndarray, first: np.ndarray, more: bytes) -> np.ndarray:
        total = np.add.reduceat(np.frombuffer(more, "<u2").astype(np.int64), first) if len(first) else np.zeros(0)
        return np.minimum(255, np.round(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)[group]

    asked = pages.select("page", "signatures").mapInArrow(asks, StructType.fromDDL(base.ASKED))
    frequency = base.answers(asked, reply, "<u8", "frequencies")
    out_types = base.arrow_schema(StructType.fromDDL("key long, node long"))

    def lists(batches):
        for batch in batches:
            for ids, own, answers in zip(*(batch.column(c).to_pylist() for c in ("nodes", "signatures", "answers")), strict=True):
                keys = _keys(own)
                distinct, place = np.unique(keys, return_inverse=True)
                often = base.answer_bytes(answers)[place.reshape(keys.shape)]
                # Rarest first, equal ones by key: one order for all nodes.
                order = np.lexsort((keys, often), axis=1)[:, : COORDINATES - COLLISIONS + 1]
                keys, often = np.take_along_axis(keys, order, 1), np.take_along_axis(often, order, 1)
                row, column = np.nonzero(often)
                if len(row):
                    yield base.record_batch([keys[row, column].view(np.int64), np.frombuffer(ids, "<i8")[row]], out_types)

    return pages.join(frequency, "page").select("nodes", "signatures", "answers").mapInArrow(lists, StructType.fromDDL("key long, node long"))


def candidates(lists: DataFrame, labels: DataFrame | None, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to look at in this turn, and the postings of lists that hold several components.

    The first pivot of a list is its smallest node; later ones are drawn. Lists of one
    group share most of their members and so their pivots, which keeps the pairs few.
    """
    if labels is None:
        named = lists.select("key", "node", F.col("node").alias("label"))
    else:  # read twice below, so joined once and written
        known = lists.join(labels.withColumnRenamed("label", "known"), "node", "left")
        named = base.saved(known.select("key", "node", F.coalesce("known", "node").alias("label")), "labelled-lists")
    drawn = F.struct("node") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "node"), "node")
    stats = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"), F.min_by(F.struct("node", "label"), drawn).alias("pivot"))
    stats = base.saved(stats.filter("low != high"), "lists")
    left = base.saved(named.join(stats.select("key", "size", "pivot"), "key"), "open-lists")
    every, pivot = F.col("size") <= SHORT_LIST, F.col("pivot.node")
    star = left.filter(~every & (F.col("label") != F.col("pivot.label"))).select(F.least("node", pivot).alias("a"), F.greatest("node", pivot).alias("b"))
    some = left.filter(every).select("key", "node", "label")
    other = some.select("key", F.col("node").alias("b"), F.col("label").alias("label_b"))
    cross = some.join(other, "key").filter((F.col("node") < F.col("b")) & (F.col("label") != F.col("label_b"))).select(F.col("node").alias("a"), "b")
    return star.unionByName(cross).distinct(), left.filter(~every & (F.col("node") != pivot)).select("key", "node")


def colliding(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs with enough equal coordinates, counted on a byte of each."""
    types = "a long, b long"

    def act(batch: pa.RecordBatch) -> list:
        first, second = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("code_a", "code_b"))
        enough = pa.array((first == second).sum(1) >= COLLISIONS)
        return [batch.column("a").filter(enough), batch.column("b").filter(enough)]

    code = lambda x: nodes.select(F.col("node").alias(x), F.col("code").alias(f"code_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    near = (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    return base.map_batches(pairs.join(code("a").hint("merge"), "a").join(code("b").hint("merge"), "b").filter(near).select("a", "b", "code_a", "code_b"), lambda: act, types)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def act(batch: pa.RecordBatch) -> list:
        fit = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
            first, second = unpack(x), unpack(y)
            both = len(np.intersect1d(first, second, assume_unique=True))
            fit.append(100 * both >= PERCENT * (len(first) + len(second) - both))
        fit = pa.array(fit)
        return [batch.column("a").filter(fit), batch.column("b").filter(fit)]

    own = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    return base.map_batches(pairs.join(own("b").hint("merge"), "b").join(own("a").hint("merge"), "a").select("a", "b", "set_a", "set_b"), lambda: act, "a long, b long")


def pack(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u8")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The packed sets of the wanted nodes, from their texts."""
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(wanted, "node", "left_semi")
    return base.map_batches(
        texts, lambda: lambda batch: [batch.column("node"), [pack(x) for x in shingles(base.text_bytes(batch))]], "node long, shingles binary"
    )


def compared(rows: pa.Table) -> pa.Table:
    """Members of one or two blocks with the smallest member that links connect them to, if another."""
    nodes, chunk = rows.column("node").to_numpy(), rows.column("chunk").to_numpy()
    order = np.argsort(nodes)
    nodes, chunk, packed = nodes[order], chunk[order], rows.column("shingles").to_pylist()
    sets = [unpack(packed[i]) for i in order]
    n, sizes = len(sets), np.array([len(x) for x in sets])
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    of = np.repeat(np.arange(n), sizes)[counts[column] > 1]
    column = shared[column[counts[column] > 1]]
    both = np.zeros((n, n), np.float32)
    by_column = np.argsort(column, kind="stable")
    of, column = of[by_column], column[by_column]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        part = np.zeros((n, COLUMNS), np.float32)
        part[of[a:b], column[a:b] - low] = 1
        both += part @ part.T
    link = 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
    if len(np.unique(chunk)) > 1:
        link &= chunk[:, None] != chunk[None, :]  # pairs within a block are looked at where it stands alone
    np.fill_diagonal(link, True)
    root = np.arange(n)
    while True:
        new = np.where(link, root[None, :], n).min(1)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(n)
    return pa.table({"a": pa.array(nodes[root[moved]], pa.int64()), "b": pa.array(nodes[moved], pa.int64())})


def dense_links(lists: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within lists that stayed long, compared block by block."""
    pivot = lists.groupBy("key").agg(F.min("node").alias("a"))
    groups = base.components(lists.join(pivot, "key").select("a", F.col("node").alias("b")))
    size = groups.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    members = base.saved(groups.join(size, "label").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")), "members")
    missing = full_sets(docs, members.select("node").join(sets, "node", "left_anti"))
    own = base.saved(members.join(sets.unionByName(missing), "node"), "member-sets")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    pairs = own.select("label", "node", "shingles", "chunk", other).withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    return pairs.groupBy("label", "low", "high").applyInArrow(compared, "a long, b long")


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, n_shingles, set_id), and the component of each class (set_id, component_id)."""
    all_signed = base.saved(signed(docs), "signed")
    first = lambda c: F.first(c).alias(c)
    classes = all_signed.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("node"), first("n_shingles"), first("signature"))
    classes = base.saved(classes, "classes")
    nodes = classes.filter("node is not null")
    lists = base.saved(postings(nodes), "postings")
    codes = base.saved(base.map_batches(nodes.select("node", "n_shingles", "signature"), lambda: _codes, "node long, n_shingles long, code binary"), "codes")
    labels, tested, sets = None, None, None
    for turn in range(TURNS):
        pairs, lists = candidates(lists, labels, turn)
        pairs = base.saved(colliding(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), codes), "colliding")
        new = base.nodes_of(pairs)
        # The first turn wants sets in proportion to the corpus, later ones a few more.
        more = full_sets(docs, new.hint("merge")) if sets is None else full_sets(docs, new.join(sets, "node", "left_anti"))
        more = base.saved(more, "sets")
        sets = more if sets is None else sets.unionByName(more)
        labels = base.components(base.saved(confirmed(pairs, sets), "confirmed"), labels)
        tested = pairs if tested is None else tested.unionByName(pairs)
        lists = base.saved(lists, "postings")
        if lists.isEmpty():
            break
    else:
        named = lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        several = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
        lists = base.saved(lists.join(several.select("key"), "key", "left_semi"), "dense-lists")
        if not lists.isEmpty():
            labels = base.components(base.saved(dense_links(lists, docs, sets), "dense-links"), labels)
    named = classes.join(labels, "node", "left").select("set_id", F.coalesce("label", "node").alias("component_id"))
    return all_signed.select("doc_id", "n_shingles", "set_id"), base.saved(named, "components")


def _codes(batch: pa.RecordBatch) -> list:
    low = [np.frombuffer(x, np.uint8)[::4].tobytes() for x in batch.column("signature").to_pylist()]
    return [batch.column("node"), batch.column("n_shingles"), low]


def judge(docs: DataFrame) -> DataFrame:
    """One row per document with its component; kept: it is the first of its component."""
    rows, named = linked(docs)
    joined = rows.join(named, "set_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns; of rows equal in id and text one stays."""
    kept = judge(docs).filter("kept").groupBy(F.col("doc_id").alias("kept_id")).agg((F.count(F.lit(1)) > 1).alias("repeated"))
    kept = base.saved(kept, "kept")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.kept_id"))
    staying = lambda table: docs.alias("d").join(table.select("kept_id").alias("k"), same, "left_semi")
    repeated = kept.filter("repeated")
    if repeated.isEmpty():
        return staying(kept)
    return staying(kept.filter("not repeated")).unionByName(staying(repeated).dropDuplicates(["doc_id", "text"]))
