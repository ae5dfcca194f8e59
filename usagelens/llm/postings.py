"""Approximate nearest neighbours over balanced posting lists.

Equal vectors are one entry, which holds as many of their smallest ids as a result
can name (``entries``). Centroids come from a bounded sample by balanced splitting
(``fit``); a graph joins each to its nearest ones, and ``Graph.search`` walks it, many
vectors at a time, from a set of entry points. A vector goes to its nearest list and,
near a boundary, to others: up to ``REPLICAS`` whose centroids are within ``REPLICATE``
times the nearest distance (``assign``). Lists are cut into parts of ``PART_ROWS`` entries, so the largest list is
no larger a task than any other. A query searches the graph likewise and reads all
lists within ``PROBE`` times the distance of its ``RANK``-th nearest centroid, ``MIN_PROBES``
at least (``probes``); each part's distances to its queries are computed in blocks.

Every vector is in a list; only the centroids come from a sample (``SAMPLE_BYTES``,
drawn by a hash of the id). Recall against brute force is measured in the tests.

Defined cases: vectors that are null, zero, or hold null or non-finite components, rows
without id, and vectors of another length than most (ties: the shorter) take no part;
rows that repeat both id and vector are one; an id with several vectors is a candidate,
and a query, with each of them, and only the row itself is left out of its result;
equal distances are ordered by id; with fewer candidates than asked for all are
returned; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm import base

NEAREST = 10
EVERY = 100  # a row is a query if its id is divisible by this

LIST_ROWS = 512  # entries of a list, as long as the centroids stay within CENTROID_BYTES
CENTROID_BYTES = 32 << 20
SAMPLE_BYTES = 64 << 20
SAMPLE_PER_LIST = 64
TURNS = 8  # of each split
BRANCHES = 8  # parts of a split
DEGREE = 24  # neighbours of a centroid
BEAM = 48  # centroids a search keeps
ENTRIES = 64  # centroids a search starts from
REPLICAS = 2
REPLICATE = 1.02
PROBE = 1.14
RANK = 3  # of the centroid whose distance PROBE refers to: the nearest may stand for the query and its copies alone
MIN_PROBES = 16
PART_ROWS = 4096
QUERY_ROWS = 1024
BLOCK = 256  # vectors that walk the graph together

ENTRY = "entry long, vector array<float>, ids array<long>"


# --- Centroids --------------------------------------------------------------------


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and y."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)
    return np.maximum(d, 0, out=d)


def split(rows: np.ndarray, k: int, turns: int) -> np.ndarray:
    """Balanced parts of rows: in each turn a part takes its nearest rows until it has its share.

    Rows choose in the order of what they would lose by their second choice.
    """
    n = len(rows)
    room = -(-n // k)
    centres = rows[np.linspace(0, n - 1, k).astype(int)]
    part = np.zeros(n, np.int64)
    for _ in range(turns):
        d = squared(rows, centres)
        near = np.sort(d, 1)
        part = np.full(n, -1, np.int64)
        left = np.full(k, room)
        waiting = np.argsort(near[:, 0] - near[:, 1], kind="stable")
        while len(waiting):
            choice = np.where(left[None] > 0, d[waiting], np.inf).argmin(1)
            for c in range(k):
                own = waiting[choice == c][: left[c]]
                part[own] = c
                left[c] -= len(own)
            waiting = waiting[part[waiting] < 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, part, rows)
        count = np.bincount(part, minlength=k)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return part


def fit(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of about ``lists`` balanced groups of the sample, split again and again."""
    done, groups = [], [(sample, lists)]
    while groups:
        rows, k = groups.pop()
        if k <= 1 or len(rows) <= 1:
            if len(rows):
                done.append(rows.mean(0))
            continue
        branches = min(k, BRANCHES, len(rows))
        part = split(rows, branches, TURNS)
        shares = np.diff(np.linspace(0, k, branches + 1).astype(int))
        groups += [(rows[part == c], int(shares[c])) for c in range(branches)]
    return np.unique(np.array(done, np.float32), axis=0)


@dataclass
class Graph:
    """Centroids and their neighbours."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Graph:
        n = len(centroids)
        degree = min(DEGREE, n - 1)
        near = np.zeros((n, degree), np.int32)
        for a in range(0, n, 1024):
            d = squared(centroids[a : a + 1024], centroids)
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            if degree:
                near[a : a + 1024] = np.argpartition(d, degree - 1, 1)[:, :degree]
        return cls(centroids, near, np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int32))

    def search(self, vectors: np.ndarray, ratio: float, rank: int, least: int, beam: int = BEAM) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the centroids within ratio times the distance of its rank-th nearest, and the ``least``
        nearest anyway, nearest first, with their squared distances.

        First every vector goes on from its nearest centroid that it hasn't left yet, until all of a beam are
        left; then from all centroids within the ratio, until no new one is found. So no number cuts the result.
        """
        n, size, degree = len(vectors), len(self.centroids), self.neighbours.shape[1]
        rows = np.arange(n)[:, None]
        norms, own = ((x * x).sum(1) for x in (self.centroids, vectors))
        seen, done = np.zeros((n, size), bool), np.zeros((n, size), bool)

        def distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
            return np.maximum(own[q] + norms[c] - 2 * np.einsum("ij,ij->i", self.centroids[c], vectors[q]), 0)

        at = np.repeat(self.entries[None], n, 0)
        far = squared(vectors, self.centroids[self.entries])
        seen[:, self.entries] = True
        met = [(np.repeat(np.arange(n), at.shape[1]), at.ravel(), far.ravel())]  # all pairs of vector and centroid with a distance
        while degree:
            order = np.argsort(far, 1, kind="stable")[:, :beam]
            at, far = at[rows, order], far[rows, order]
            open_ = ~done[rows, at] & np.isfinite(far)
            going = np.flatnonzero(open_.any(1))
            if not len(going):
                break
            step = at[going, open_[going].argmax(1)]
            done[going, step] = True
            to, d = np.zeros((n, degree), np.int32), np.full((n, degree), np.inf, np.float32)
            to[going] = self.neighbours[step]
            i, j = np.nonzero(~seen[going[:, None], to[going]])
            q, c = going[i], to[going[i], j]
            d[q, j] = distances(q, c)
            seen[q, c] = True
            met.append((q, c, d[q, j]))
            at, far = np.concatenate((at, to), 1), np.concatenate((far, d), 1)
        last = np.isfinite(far).sum(1) - 1  # the beam is in order, what it hasn't is at its end
        row = np.arange(n)
        limit = np.maximum(ratio**2 * far[row, np.minimum(last, rank - 1)], far[row, np.minimum(last, least - 1)])
        q, c, d = (np.concatenate(x) for x in zip(*met, strict=True))
        kept = d <= limit[q]
        met = [(q[kept], c[kept], d[kept])]
        q, c = (x[~done[q[kept], c[kept]]] for x in met[0][:2])
        while degree and len(q):
            done[q, c] = True
            new = (q[:, None] * size + self.neighbours[c]).ravel()
            new = np.unique(new[~seen.ravel()[new]])
            q, c = new // size, new % size
            seen[q, c] = True
            d = distances(q, c)
            near = d <= limit[q]
            q, c = q[near], c[near]
            met.append((q, c, d[near]))
        q, c, d = (np.concatenate(x) for x in zip(*met, strict=True))
        order = np.lexsort((c, d, q))
        ends = np.searchsorted(q[order], np.arange(1, n))
        return list(zip(np.split(c[order], ends), np.split(d[order], ends), strict=True))


def assign(graph: Graph, vectors: np.ndarray) -> list[list[int]]:
    """The lists of each vector, its nearest first."""
    return [lists[:REPLICAS].tolist() for lists, _ in graph.search(vectors, REPLICATE, 1, 1)]


def probes(graph: Graph, vectors: np.ndarray) -> list[list[int]]:
    """The lists that each query reads."""
    return [lists.tolist() for lists, _ in graph.search(vectors, PROBE, RANK, MIN_PROBES)]


# --- Entries ----------------------------------------------------------------------


def usable(table: DataFrame) -> DataFrame:
    """id and vector of the rows that take part, each pair once."""
    ok = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector")).withColumnRenamed("vector", "embedding")
    rows = rows.filter(F.col("id").isNotNull() & ok).select("id", F.col("embedding").alias("vector"))
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vector") == (length.length if length else 0)).distinct()


def entries(rows: DataFrame, ids: int) -> DataFrame:
    """Distinct vectors, each with its smallest ids. The rank is cut before the shuffle, so a vector that many rows share moves a few ids a task."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.withColumn("rank", rank).filter(F.col("rank") <= ids)
    return first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "vector", "ids")


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    flat = np.array(column.flatten(), dtype)
    return flat.reshape(len(column), -1)


def index(found: DataFrame) -> Graph | None:
    """The graph of centroids, from a sample of entries drawn by a hash of their id; None without an entry."""
    n = found.count()
    if not n:
        return None
    width = 4 * found.select(F.size("vector")).first()[0]
    lists = max(1, min(-(-n // LIST_ROWS), CENTROID_BYTES // width))
    size = min(n, lists * SAMPLE_PER_LIST, max(lists, SAMPLE_BYTES // width))
    drawn = found.select("vector", F.xxhash64("entry").alias("h"), "entry").orderBy("h", "entry").limit(size)
    sample = np.array([r.vector for r in drawn.select(F.col("vector").cast("array<float>").alias("vector")).toLocalIterator()], np.float32)
    return Graph.of(fit(sample, lists))


def listed(found: DataFrame, graph: Graph, choose, kind: str) -> DataFrame:
    """Rows (list, first, entry, vector, ...) for the lists that choose gives to each vector; first marks its nearest."""
    # At most CENTROID_BYTES and their neighbours: bounded, whatever the table's size.
    told = found.sparkSession.sparkContext.broadcast((graph.centroids, graph.neighbours, graph.entries))

    def make():
        graph = Graph(*told.value)

        def act(batch):
            vectors, lists = matrix(batch.column("vector"), np.float32), []
            for a in range(0, len(vectors), BLOCK):
                lists += choose(graph, vectors[a : a + BLOCK])
            place = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            first = [k == 0 for x in lists for k in range(len(x))]
            return [[k for x in lists for k in x], first, *(batch.column(c).take(place) for c in batch.schema.names)]

        return act

    return base.map_batches(found, make, kind)


# --- Search -----------------------------------------------------------------------


def nearest_in(query_ids: np.ndarray, queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[int, int, float]]:
    """Each query's k nearest ids of some entries: exact distances of those that a first pass finds near enough."""
    out = []
    sizes = np.array([len(x) for x in ids])
    for a in range(0, len(queries), 64):
        own = queries[a : a + 64]
        rough = squared(own, vectors)
        keep = min(k, len(vectors))
        # The rough distance may be off by rounding: a margin keeps what could be among the nearest.
        bound = np.partition(rough, keep - 1, 1)[:, keep - 1]
        margin = 1e-9 * ((own * own).sum(1) + (vectors * vectors).sum(1).max())
        for q, close, limit in zip(range(a, a + len(own)), rough, bound + margin, strict=True):
            near = np.flatnonzero(close <= limit)
            d = vectors[near] - queries[q]
            exact = np.sqrt((d * d).sum(1))
            rows = sorted((s, i) for s, e in zip(np.repeat(exact, sizes[near]).tolist(), [i for e in near for i in ids[e]], strict=True) for i in [e])[:k]
            out += [(int(query_ids[q]), i, s) for s, i in rows]
    return out


def search(table: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """For each query row (vec_id, embedding): the k nearest rows of the table but for the query's own.

    Queries and candidates follow the same rules; equal query vectors are searched once.
    """
    rows, asked = (base.saved(usable(x), name) for x, name in ((table, "vectors"), (queries, "queries")))
    return answered(rows, asked, k)


def answered(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = rows.sparkSession
    found = base.saved(entries(rows, k + 1), "entries")
    result = "query_id long, rank int, vec_id long, score double"
    graph = index(found)
    if graph is None:
        return spark.createDataFrame([], result)
    vectors = base.saved(listed(found, graph, assign, "list long, first boolean, entry long, vector array<double>, ids array<long>"), "postings")
    # Numbered and written, so that a number stays with its vector; an id may have several.
    single = base.saved(asked.select("vector").distinct().select(F.monotonically_increasing_id().alias("query"), "vector"), "query_vectors")
    probed = base.saved(listed(single, graph, probes, "list long, first boolean, query long, vector array<double>"), "probes")
    # A row for each list: their number is bounded with the centroids.
    sizes = {r.list: r["count"] for r in vectors.groupBy("list").count().collect()}
    blocks = {r.list: r["count"] for r in probed.groupBy("list").count().collect()}
    grid = spark.createDataFrame([(c, -(-n // PART_ROWS), -(-blocks[c] // QUERY_ROWS)) for c, n in sizes.items() if c in blocks], "list long, parts long, blocks long")
    # Each part of a list meets each block of its queries.
    cells = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = vectors.join(grid, "list").withColumn("part", F.pmod(F.xxhash64("entry"), "parts")).withColumn("block", cells("blocks"))
    right = probed.join(grid, "list").withColumn("block", F.pmod(F.xxhash64("query"), "blocks")).withColumn("part", cells("parts"))
    key = ["list", "part", "block"]
    left, right = left.select(*key, "vector", "ids"), right.select(*key, "query", "vector")
    types = base.arrow_schema(StructType.fromDDL("query long, id long, score double"))

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return types.empty_table()
        mine, theirs = mine.combine_chunks(), theirs.combine_chunks()
        got = nearest_in(
            np.array(theirs.column("query")), matrix(theirs.column("vector").chunk(0)), matrix(mine.column("vector").chunk(0)), mine.column("ids").to_pylist(), k + 1
        )
        return pa.Table.from_batches([base.record_batch(list(zip(*got, strict=True)), types)])

    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query long, id long, score double")
    # An entry in several lists is found several times.
    order = Window.partitionBy("query").orderBy("score", "id")
    best = near.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("near"))
    of = single.join(lists, "query").select("vector", "near")
    per_row = asked.join(of, "vector").select(F.col("id").alias("query_id"), "near")
    others = F.slice(F.filter("near", lambda x: (x["id"] != F.col("query_id")) | (x["score"] > 0)), 1, k)
    flat = per_row.select("query_id", F.posexplode(others).alias("place", "x"))
    return flat.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def judge(table: DataFrame, every: int = EVERY, k: int = NEAREST) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by ``every``."""
    rows = base.saved(usable(table), "vectors")
    return answered(rows, rows.filter(F.col("id") % every == 0), k)
