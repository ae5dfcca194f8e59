"""What several operators share: tables, saved steps, Arrow passes, words."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens import session

# What a Python worker gets at once: texts are long, so few rows, and fewer if they are very long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return session.prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back: a lost executor costs no more than the step it was in."""
    spark = df.sparkSession
    path = session.scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """Like saved, in buckets of a column: joins by it move the other side only."""
    spark = df.sparkSession
    path = session.scratch_dir(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(parts(spark), column).option("path", path).saveAsTable(table)
    written = spark.table(table)
    # The name was needed for the buckets only; what has been read off the catalog stays, and so do the files.
    spark.sql(f"DROP TABLE {table}")
    return written


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list | None]], schema: str) -> DataFrame:
    """Run a function on every Arrow batch of df.

    ``make()`` runs once a task, on the executor, and returns the function; that
    returns the columns of its result (lists or arrays) in the order of schema.
    """
    fields = StructType.fromDDL(schema)
    types = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        act = make()
        for batch in batches:
            if batch.num_rows:
                columns = act(batch)
                if columns is not None and len(columns[0]):
                    yield record_batch(columns, types)

    return df.mapInArrow(run, fields)


def arrow_schema(fields: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def record_batch(columns: list, types: pa.Schema) -> pa.RecordBatch:
    arrays = [c.cast(t.type) if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=types)


def local_table(spark: SparkSession, columns: list, schema: str) -> DataFrame:
    """A small table of the driver's columns. It comes as Arrow: from rows, Spark starts Python workers of another kind
    on every executor, with a daemon of their own that stays."""
    fields = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_batches([record_batch(columns, arrow_schema(fields))]), fields)


def worker_state(name: str) -> dict:
    """A dictionary that a Python worker keeps from task to task."""
    return sys.modules.setdefault(f"usagelens_state_{name}", types.ModuleType(name)).__dict__


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 texts of a batch; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one-to-one, so that all of their bits depend on all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def word_count(column: str = "text"):
    """Number of runs of other characters than ASCII white space; null: 0."""
    text = F.coalesce(F.col(column), F.lit(""))
    return F.regexp_count(text, F.lit(r"[^ \x09-\x0D]+")).cast("long")


# --- Bytes in bulk ----------------------------------------------------------------


BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept by the process and grown when needed."""
    state = worker_state("powers")
    have = state.get(str(base))
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        state[str(base)] = have
    return have[:n]


class Rolling:
    """Hashes of any substrings of data: equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE), out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(len(self.sums), _INVERSE)
        return mix((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of size bytes, by their start."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * powers(len(self.sums), _INVERSE)[:n] + np.uint64(size))


# --- Questions to all pages -------------------------------------------------------


def buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Cut points of sorted 64-bit keys into n ranges of equal width."""
    edges = [(i << 64) // n for i in range(1, n)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]))


ASKED = "page long, bucket int, keys binary, more binary"
ANSWERS = "page long, answers array<struct<bucket:int,answer:binary>>"


def ask(page: int, keys: np.ndarray, more: np.ndarray, n: int, width: int = 8) -> list[tuple]:
    """Rows that put sorted distinct keys, each with a value, to their buckets. width 4 keeps 32 bits within a bucket, for filters."""
    cut = buckets(keys, n)
    if width == 4:
        sent = ((keys * np.uint64(n)) >> np.uint64(32)).astype("<u4") if n < 1 << 31 else keys.astype("<u4")
    else:
        sent = keys.astype("<u8")
    return [(page, i, sent[a:b].tobytes(), more[a:b].tobytes()) for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a]


def answers(asked: DataFrame, reply: Callable[[np.ndarray, np.ndarray, bytes], np.ndarray], key_type: str, name: str) -> DataFrame:
    """Each page's answers, a byte for each key, in the order of its keys.

    A bucket holds the keys of a range from all pages; keys are spread evenly by
    their hash, and a page has put each key once, so a key that a third of all rows
    hold comes once from a page. ``reply(group, first, more)`` gets the number of
    each entry's key (0, 1, ... in order), the places where a key begins and the
    values end to end, all in order of the keys; its result is a byte per entry.
    """

    def bucket(rows: pa.Table) -> pa.Table:
        raw = rows.column("keys").to_pylist()
        sizes = np.array([len(x) for x in raw]) // np.dtype(key_type).itemsize
        keys = np.frombuffer(b"".join(raw), key_type)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        more = b"".join(rows.column("more").to_pylist())
        item = len(more) // max(1, len(keys))
        values = np.frombuffer(more, np.dtype(f"V{item}"))[order].tobytes() if item else b""
        out = np.empty(len(keys), np.uint8)
        out[order] = reply(np.cumsum(begins) - 1, np.flatnonzero(begins), values)
        cut = np.cumsum(sizes)
        parts_ = [out[b - n : b].tobytes() for b, n in zip(cut.tolist(), sizes.tolist(), strict=True)]
        return pa.table({"page": rows.column("page"), "bucket": rows.column("bucket"), "answer": pa.array(parts_, pa.binary())})

    told = asked.groupBy("bucket").applyInArrow(bucket, "page long, bucket int, answer binary")
    return saved(told.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("bucket", "answer"))).alias("answers")), name)


def answer_bytes(cell: list[dict] | None) -> np.ndarray:
    return np.frombuffer(b"".join(x["answer"] for x in cell or ()), np.uint8)


def page_number(count: int) -> int:
    """A number for the count-th page of this task that no other task gives."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 32 | count


# --- Connected components ---------------------------------------------------------


def nodes_of(links: DataFrame) -> DataFrame:
    """The nodes of links; each side is reduced first."""
    return links.select(F.col("a").alias("node")).distinct().unionByName(links.select(F.col("b").alias("node")).distinct()).distinct()


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Connected components of links (a, b): a table of node and label, the smallest node of its component.

    labels: what earlier links gave; nodes without a link and without a label are not
    listed. Each turn hooks every component to its smallest neighbour and shortens
    the paths of these hooks until every node points at a root.
    """
    spark = links.sparkSession
    if labels is None:
        labels = local_table(spark, [[], []], "node long, label long")
    nodes = nodes_of(links)
    labels = saved(labels.unionByName(nodes.join(labels, "node", "left_anti").withColumn("label", F.col("node"))), "labels")
    links = saved(links.select("a", "b").distinct(), "links")
    while True:
        of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
        between = links.join(of("a"), "a").join(of("b"), "b").filter("label_a != label_b")
        hooks = between.select(F.greatest("label_a", "label_b").alias("label"), F.least("label_a", "label_b").alias("to"))
        hooks = saved(hooks.groupBy("label").agg(F.min("to").alias("to")), "hooks")
        if hooks.isEmpty():
            return labels
        while True:
            further = hooks.select(F.col("label").alias("to"), F.col("to").alias("next"))
            jumped = saved(hooks.join(further, "to", "left").select("label", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            if jumped.filter("moved").isEmpty():
                break
            hooks = jumped.drop("moved")
        labels = saved(labels.join(hooks, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
