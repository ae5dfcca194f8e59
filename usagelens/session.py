"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_SCRATCH = "usagelens.local.scratch"

# Settings the library relies on. The zone fixes the text <-> time rules; the
# partition overwrite mode keeps re-runs idempotent (see sources.lake).
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keys of streams on the workers' disks, not in their heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Upper bounds, in bytes or rows. Gzipped files take many times their size when a task has
# read them, and a row that goes to Python may be a whole delivered payload.
AT_MOST = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
}
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def size(text: str) -> int:
    """A setting such as 64, 64b, 16m or 16mb as a number."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << _UNITS[unit]


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings the library relies on; a session that has set less than an upper bound keeps it."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key, most in AT_MOST.items():
        if not 0 < size(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("usagelens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local session may do
    without it; it then gets a temporary folder of its own, under LOCAL_SCRATCH,
    since Spark does not let a running session set the other.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SCRATCH, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="usagelens-")
        spark.conf.set(LOCAL_SCRATCH, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
