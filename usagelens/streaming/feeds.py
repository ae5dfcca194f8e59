"""Continuous ingest with Structured Streaming.

Batch and stream share the transforms of :mod:`usagelens.sources`. Progress and
state live under a checkpoint folder the caller names, which must be one every
executor can reach; a restarted query goes on from there.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from usagelens import schemas
from usagelens.sources import audit, envelopes, lake, store

# --- fixed value: how long a delivery buffers -----------------------------------
BUFFER_SECONDS = 900
# --- end of fixed value ---------------------------------------------------------

RECORDS = "record_id string, data string"
FILE_LISTING = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]


def read_records(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """Delivered records as a stream of JSON-lines files.

    A batch takes all that has come since the last one; ``max_bytes`` bounds it,
    for working off a backlog in steps. Spark's input splits (128 MB by default)
    set how much one written file holds.
    """
    reader = spark.readStream.schema(RECORDS)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.json(path)


def with_arrival(records: DataFrame, ingest_date: dt.date | None = None) -> DataFrame:
    """Add the arrival day: the given date, else the batch's own.

    On a stream the batch's time is kept with its offsets, so a batch that runs
    again after a failure gets the same day.
    """
    return records.withColumn("arrival", F.lit(ingest_date) if ingest_date else F.to_date(F.current_timestamp()))


def _trigger(continuous: bool) -> dict:
    return {"processingTime": f"{BUFFER_SECONDS} seconds"} if continuous else {"availableNow": True}


def _deliver(records: DataFrame, write, checkpoint: str, continuous: bool) -> StreamingQuery:
    """Call ``write(batch, name)`` per batch, under a name only a retry uses again.

    Batch numbers start over with a new checkpoint, so the name also tells the
    checkpoint: a second query into the same folders adds to the first's rows.
    """
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]
    return (
        records.writeStream.foreachBatch(lambda batch, number: write(batch, f"{query}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(continuous))
        .start()
    )


def ingest_logs(
    records: DataFrame,
    table: str,
    root: str,
    checkpoint: str,
    include_content: bool = False,
    ingest_date: dt.date | None = None,
    continuous: bool = True,
) -> StreamingQuery:
    """Stream a log feed into its landing folders, failures into the error prefix.

    Payloads without log events are kept as they came, under their own prefix.
    Every write of a batch goes to folders named after the batch and replaces
    them, so a batch that is retried leaves nothing twice. Records are decoded
    and messages parsed once: all writes share the same kept rows, and the batch's
    counts (see :func:`ingest_days`) are observed while these writes run.
    """
    prefix = schemas.feed(table).prefix

    def write(batch: DataFrame, name: str) -> None:
        routed = envelopes.with_result(envelopes.read_envelopes(envelopes.decode_envelopes(batch)))
        read = envelopes.kept_parts(routed).persist()
        events = envelopes.transform_envelopes(read.drop("result"), table, include_content).persist()
        records, rows = Observation(), Observation()
        try:
            counted = events.observe(rows, F.count_if(F.col("reason").isNotNull()).alias("unparseable"))
            _write_batch(envelopes.usable(counted).drop("record_id"), f"{root}/{prefix}", name)
            lost = envelopes.rejected(events).select("record_id", "reason", "rejected_message")
            _write_errors(lost, root, table, "events", name)
            routed = read.observe(records, *_fates(F.col("result")))
            _write_errors(routed.filter("kind = 'unreadable'").select("record_id", "data"), root, table, "records", name)
            kept = read.filter("kind = 'passthrough'").select("record_id", "payload")
            _write_aside(kept, f"{root}/{schemas.PASSTHROUGH_PREFIX}/{table}", name)
            _write_report(batch.sparkSession, records.get | rows.get, root, table, name)
        finally:
            events.unpersist()
            read.unpersist()

    return _deliver(with_arrival(records, ingest_date), write, checkpoint, continuous)


def ingest_audit(
    records: DataFrame,
    root: str,
    checkpoint: str,
    ingest_date: dt.date | None = None,
    continuous: bool = True,
) -> StreamingQuery:
    """Stream the audit feed into its landing folders, failures into the error prefix."""
    prefix = schemas.PREFIXES["cloudtrail_events"]

    def write(batch: DataFrame, name: str) -> None:
        read = audit.kept_parts(audit.read_audit_records(batch)).persist()
        records = Observation()
        try:
            flat = audit.flatten_audit(audit.filter_audit_feed(read), F.col("arrival"), carry=["arrival"])
            _write_batch(flat, f"{root}/{prefix}", name)
            routed = read.observe(records, *_fates(F.col("fate")), F.lit(0).cast("long").alias("unparseable"))
            failed = routed.filter(F.col("fate") == envelopes.FAILED).select("record_id", "data")
            _write_errors(failed, root, "cloudtrail_events", "records", name)
            _write_report(batch.sparkSession, records.get, root, "cloudtrail_events", name)
        finally:
            read.unpersist()

    return _deliver(with_arrival(records, ingest_date), write, checkpoint, continuous)


def _write_batch(df: DataFrame, path: str, name: str) -> None:
    """One batch into the folder of its arrival day, and in it of its batch."""
    lake.land_batch(lake.place(df, F.col("arrival")).drop("arrival"), path, name)


def _write_errors(df: DataFrame, root: str, table: str, kind: str, name: str) -> None:
    _write_aside(df, f"{root}/{schemas.ERROR_PREFIX}/{table}/{kind}", name)


def _write_aside(df: DataFrame, path: str, name: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(f"{path}/batch={name}")


# --- The ingest report ----------------------------------------------------------

FATES = {"ok": envelopes.OK, "dropped": envelopes.DROPPED, "failed": envelopes.FAILED}
REPORT = "arrival date, ok long, dropped long, failed long, unparseable long"


def _fates(result: Column) -> list[Column]:
    """A batch's arrival day and its numbers of records by fate."""
    counts = [F.count_if(result.eqNullSafe(F.lit(fate))).alias(name) for name, fate in FATES.items()]
    return [F.max("arrival").alias("arrival"), *counts]


def _write_report(spark: SparkSession, counts: dict, root: str, table: str, name: str) -> None:
    row = [counts.get(c) for c in ("arrival", *FATES, "unparseable")]
    _write_aside(spark.createDataFrame([row], REPORT).coalesce(1), f"{root}/{schemas.REPORT_PREFIX}/{table}", name)


def ingest_days(spark: SparkSession, root: str, table: str, curated_root: str | None = None) -> DataFrame:
    """What became of a feed's deliveries, by arrival day.

    Records that were landed or passed on (``ok``), held nothing to land
    (``dropped``) or could not be read (``failed``); log events kept under the error
    prefix (``unparseable``); with the curated root, landed lines in quarantine. The
    batches have counted themselves, so this reads a row a batch, and the quarantine.
    """
    counts = [*FATES, "unparseable"]
    batches = spark.read.schema(REPORT).json(f"{root}/{schemas.REPORT_PREFIX}/{table}").filter("arrival IS NOT NULL")
    days = batches.groupBy(F.col("arrival").alias("day")).agg(*[F.sum(c).alias(c) for c in counts])
    if curated_root is None:
        return days.withColumn("quarantined", F.lit(0).cast("long"))
    lines = lake.landed_days(lake.read_quarantine(spark, curated_root, table)).withColumnRenamed("row_count", "quarantined")
    lines = lines.select(F.make_date(*schemas.PARTITION_COLUMNS).alias("day"), "quarantined")
    both = days.join(lines, "day", "full_outer")
    return both.select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in (*counts, "quarantined")])


# --- The refresh ----------------------------------------------------------------


def refresh_once(
    spark: SparkSession, raw_root: str, curated_root: str, table: str, checkpoint: str, include_content: bool = False, seconds: float = store.LEASE_SECONDS
) -> bool:
    """Run :func:`refresh_curated` to its end unless another run is at it; whether it ran.

    Runs of a table take turns by a lease beside its progress. One that finds the
    lease taken does nothing: what has landed stays unseen by the checkpoint, so that
    the next run takes it up.
    """
    with store.one_at_a_time(spark, f"{checkpoint.rstrip('/')}-leases", seconds) as lease:
        if lease is None:
            return False
        refresh_curated(spark, raw_root, curated_root, table, checkpoint, include_content).awaitTermination()
        return True


def refresh_curated(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    table: str,
    checkpoint: str,
    include_content: bool = False,
) -> StreamingQuery:
    """Bring a curated table up to date with what landed since the last run.

    New files only tell which days changed. Those days are then read whole and
    replaced, so late files and repeated runs leave no duplicates. The caller
    schedules the runs, one at a time; :func:`refresh_once` sees to that itself.
    """
    feed = schemas.feed(table, include_content)
    lake.create_table(spark, curated_root, table, include_content)
    # Listed, not read: only the folder names of new files are used.
    listing = T.StructType(FILE_LISTING + schemas.PARTITION_SCHEMA.fields)
    landed = spark.readStream.format("binaryFile").schema(listing).load(f"{raw_root}/{feed.prefix}")
    landed = landed.select(*schemas.PARTITION_COLUMNS)  # else the files' content is read, too

    def replace_days(batch: DataFrame, _batch_id: int) -> None:
        # Calendar days: a short list, which prunes the folders read below.
        touched = [dt.date(*row) for row in batch.select(*schemas.PARTITION_COLUMNS).distinct().collect()]
        if touched:
            lake.curate_days(spark, raw_root, curated_root, table, touched, include_content)

    return (
        landed.writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def deduplicate(events: DataFrame, time: str, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """Drop events delivered again within ``delay`` of each other.

    State holds the keys of that span only.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def daily_activity(events: DataFrame, time: str, user: str, delay: str = "1 day") -> DataFrame:
    """Calls and active users per closed day, both exact; later rows are dropped.

    Two stateful steps: calls per day and user, closed with the day, then their sum
    and number per day. The first spreads its state by user, over the workers' disks;
    the second gets a row for each user and day, summed before it is shuffled. A row
    without a user counts as a call.
    """
    per_user = events.withWatermark(time, delay).groupBy(F.window(time, "1 day"), F.col(user).alias("user")).agg(F.count(F.lit(1)).alias("calls"))
    days = per_user.groupBy(F.window("window", "1 day")).agg(F.sum("calls").alias("calls"), F.count("user").alias("active_users"))
    return days.select(F.to_date("window.start").alias("day"), "calls", "active_users")
