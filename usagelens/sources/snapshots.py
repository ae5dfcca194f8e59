"""Dataset snapshots by event day.

Layout: ``<path>/data/event_day=YYYY-MM-DD/run=<id>/`` holds rows, those without a time
under the day NULL; ``<path>/versions/<n>/`` lists, for each day, the run that holds it,
its rows and a checksum. A reader takes the last version, so it sees either all or nothing
of a refresh, and a refresh that fails leaves the last version as it was. Only days whose
rows have changed are written again; the others stay where they are.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import expressions as E
from usagelens.operators import aggregate
from usagelens.sources import store

DAY, RUN = "event_day", "run"
VERSION = f"{DAY} date, {RUN} string, row_count long, checksum decimal(38,0)"
KEPT_VERSIONS = 2


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are complete."""
    found = (n for n in store.names(spark, f"{path}/versions") if n.isdigit())
    return sorted(int(n) for n in found if "_SUCCESS" in store.names(spark, f"{path}/versions/{n}"))


def version(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Days of a version: a short list, one row a calendar day."""
    return spark.read.schema(VERSION).parquet(f"{path}/versions/{number}")


def by_day(df: DataFrame) -> DataFrame:
    """The rows with their event day."""
    day = E.calendar_day(F.col(aggregate.DATE_COLUMN)) if aggregate.DATE_COLUMN in df.columns else F.lit(None).cast("date")
    return df.withColumn(DAY, day)


def day_states(dated: DataFrame) -> DataFrame:
    """Rows and checksum of each day; the checksum does not depend on the order of rows, and counts repeated ones."""
    columns = sorted(c for c in dated.columns if c != DAY)
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])  # a bare NULL would not count
    return dated.groupBy(DAY).agg(F.count(F.lit(1)).alias("row_count"), F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("checksum"))


def refresh(df: DataFrame, path: str) -> list[dt.date | None] | None:
    """Bring a snapshot up to date; returns the days written, None if another refresh is at work.

    ``df`` must not read from ``path``. It is read once for the days' states and once
    more for the days that have changed; rows that change between the two make the
    next refresh write that day again.
    """
    spark = df.sparkSession
    with store.one_at_a_time(spark, f"{path}/leases") as lease:
        return None if lease is None else _refresh(df, path, lease)


def _refresh(df: DataFrame, path: str, lease: store.Lease) -> list[dt.date | None]:
    spark, run = df.sparkSession, uuid.uuid4().hex
    dated, known = by_day(df), versions(spark, path)
    now = {r[DAY]: (r.row_count, r.checksum) for r in day_states(dated).collect()}
    last = {r[DAY]: r for r in version(spark, path, known[-1]).collect()} if known else {}
    changed = [d for d, state in now.items() if d not in last or (last[d].row_count, last[d].checksum) != state]
    if known and not changed and set(last) == set(now):
        return []
    if changed or not known:
        rows = dated.filter(any_day(changed)).withColumn(RUN, F.lit(run)).hint("rebalance", F.col(DAY))
        rows.write.mode("append").partitionBy(DAY, RUN).parquet(f"{path}/data")
    listed = [(d, run if d in changed else last[d][RUN], *state) for d, state in now.items()]
    if not lease.is_mine():
        raise RuntimeError(f"another refresh of {path} has taken over")
    number = (known[-1] if known else 0) + 1
    # A version that never became complete may be in the way.
    store.delete(spark, f"{path}/versions/{number}")
    spark.createDataFrame(listed, VERSION).coalesce(1).write.parquet(f"{path}/versions/{number}")
    return sorted(changed, key=lambda d: (d is not None, d))


def any_day(days: list[dt.date | None]) -> Column:
    """Predicate for a set of days, among them NULL."""
    named = F.col(DAY).isin([d for d in days if d is not None])
    return named | F.col(DAY).isNull() if None in days else named


def read(spark: SparkSession, path: str, schema: T.StructType, start: dt.date | None = None, end: dt.date | None = None, undated: bool = True) -> DataFrame:
    """Rows of the last version, of the days from start to end where given; ``undated`` keeps rows without a time.

    Only the folders of the days asked for are listed, and a predicate on the days
    stays in the plan, for readers that narrow it further.
    """
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no snapshot at {path}")
    listed = version(spark, path, known[-1]).collect()
    found = [r for r in listed if (undated if r[DAY] is None else (not start or r[DAY] >= start) and (not end or r[DAY] <= end))]
    if not found:
        return spark.createDataFrame([], schema)
    base = f"{path}/data"
    folders = [f"{base}/{DAY}={r[DAY] or '__HIVE_DEFAULT_PARTITION__'}/{RUN}={r[RUN]}" for r in found]
    typed = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(typed).option("basePath", base).parquet(*folders)
    if start or end:
        inside = F.lit(True)
        if start:
            inside &= F.col(DAY) >= F.lit(start)
        if end:
            inside &= F.col(DAY) <= F.lit(end)
        rows = rows.filter(F.col(DAY).isNull() | inside if undated else inside)
    return rows.select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Delete folders that none of the last ``keep`` versions names, and the versions before; returns the folders deleted.

    Not while a refresh is at work: its folders are in no version yet.
    """
    with store.one_at_a_time(spark, f"{path}/leases") as lease:
        if lease is None:
            return 0
        known, gone = versions(spark, path), 0
        live = {(r[DAY], r[RUN]) for n in known[-keep:] for r in version(spark, path, n).collect()}
        named = {f"{DAY}={d or '__HIVE_DEFAULT_PARTITION__'}/{RUN}={r}" for d, r in live}
        for day in store.names(spark, f"{path}/data"):
            if day.startswith(DAY):
                for run in store.names(spark, f"{path}/data/{day}"):
                    if f"{day}/{run}" not in named:
                        store.delete(spark, f"{path}/data/{day}/{run}")
                        gone += 1
        for n in known[:-keep]:
            store.delete(spark, f"{path}/versions/{n}")
        return gone
