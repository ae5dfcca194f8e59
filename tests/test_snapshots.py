"""Snapshots: changed days only, all or nothing, pruned reads, one refresh at a time."""

import datetime as dt
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from usagelens.operators import interact
from usagelens.sources import snapshots, store

SCHEMA = "event_time timestamp_ntz, user_name string, n int"


def rows(spark, *given):
    """Rows of (day of January 2024 or None, user, n)."""
    return spark.createDataFrame([(None if d is None else dt.datetime(2024, 1, d, 10), u, n) for d, u, n in given], SCHEMA)


def plain(given):
    return sorted((d or 0, u, -1 if n is None else n) for d, u, n in given)


def content(df):
    return plain((r.event_time and r.event_time.day, r.user_name, r.n) for r in df.collect())


def files(folder):
    return set(glob.glob(f"{folder}/s/data/event_day=*/run=*/*.parquet"))


FIRST = [(1, "a", 1), (1, "a", 1), (2, "b", None), (None, "c", 3)]


def test_only_changed_days_are_written(spark, folder):
    path = f"{folder}/s"
    day = lambda d: dt.date(2024, 1, d)
    assert snapshots.refresh(rows(spark, *FIRST), path) == [None, day(1), day(2)]
    before = files(folder)
    assert snapshots.refresh(rows(spark, *reversed(FIRST)).repartition(3), path) == []  # the same rows in another order
    assert files(folder) == before and snapshots.versions(spark, path) == [1]
    second = [*FIRST, (2, "b", 4), (3, "d", 5)]
    assert snapshots.refresh(rows(spark, *second), path) == [day(2), day(3)]
    assert {f for f in files(folder) - before if "event_day=2024-01-01" in f or "HIVE" in f} == set()
    got = snapshots.read(spark, path, rows(spark, *second).schema)
    assert content(got) == plain(second)
    # A repeated row more is a change, a day less as well.
    third = [r for r in second if r[0] != 2] + [(1, "a", 1)]
    assert snapshots.refresh(rows(spark, *third), path) == [day(1)]
    assert content(snapshots.read(spark, path, got.schema)) == plain(third)
    assert snapshots.vacuum(spark, path, keep=1) == 3
    assert content(snapshots.read(spark, path, got.schema)) == plain(third)


def test_a_null_value_is_not_an_empty_one(spark, folder):
    one, other = rows(spark, (1, None, 1)), rows(spark, (1, "", 1))
    snapshots.refresh(one, f"{folder}/s")
    assert snapshots.refresh(other, f"{folder}/s") == [dt.date(2024, 1, 1)]


def test_a_broken_write_leaves_the_last_snapshot(spark, folder):
    path, good = f"{folder}/s", rows(spark, *FIRST)
    snapshots.refresh(good, path)
    before = content(snapshots.read(spark, path, good.schema))
    added = rows(spark, *FIRST, (3, "x", 1), (4, "y", 1))
    # The states can be taken, the write of the fourth day breaks off.
    failing = added.withColumn("user_name", F.when(F.spark_partition_id() >= 0, F.col("user_name")))
    broken = failing.withColumn("n", F.when((F.col("user_name") == "y") & F.input_file_name().isNotNull(), F.raise_error(F.lit("disk full"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="disk full"):
        snapshots.refresh(broken, path)
    assert content(snapshots.read(spark, path, good.schema)) == before
    real = spark.createDataFrame
    try:  # the rows are written, the version isn't

        def refuse(*args, **kwargs):
            raise OSError("store gone")

        spark.createDataFrame = refuse
        with pytest.raises(OSError):
            snapshots.refresh(added, path)
    finally:
        spark.createDataFrame = real
    assert content(snapshots.read(spark, path, good.schema)) == before
    assert snapshots.refresh(added, path) == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    assert len(content(snapshots.read(spark, path, good.schema))) == 6


def test_an_unfinished_version_does_not_count(spark, folder):
    path, good = f"{folder}/s", rows(spark, (1, "a", 1))
    snapshots.refresh(good, path)
    os.makedirs(f"{path}/versions/2")
    assert snapshots.versions(spark, path) == [1]
    snapshots.refresh(rows(spark, (1, "a", 2)), path)
    assert content(snapshots.read(spark, path, good.schema)) == [(1, "a", 2)]


def test_ranges_open_only_their_days(spark, folder):
    path = f"{folder}/s"
    data = rows(spark, *[(d, "u", d) for d in range(1, 31)], (None, "none", 0))
    snapshots.refresh(data, path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    now = dt.datetime(2024, 1, 20, 12)

    def days_of(df):
        return {f.split("event_day=")[1][:10] for f in df.inputFiles()}

    ranged = interact.snapshot_time_range(spark, path, data.schema, now, dt.datetime(2024, 1, 18, 11))
    last = interact.snapshot_last_days(spark, path, data.schema, now, days=3)
    for df in (ranged, last):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "event_day" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert days_of(ranged) == {"2024-01-18", "2024-01-19", "2024-01-20", "__HIVE_DEF"}
    assert days_of(last) == {"2024-01-17", "2024-01-18", "2024-01-19", "2024-01-20"}
    assert content(ranged) == content(interact.time_range(data, now, dt.datetime(2024, 1, 18, 11))) == [(0, "none", 0), (19, "u", 19), (20, "u", 20)]
    assert content(last) == content(interact.last_days(data, now, 3)) == [(18, "u", 18), (19, "u", 19), (20, "u", 20)]
    assert interact.snapshot_last_days(spark, path, data.schema, dt.datetime(2023, 5, 1)).count() == 0


def test_tables_without_rows_or_times(spark, folder):
    empty = rows(spark)
    assert snapshots.refresh(empty, f"{folder}/s") == []
    assert snapshots.read(spark, f"{folder}/s", empty.schema).collect() == []
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, f"{folder}/none", empty.schema)
    for n in (5, 2):
        snapshots.refresh(spark.range(n), f"{folder}/t")
    assert snapshots.read(spark, f"{folder}/t", spark.range(1).schema).count() == 2


def test_leases(spark, folder):
    path = f"{folder}/lease"
    first = store.acquire(spark, path, seconds=60, now=1000.0)
    assert first and store.acquire(spark, path, now=1030.0) is None
    second = store.acquire(spark, path, now=1061.0)  # past its time
    assert second and not first.is_mine() and second.is_mine()
    second.release()
    assert store.acquire(spark, path) is not None


def test_of_many_callers_one_gets_the_lease(spark, folder):
    got, start = [], threading.Barrier(6)

    def call():
        start.wait()
        got.append(store.acquire(spark, f"{folder}/lease"))

    threads = [threading.Thread(target=call) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len([x for x in got if x]) == 1


def test_a_second_refresh_does_not_run(spark, folder):
    path, data = f"{folder}/s", rows(spark, *FIRST)
    lease = store.acquire(spark, f"{path}/leases")
    assert snapshots.refresh(data, path) is None and snapshots.versions(spark, path) == []
    lease.release()
    assert snapshots.refresh(data, path) is not None
    # A run that outlives its lease does not publish.
    mine = store.acquire(spark, f"{path}/leases", seconds=-1)
    assert store.acquire(spark, f"{path}/leases")
    with pytest.raises(RuntimeError, match="taken over"):
        snapshots._refresh(rows(spark, (9, "z", 9)), path, mine)
    assert snapshots.versions(spark, path) == [1]
