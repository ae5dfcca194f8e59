"""Streams give what a batch gives, and survive a repeat."""

import datetime as dt
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.sources import audit, envelopes, lake
from usagelens.streaming import feeds
from workload import derive

DAY = dt.date(2024, 2, 1)


def keyed(df):
    return sorted(map(str, df.collect()))


def delivered(spark, records, path, parts=3):
    records.repartition(parts).write.mode("append").json(path)


def test_log_stream_equals_batch(spark, sf_dir, folder):
    records = derive.log_records(spark, sf_dir)
    delivered(spark, records, f"{folder}/in")
    stream = feeds.read_records(spark, f"{folder}/in", max_bytes=1)
    query = feeds.ingest_logs(stream, "chat_logs", f"{folder}/lake", f"{folder}/cp", ingest_date=DAY, continuous=False)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 2

    events = envelopes.transform_log_records(records, "chat_logs")
    columns = schemas.feed("chat_logs").data.names
    landed = lake.read_raw(spark, f"{folder}/lake", "chat_logs")
    assert keyed(landed.select(columns)) == keyed(envelopes.usable(events).select(columns))
    assert [tuple(r) for r in landed.select("year", "month", "day").distinct().collect()] == [(2024, 2, 1)]

    errors = f"{folder}/lake/{schemas.ERROR_PREFIX}/chat_logs"
    lost = spark.read.json(f"{errors}/events").select("record_id", "reason", "rejected_message")
    assert keyed(lost) == keyed(envelopes.rejected(events).select("record_id", "reason", "rejected_message"))
    failed = envelopes.route_records(records).filter(F.col("result") == envelopes.FAILED)
    assert keyed(spark.read.json(f"{errors}/records").select("record_id", "data")) == keyed(failed.select("record_id", "data"))
    aside = spark.read.json(f"{folder}/lake/{schemas.PASSTHROUGH_PREFIX}/chat_logs").select("record_id", "payload")
    assert aside.count() > 0
    assert keyed(aside) == keyed(envelopes.passthrough(records).select("record_id", "payload"))


def ingest(spark, folder, checkpoint):
    stream = feeds.read_records(spark, f"{folder}/in")
    feeds.ingest_logs(
        stream, "chat_logs", f"{folder}/lake", f"{folder}/{checkpoint}", ingest_date=DAY, continuous=False
    ).awaitTermination()
    errors = f"{folder}/lake/{schemas.ERROR_PREFIX}/chat_logs/*/*"
    return lake.read_raw(spark, f"{folder}/lake", "chat_logs").count(), spark.read.text(errors).count()


def test_a_batch_that_runs_twice_leaves_nothing_twice(spark, sf_dir, folder):
    delivered(spark, derive.log_records(spark, sf_dir), f"{folder}/in")
    first = ingest(spark, folder, "cp")
    for name in ("0", ".0.crc"):  # as if the driver died after writing, before committing
        os.remove(f"{folder}/cp/commits/{name}")
    assert ingest(spark, folder, "cp") == first


def test_a_new_checkpoint_adds_and_never_replaces(spark, sf_dir, folder):
    delivered(spark, derive.log_records(spark, sf_dir), f"{folder}/in")
    rows, errors = ingest(spark, folder, "cp")
    assert ingest(spark, folder, "another") == (2 * rows, 2 * errors)


def test_stream_goes_on_where_it_stopped(spark, sf_dir, folder):
    records = derive.audit_records(spark, sf_dir)
    first = F.crc32("record_id") % 2 == 0

    def run():
        stream = feeds.read_records(spark, f"{folder}/in")
        feeds.ingest_audit(stream, f"{folder}/lake", f"{folder}/cp", DAY, continuous=False).awaitTermination()
        return lake.read_raw(spark, f"{folder}/lake", "cloudtrail_events")

    delivered(spark, records.filter(first), f"{folder}/in")
    run()
    delivered(spark, records.filter(~first), f"{folder}/in")
    landed = run()
    flat = audit.flatten_audit(audit.filter_audit_feed(audit.read_audit_records(records)), F.lit(DAY))
    columns = schemas.feed("cloudtrail_events").data.names
    assert keyed(landed.select(columns)) == keyed(flat.select(columns))
    failed = glob.glob(f"{folder}/lake/errors/cloudtrail_events/records/batch=*/*.gz")
    assert failed


def test_arrival_day_defaults_to_the_clock(spark):
    got = feeds.with_arrival(spark.range(1)).first().arrival
    assert abs((dt.datetime.now(dt.timezone.utc).date() - got).days) <= 1


def test_refresh_replaces_only_days_that_changed(spark, folder):
    schema = schemas.feed("feedback_logs").schema
    prefix = f"{folder}/raw/{schemas.PREFIXES['feedback_logs']}"

    def land(*rows):
        df = spark.createDataFrame(list(rows), "user_arn string, year int, month int, day int")
        lake.land(lake.ensure_columns(df, schema), prefix)

    def refresh():
        feeds.refresh_curated(spark, f"{folder}/raw", f"{folder}/cur", "feedback_logs", f"{folder}/cp").awaitTermination()
        rows = lake.read_curated(spark, f"{folder}/cur", "feedback_logs").collect()
        return sorted((r.user_arn, r.day) for r in rows)

    land(("a", 2024, 1, 1), ("b", 2024, 1, 2))
    assert refresh() == [("a", 1), ("b", 2)]
    files = set(glob.glob(f"{folder}/cur/feedback_logs/year=2024/month=1/day=1/*.parquet"))
    land(("c", 2024, 1, 2), ("d", 2024, 1, 3))
    assert refresh() == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]
    assert set(glob.glob(f"{folder}/cur/feedback_logs/year=2024/month=1/day=1/*.parquet")) == files
    assert refresh() == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]


def to_table(spark, stream, path):
    stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-cp").trigger(availableNow=True).start(
        path
    ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_redelivered_events_are_dropped(spark, sf_dir, folder):
    events = derive.source(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    events.unionAll(events).unionAll(events).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    got = to_table(spark, feeds.deduplicate(stream, "ts", delay="60 days"), f"{folder}/out")
    assert got.count() == got.select("event_id").distinct().count() == events.count()


def test_daily_activity_is_exact_and_closed(spark, sf_dir, folder):
    events = derive.source(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    events.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    got = {r.day: r for r in to_table(spark, feeds.daily_activity(stream, "ts", "user_id"), f"{folder}/out").collect()}
    exact = {
        r.day: r
        for r in events.groupBy(F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("calls"), F.count_distinct("user_id").alias("users"))
        .collect()
    }
    assert len(got) >= len(exact) - 2
    for day, r in got.items():
        assert r.calls == exact[day].calls
        assert r.active_users == exact[day].users


def test_daily_activity_with_late_and_repeated_rows(spark, folder):
    schema = "ts timestamp, user_id long"
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)

    def run(number, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        return {r.day.day: (r.calls, r.active_users) for r in to_table(spark, feeds.daily_activity(stream, "ts", "user_id", "1 day"), f"{folder}/out").collect()}

    # A user at both ends of a day is one, a row without a user is a call.
    assert run(1, (at(1, 0), 1), (at(1, 23), 1), (at(1, 5), 2), (at(2, 1), 1), (at(2, 2), None)) == {}
    # Late, but within the delay: the same user again and a new one. Nobody's state is lost between runs.
    assert run(2, (at(1, 12), 1), (at(1, 13), 3), (at(2, 23), 1)) == {}
    assert run(3, (at(4, 1), 9)) == {1: (5, 3), 2: (3, 1)}
    # Too late: the day is closed.
    assert run(4, (at(1, 12), 77), (at(8, 0), 9)) == {1: (5, 3), 2: (3, 1), 4: (1, 1)}


def test_a_repeated_batch_is_reported_once(spark, sf_dir, folder):
    records = derive.log_records(spark, sf_dir)
    delivered(spark, records, f"{folder}/in")
    ingest(spark, folder, "cp")
    report = feeds.ingest_days(spark, f"{folder}/lake", "chat_logs").collect()
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/cp/commits/{name}")
    ingest(spark, folder, "cp")
    assert feeds.ingest_days(spark, f"{folder}/lake", "chat_logs").collect() == report
    (day,) = report
    fates = {r.result: r["count"] for r in envelopes.route_records(records).groupBy("result").count().collect()}
    assert (day.day, day.ok, day.dropped, day.failed) == (DAY, fates["Ok"], fates["Dropped"], fates["ProcessingFailed"])
    assert day.unparseable == envelopes.rejected(envelopes.transform_log_records(records, "chat_logs")).count() > 0
    assert day.quarantined == 0


def test_one_refresh_at_a_time(spark, folder):
    schema = schemas.feed("feedback_logs").schema
    prefix = f"{folder}/raw/{schemas.PREFIXES['feedback_logs']}"

    def land(user, day):
        df = spark.createDataFrame([(user, 2024, 1, day)], "user_arn string, year int, month int, day int")
        lake.land(lake.ensure_columns(df, schema), prefix)

    def refresh():
        return feeds.refresh_once(spark, f"{folder}/raw", f"{folder}/cur", "feedback_logs", f"{folder}/cp")

    def days():
        return sorted(r.day for r in lake.read_curated(spark, f"{folder}/cur", "feedback_logs").collect())

    land("a", 1)
    assert refresh() and days() == [1]
    running, go_on, done = threading.Event(), threading.Event(), []
    real = lake.curate_days

    def slow(*args, **kwargs):
        running.set()
        go_on.wait(60)
        real(*args, **kwargs)

    lake.curate_days = slow
    try:
        land("b", 2)
        first = threading.Thread(target=lambda: done.append(refresh()))
        first.start()
        assert running.wait(60)
        land("c", 3)
        assert not refresh()  # during the first
        go_on.set()
        first.join()
    finally:
        lake.curate_days = real
    assert done == [True] and days() == [1, 2]
    assert refresh() and days() == [1, 2, 3]


@pytest.mark.parametrize("include", [False, True])
def test_content_opt_in_holds_from_delivery_to_table(spark, sf_dir, folder, include):
    turns = derive.source(spark, sf_dir, "conversations")
    delivered(spark, derive.conversation_records(spark, sf_dir), f"{folder}/in")
    feeds.ingest_logs(
        feeds.read_records(spark, f"{folder}/in"),
        "chat_logs",
        f"{folder}/raw",
        f"{folder}/cp",
        include_content=include,
        ingest_date=DAY,
        continuous=False,
    ).awaitTermination()
    feeds.refresh_curated(
        spark, f"{folder}/raw", f"{folder}/cur", "chat_logs", f"{folder}/cp2", include_content=include
    ).awaitTermination()
    curated = lake.read_curated(spark, f"{folder}/cur", "chat_logs", include_content=include)
    assert curated.count() == turns.count()
    ranged = lake.read_range(spark, f"{folder}/raw", "chat_logs", DAY, DAY, include_content=include)
    assert ranged.columns == curated.columns
    if include:
        asked = [r.user_message for r in curated.filter("user_message IS NOT NULL").collect()]
        assert sorted(asked) == sorted(r.text for r in turns.filter("role = 'user'").collect())
    else:
        assert not set(schemas.SENSITIVE) & set(curated.columns)
        landed = spark.read.text(f"{folder}/raw/{schemas.PREFIXES['chat_logs']}/*/*/*/*")
        assert landed.filter(F.col("value").contains("_message\":\"")).count() == 0
