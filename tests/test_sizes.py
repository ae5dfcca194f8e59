"""What one task or one worker holds does not grow with the input."""

import datetime as dt
import glob
import gzip
import threading

import pytest
from pyspark.sql import functions as F

from usagelens import schemas, session
from usagelens.sources import audit, envelopes, lake
from usagelens.streaming import feeds
from workload import derive, registry

DAY = dt.date(2024, 2, 1)


def keyed(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("key", session.AT_MOST if hasattr(session, "AT_MOST") else ["spark.sql.files.maxPartitionBytes"])
def test_upper_bounds_of_the_session(spark, key):
    before, small = spark.conf.get(key), "512"
    try:
        spark.conf.set(key, "99000000")
        assert int(session.prepare(spark).conf.get(key)) == session.AT_MOST[key]
        spark.conf.set(key, small)
        assert session.prepare(spark).conf.get(key) == small
    finally:
        spark.conf.set(key, before)


def test_sizes_as_numbers():
    texts = {"64": 64, "64b": 64, "2k": 2048, "16m": 16 << 20, "16MB": 16 << 20, "1g": 1 << 30, " 5 ": 5, "-1": -1}
    assert {t: session.size(t) for t in texts} == texts


def test_delivered_files_are_bounded(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(registry, "FILE_RECORDS", 100, raising=False)
    x = registry.Inputs(spark, sf_dir)
    path = registry._delivered_files(x, x.audit_records, "records")
    lines = [sum(1 for _ in gzip.open(f)) for f in glob.glob(f"{path.removeprefix('file:')}/*.json.gz")]
    assert max(lines) <= 100 and sum(lines) == x.audit_records.count() > 100


def test_a_kept_batch_of_logs_holds_a_text_once(spark, sf_dir, folder, monkeypatch):
    derive.log_records(spark, sf_dir).write.json(f"{folder}/in")
    seen, make = [], envelopes.transform_envelopes

    def watch(read, *rest):
        seen.append((read.filter("kind = 'events'").count(), read.filter("kind = 'events' AND (data IS NOT NULL OR payload IS NOT NULL)").count()))
        return make(read, *rest)

    monkeypatch.setattr(envelopes, "transform_envelopes", watch)
    feeds.ingest_logs(feeds.read_records(spark, f"{folder}/in"), "chat_logs", f"{folder}/lake", f"{folder}/cp", ingest_date=DAY, continuous=False).awaitTermination()
    assert seen[0][0] > 0 and [x[1] for x in seen] == [0] * len(seen)


def test_a_kept_batch_of_audit_records_holds_what_is_written(spark, sf_dir, folder, monkeypatch):
    records = derive.audit_records(spark, sf_dir)
    # Also records that fail for a container that is no object, and nulls in a plain event.
    more = [
        ("no detail", '{"source":"aws.quicksight","detail-type":"AWS API Call via CloudTrail","detail":[1]}'),
        ("no identity", '{"source":"aws.quicksight","detail-type":"AWS API Call via CloudTrail","detail":{"eventID":"x","userIdentity":7}}'),
        ("bare", '{"source":"aws.quicksight","detail-type":"AWS API Call via CloudTrail"}'),
        ("nulls", '{"source":"aws.quicksight","detail-type":"AWS API Call via CloudTrail","detail":{"eventID":null,"readOnly":null,"resources":null,"userIdentity":{"arn":null}}}'),
        ("null", None),
    ]
    texts = spark.createDataFrame(more, "record_id string, payload string")
    records = records.unionByName(texts.select("record_id", F.base64(F.encode("payload", "UTF-8")).alias("data")))
    records.write.json(f"{folder}/in")
    seen, make = [], audit.filter_audit_feed

    def watch(read):
        seen.append(make(read).filter("data IS NOT NULL OR (payload IS NOT NULL AND NOT contains(payload, 'null'))").count())
        return make(read)

    monkeypatch.setattr(audit, "filter_audit_feed", watch)
    feeds.ingest_audit(feeds.read_records(spark, f"{folder}/in"), f"{folder}/lake", f"{folder}/cp", DAY, continuous=False).awaitTermination()
    assert seen == [0] * len(seen) != []

    decoded = audit.read_audit_records(records)
    columns = schemas.feed("cloudtrail_events").data.names
    expected = audit.flatten_audit(make(decoded), F.lit(DAY))
    assert keyed(lake.read_raw(spark, f"{folder}/lake", "cloudtrail_events").select(columns)) == keyed(expected.select(columns))
    errors = spark.read.json(f"{folder}/lake/{schemas.ERROR_PREFIX}/cloudtrail_events/records").select("record_id", "data")
    assert keyed(errors) == keyed(audit.invalid(decoded).select("record_id", "data"))
    found = feeds.ingest_days(spark, f"{folder}/lake", "cloudtrail_events").select("ok", "dropped", "failed").collect()
    fates = [decoded.filter(audit.fate() == f).count() for f in (envelopes.OK, envelopes.DROPPED, envelopes.FAILED)]
    assert [tuple(r) for r in found] == [tuple(fates)] and min(fates) > 0


def test_feeds_land_side_by_side(spark, sf_dir, monkeypatch):
    both, land = threading.Barrier(2, timeout=60), lake.land

    def watch(*args):
        both.wait()
        land(*args)

    monkeypatch.setattr(lake, "land", watch)
    names = ["feedback_logs", "agent_hours_logs"]
    x = registry.Inputs(spark, sf_dir)
    root = x.landed(*names)
    for name in names:
        assert lake.read_raw(spark, root, name).count() == x.table(name).count()


def test_a_feed_that_does_not_land_is_told(spark, sf_dir, folder):
    x = registry.Inputs(spark, sf_dir)
    broken = x.table("feedback_logs").withColumn("rating", F.raise_error(F.lit("no such thing")).cast("string"))
    with pytest.raises(ExceptionGroup, match="feeds not landed: feedback_logs"):
        lake.land_feeds({"feedback_logs": broken, "agent_hours_logs": x.table("agent_hours_logs")}, folder)
    assert lake.read_raw(spark, folder, "agent_hours_logs").count() == x.table("agent_hours_logs").count()
