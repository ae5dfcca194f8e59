"""Landing, reading, curating."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import governance
from usagelens.sources import lake


def feedback(spark, *rows):
    """Rows of (user, year, month, day)."""
    df = spark.createDataFrame(list(rows), "user_arn string, year int, month int, day int")
    return lake.ensure_columns(df, schemas.feed("feedback_logs").schema)


def users(df):
    return sorted((r.user_arn, r.year, r.month, r.day) for r in df.collect())


ROWS = [("a", 2024, 1, 5), ("b", 2024, 1, 31), ("c", 2024, 2, 1), ("d", 2025, 1, 1)]


@pytest.fixture
def landed(spark, folder):
    lake.land(feedback(spark, *ROWS), f"{folder}/{schemas.PREFIXES['feedback_logs']}")
    return folder


def test_landing_layout(landed):
    prefix = f"{landed}/{schemas.PREFIXES['feedback_logs']}"
    assert os.path.isdir(f"{prefix}/year=2024/month=01/day=05")
    files = os.listdir(f"{prefix}/year=2025/month=01/day=01")
    assert any(f.endswith(".json.gz") for f in files)


def test_read_raw_has_the_schema_in_order(spark, landed):
    df = lake.read_raw(spark, landed, "feedback_logs")
    assert df.schema.names == schemas.feed("feedback_logs").schema.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.feed("feedback_logs").schema]
    assert users(df) == ROWS


def test_the_folder_wins_over_the_body(spark, folder):
    prefix = f"{folder}/{schemas.PREFIXES['feedback_logs']}/year=2025/month=03/day=04"
    os.makedirs(prefix)
    with open(f"{prefix}/x.json", "w") as f:
        f.write('{"user_arn": "a", "year": 2024, "month": 1, "day": 1}\n')
    assert users(lake.read_raw(spark, folder, "feedback_logs")) == [("a", 2025, 3, 4)]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        (dt.date(2024, 1, 5), dt.date(2024, 1, 31), "ab"),
        (dt.date(2024, 1, 6), dt.date(2024, 2, 1), "bc"),
        (dt.date(2024, 2, 2), dt.date(2024, 12, 31), ""),
        (dt.date(2023, 1, 1), dt.date(2031, 1, 1), "abcd"),
    ],
)
def test_range_reads_only_its_folders(spark, landed, start, end, expected):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = lake.read_range(spark, landed, "feedback_logs", start, end, years=(2023, 2031))
    assert "".join(u[0] for u in users(df)) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    if expected:
        partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "year" in partition_filters and "day" in partition_filters
        assert "Filter " not in plan.split("FileScan")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_range_outside_the_years_is_an_error(spark, landed):
    with pytest.raises(ValueError, match="2024 to 2030"):
        lake.read_range(spark, landed, "feedback_logs", dt.date(2030, 12, 31), dt.date(2031, 1, 1))


def test_range_folders():
    assert lake.range_folders(dt.date(2024, 1, 30), dt.date(2024, 3, 1)) == [
        "year=2024/month=01/day=30",
        "year=2024/month=01/day=31",
        "year=2024/month=02",
        "year=2024/month=03/day=01",
    ]
    assert lake.range_folders(dt.date(2023, 1, 1), dt.date(2025, 1, 1)) == ["year=2023", "year=2024", "year=2025/month=01/day=01"]
    assert lake.range_folders(dt.date(2024, 1, 2), dt.date(2024, 1, 1)) == []
    assert lake.range_folders(dt.date(2031, 1, 1), dt.date(2031, 1, 2)) == ["year=2031/month=01/day=01", "year=2031/month=01/day=02"]


def test_range_lists_only_its_folders(spark, landed):
    df = lake.read_range(spark, landed, "feedback_logs", dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert all("/year=2024/month=01/" in f for f in df.inputFiles())
    assert len(df.inputFiles()) >= 2
    assert lake.read_range(spark, landed, "chat_logs", dt.date(2024, 1, 1), dt.date(2024, 1, 31)).count() == 0
    days = lake.read_days(spark, landed, "feedback_logs", [dt.date(2025, 1, 1), dt.date(2024, 1, 5), dt.date(2026, 1, 1)])
    assert [u[0] for u in users(days)] == ["a", "d"]


def test_any_day(spark, landed):
    df = lake.read_raw(spark, landed, "feedback_logs").filter(lake.any_day([dt.date(2024, 2, 1), dt.date(2025, 1, 1)]))
    assert [u[0] for u in users(df)] == ["c", "d"]


def test_missing_and_empty_feeds(spark, landed):
    assert lake.read_raw_or_none(spark, landed, "chat_logs") is None
    os.makedirs(f"{landed}/{schemas.PREFIXES['agent_hours_logs']}")
    assert lake.read_raw_or_none(spark, landed, "agent_hours_logs") is None
    assert lake.read_raw_or_none(spark, landed, "feedback_logs").count() == 4


def test_ensure_columns(spark):
    loose = spark.createDataFrame([("7", "x", 1, "2024")], "usage_hours string, event_timestamp string, extra int, year string")
    schema = schemas.feed("agent_hours_logs").schema
    df = lake.ensure_columns(loose, schema)
    row = df.first()
    assert df.columns == schema.names
    assert (row.usage_hours, row.event_timestamp, row.year, row.user_arn) == (7.0, None, 2024, None)


def test_overwrite_is_idempotent_and_leaves_other_days(spark, folder):
    path = f"{folder}/t"
    lake.overwrite_partitions(feedback(spark, *ROWS), path)
    lake.overwrite_partitions(feedback(spark, *ROWS), path)
    lake.overwrite_partitions(feedback(spark, ("new", 2024, 1, 5)), path, compacted=False)
    df = spark.read.schema(schemas.feed("feedback_logs").schema).parquet(path)
    assert users(df) == sorted([("new", 2024, 1, 5), *ROWS[1:]])


def test_curate_all(spark, landed):
    curated = f"{landed}/curated"
    done = lake.curate_all(spark, landed, curated)
    assert done == {t: t == "feedback_logs" for t in schemas.TABLES}
    assert users(lake.read_curated(spark, curated, "feedback_logs")) == ROWS
    assert lake.read_curated(spark, curated, "chat_logs").count() == 0
    assert lake.curate_all(spark, landed, curated) == done
    assert users(lake.read_curated(spark, curated, "feedback_logs")) == ROWS
    lake.use_curated(spark, curated)
    assert spark.table("feedback_logs").count() == 4


def test_publish_replaces_external_tables_only(spark, landed):
    lake.curate_all(spark, landed, f"{landed}/one")
    lake.curate_all(spark, landed, f"{landed}/two")
    lake.overwrite_partitions(feedback(spark, ("new", 2024, 1, 5)), f"{landed}/two/feedback_logs")
    for root, expected in (("one", "a"), ("two", "new"), ("one", "a")):
        lake.publish(spark, "published", f"{landed}/{root}")
        df = spark.table("published.feedback_logs").filter("year = 2024 AND month = 1 AND day = 5")
        assert [u[0] for u in users(df)] == [expected]
    spark.sql(f"CREATE DATABASE managed LOCATION '{landed}/managed'")
    spark.range(1).write.saveAsTable("managed.chat_logs")
    with pytest.raises(ValueError):
        lake.publish(spark, "managed", f"{landed}/one")


def test_content_columns_follow_the_opt_in(spark, folder):
    assert schemas.feed("chat_logs", True).data.names[-2:] == list(schemas.SENSITIVE)
    lake.create_table(spark, folder, "chat_logs", include_content=True)
    full = lake.read_curated(spark, folder, "chat_logs", include_content=True)
    open_part = governance.restricted_view(full, "open_chat")
    assert not set(schemas.SENSITIVE) & set(open_part.columns)
    assert spark.table("open_chat").columns == open_part.columns


def test_counts_and_readiness(spark):
    frames = {"full": spark.range(3).select(F.col("id")), "none": spark.range(0)}
    assert {r.table_name: r.row_count for r in lake.table_counts(frames).collect()} == {"full": 3, "none": 0}
    assert {r.dataset: r.ready for r in lake.datasets_ready(frames).collect()} == {"full": True, "none": False}


def test_a_named_load_replaces_itself_and_shares_its_root(spark, folder):
    prefix = f"{folder}/{schemas.PREFIXES['feedback_logs']}"
    lake.land_batch(feedback(spark, ("s", 2024, 1, 5)), prefix, "stream-0")
    for _run in range(2):
        lake.land(feedback(spark, *ROWS), prefix, load="january")
    lake.land(feedback(spark, ("e", 2024, 1, 5)), prefix, load="more")
    both = sorted([*ROWS, ("s", 2024, 1, 5), ("e", 2024, 1, 5)])
    assert users(lake.read_raw(spark, folder, "feedback_logs")) == both
    day = dt.date(2024, 1, 5)
    assert users(lake.read_range(spark, folder, "feedback_logs", day, day)) == [u for u in both if u[1:] == (2024, 1, 5)]


def test_a_broken_feed_stops_no_other(spark, landed):
    for name in ("chat_logs", "agent_hours_logs"):
        lake.land(lake.ensure_columns(feedback(spark, *ROWS), schemas.feed(name).schema), f"{landed}/{schemas.PREFIXES[name]}")
    with open(f"{landed}/{schemas.PREFIXES['chat_logs']}/year=2024/month=01/day=05/x.json.gz", "w") as out:
        out.write("no gzip")
    found = {o.table: o for o in lake.curate_feeds(spark, landed, f"{landed}/cur")}
    assert {t for t, o in found.items() if o.error} == {"chat_logs"}
    assert {t for t, o in found.items() if o.curated} == {"feedback_logs", "agent_hours_logs"}
    assert lake.read_curated(spark, f"{landed}/cur", "agent_hours_logs").count() == len(ROWS)
    with pytest.raises(ExceptionGroup, match="chat_logs"):
        lake.curate_all(spark, landed, f"{landed}/cur2")
    assert users(lake.read_curated(spark, f"{landed}/cur2", "feedback_logs")) == ROWS


def test_schema_widths():
    widths = {t: len(schemas.feed(t).data) for t in schemas.TABLES}
    assert widths == {
        "chat_logs": 25,
        "feedback_logs": 19,
        "agent_hours_logs": 13,
        "cloudtrail_events": 25,
        "index_usage_logs": 14,
    }


def test_quoted_numbers_survive_and_broken_lines_are_set_apart(spark, folder):
    day = f"{folder}/raw/{schemas.PREFIXES['agent_hours_logs']}/year=2024/month=01/day=02"
    os.makedirs(day)
    lines = ['{"user_arn":"a","usage_hours":"1.5","event_timestamp":"7.0"}', '{"user_arn":"b","usa', "", '{"user_arn":"c"}', '{"user_arn":"d"} x']
    with open(f"{day}/part.json", "w") as out:
        out.write("\n".join(lines))
    for _run in range(2):
        assert lake.curate(spark, f"{folder}/raw", f"{folder}/cur", "agent_hours_logs")
        rows = lake.read_curated(spark, f"{folder}/cur", "agent_hours_logs").collect()
        assert sorted((r.user_arn, r.usage_hours, r.event_timestamp, r.day) for r in rows) == [("a", 1.5, 7, 2), ("c", None, None, 2)]
        broken = lake.read_quarantine(spark, f"{folder}/cur", "agent_hours_logs").collect()
        assert sorted((r.line, r.day) for r in broken) == [(lines[1], 2), (lines[4], 2)]
    assert lake.read_quarantine(spark, f"{folder}/cur", "chat_logs").count() == 0
