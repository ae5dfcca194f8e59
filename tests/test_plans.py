"""Views, datasets, metrics, insights on small hand-made tables."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import aggregate, interact, quality, trend
from usagelens.plans import catalog, datasets, insights, reports, views, visuals
from usagelens.sources import lake


def table(spark, name, rows):
    """A table from dicts; what a row does not name is NULL."""
    schema = schemas.feed(name).schema
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def chat(spark, *rows):
    return table(spark, "chat_logs", rows)


def row(day, user="a/u1", conversation="c1", **more):
    return {"timestamp": f"2024-01-{day:02d}T08:00:00", "user_arn": user, "conversation_id": conversation, **more}


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_views_drop_rows_without_a_timestamp_but_keep_bad_ones(spark):
    df = views.chat_activity(chat(spark, row(1), {"user_arn": "x"}, {"timestamp": "bad", "user_arn": "y"}))
    assert sorted(r.user_name for r in df.collect()) == ["u1", "y"]
    assert as_dict(df, "user_name", "event_time")["y"] is None


def test_view_columns(spark):
    widths = {}
    for name, (source, make) in views.VIEWS.items():
        df = make(table(spark, source, []))
        assert df.columns[-3:] == schemas.PARTITION_COLUMNS
        widths[name] = len(df.columns)
    assert widths == {
        "chat_activity": 19,
        "feedback_analysis": 16,
        "agent_hours_usage": 14,
        "api_audit_trail": 23,
        "querydatabase_events": 15,
        "index_usage": 17,
    }


def test_datasets_project_the_stated_columns(spark):
    for name, (source, make) in datasets.DATASETS.items():
        assert make(table(spark, source, [])).columns == datasets.PROJECTIONS[name]


def test_audit_dataset_keeps_rows_the_view_drops(spark):
    events = table(spark, "cloudtrail_events", [{"event_id": "1", "event_name": "CreateChat"}])
    assert views.api_audit_trail(events).count() == 0
    assert datasets.api_audit_trail(events).first().api_feature == "CreateChat"


def test_offset_times_differ_between_view_and_dataset(spark):
    rows = chat(spark, {"timestamp": "2024-01-01T23:00:00-05:00"})
    assert views.chat_activity(rows).first().event_time == dt.datetime(2024, 1, 1, 23)
    assert datasets.chat_activity(rows).first().event_time == dt.datetime(2024, 1, 2, 4)


def usage(day, source="s1", size=1 << 30, total=1 << 31, docs=3, **more):
    return {
        "timestamp": f"2024-01-{day:02d}T0{more.pop('hour', 1)}:00:00",
        "source_arn": f"arn/{source}",
        "source_name": source,
        "source_type": "KB",
        "consumed_source_size": size,
        "consumed_index_size": total,
        "consumed_source_doc_count": docs,
        "user_arn": "x/owner",
        "year": 2024,
        "month": 1,
        "day": day,
        **more,
    }


def test_index_usage_collapses_repeats_but_not_days(spark):
    rows = [usage(1, hour=h) for h in range(1, 9)] * 50 + [usage(2), usage(2, docs=4)]
    got = views.index_usage(table(spark, "index_usage_logs", rows)).collect()
    assert len(got) == 3
    first = next(r for r in got if r.day == 1)
    assert first.event_time == dt.datetime(2024, 1, 1, 8)
    assert (first.consumed_source_size_gb, first.consumed_index_size_gb, first.user_name) == (1.0, 2.0, "owner")


def test_index_usage_hashes_repeats_before_any_shuffle(spark):
    plan = views.index_usage(table(spark, "index_usage_logs", [usage(1)]))._jdf.queryExecution().executedPlan()
    steps = [line.strip(" :+-") for line in plan.toString().splitlines()]
    bottom = [s for s in steps if s.startswith(("HashAggregate", "SortAggregate", "Exchange", "Sort "))][-2:]
    assert [s.split("(")[0].split(" ")[0] for s in bottom] == ["Exchange", "HashAggregate"]


def test_index_usage_takes_the_largest_text_of_a_group(spark):
    rows = [usage(1, user_arn="x/a", resource_arn="r2", account_id="1"), usage(1, user_arn="x/b", resource_arn="r1")]
    got = views.index_usage(table(spark, "index_usage_logs", rows)).collect()
    assert [(r.user_name, r.resource_arn, r.account_id) for r in got] == [("b", "r2", "1")]


def test_index_size_is_summed_for_parity_and_not_for_the_current_size(spark):
    rows = [usage(1, "s1"), usage(1, "s2"), usage(2, "s1", total=3 << 30), usage(2, "s2", total=3 << 30)]
    index = datasets.index_usage(table(spark, "index_usage_logs", rows))
    assert visuals.build(index, "m21").first().index_size_gb == 10.0
    assert insights.current_index_size(index).first().index_size_gb == 3.0


def test_storage_by_type_takes_each_source_once(spark):
    rows = [usage(1, "s1"), usage(2, "s1", size=2 << 30), usage(1, "s2")]
    index = datasets.index_usage(table(spark, "index_usage_logs", rows))
    only = insights.storage_by_type(index).first()
    assert (only.size_gb, only.sources) == (3.0, 2)


def test_daily_adoption(spark):
    view = views.chat_activity(chat(spark, row(1), row(1, "a/u2"), row(1), row(2, conversation="c2"), row(2, conversation="c3")))
    got = [tuple(r) for r in reports.daily_adoption(view).collect()]
    assert got == [(dt.date(2024, 1, 2), 1, 2), (dt.date(2024, 1, 1), 2, 1)]


def test_shares(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] + [(None,)], "satisfaction string")
    assert as_dict(reports.satisfaction(df), "satisfaction", "percentage") == {"a": 50.0, "b": 25.0, None: 25.0}


def test_catalog_covers_every_dataset_column(spark):
    total = 0
    for name, (source, make) in datasets.DATASETS.items():
        known = [e.column for e in catalog.entries(name)]
        columns = make(table(spark, source, [])).columns
        assert set(known) <= set(columns)
        assert catalog.date_column(name) == "event_time"
        total += len(known)
    assert total == 65


def test_resolve(spark):
    assert catalog.resolve("chat-activity", "TTFT") == "time_to_first_token_ms"
    assert catalog.resolve("chat-activity", "Flow") == "flow_id"
    assert catalog.resolve("index-usage", " source size (gb) ") == "consumed_source_size_gb"
    with pytest.raises(KeyError):
        catalog.resolve("chat-activity", "account_id")
    with pytest.raises(ValueError):
        catalog.resolve("api-audit-trail", "resource")


def test_metric_query_defaults(spark):
    rows = [row(1, latency="10", surface_type="web"), row(1, latency="30", surface_type="web"), row(1, latency="-", surface_type="ide")]
    data = datasets.chat_activity(chat(spark, *rows))
    got = catalog.metric_query(data, "chat-activity", ["speed", ("user", "DISTINCT_COUNT")], ["channel"], filters={"who": ["u1"]})
    assert as_dict(got, "surface_type", "latency_ms_average") == {"web": 20.0, "ide": None}
    assert got.columns == ["surface_type", "latency_ms_average", "user_name_distinct_count"]


def test_grains(spark):
    data = datasets.chat_activity(chat(spark, row(1), row(7), row(8), row(31)))
    weeks = aggregate.metric(data, [F.count(F.lit(1)).alias("n")], ["event_time"], "WEEK")
    assert as_dict(weeks, "week", "n") == {dt.date(2024, 1, 1): 2, dt.date(2024, 1, 8): 1, dt.date(2024, 1, 29): 1}


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", None)], "k string, v int")
    assert [r.k for r in aggregate.top_n(df, "v", ["k"], 2).collect()] == ["c", "a"]
    plan = aggregate.top_n(df, "v", ["k"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_time_range_keeps_rows_without_a_time(spark):
    data = datasets.chat_activity(chat(spark, row(1), row(5), {"timestamp": "bad"}))
    got = interact.time_range(data, dt.datetime(2024, 1, 5, 8)).collect()
    assert len(got) == 3
    got = interact.time_range(data, dt.datetime(2024, 1, 5, 7, 59, 59)).collect()
    assert sorted(str(r.event_time) for r in got) == ["2024-01-01 08:00:00", "None"]
    assert interact.last_days(data, dt.datetime(2024, 1, 5, 8), 4).count() == 2


def test_click_through_matches_null_points(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "feature string, n int")
    assert [r.n for r in interact.click_through(df, {"feature": None}).collect()] == [2]
    picked = spark.createDataFrame([(None,), ("b",)], "feature string")
    assert sorted(r.n for r in interact.click_through_many(df, picked).collect()) == [2, 3]


@pytest.mark.parametrize("agg", sorted(aggregate.AGGREGATIONS))
def test_every_aggregation_drills_down(spark, agg):
    data = [("x", "p", 1), ("x", "p", 1), ("x", "q", 4), ("y", None, None), (None, "p", 7), ("z", "p", None)]
    df = spark.createDataFrame(data, "f string, u string, v int")
    got = {(r.level, r.f, r.u): r.m for r in interact.drill_down(df, ["f", "u"], "v", agg, "m").collect()}
    for level in range(3):
        keys = ["f", "u"][:level]
        direct = df.groupBy(*keys).agg(aggregate.measure("v", agg, "m")).collect()
        assert {k: v for k, v in got.items() if k[0] == level} == {(level, *(r[k] for k in keys), *[None] * (2 - level)): r.m for r in direct}
    assert len(got) == 1 + 4 + 5


def test_drill_down_levels(spark):
    df = spark.createDataFrame(
        [("x", "u", "c1"), ("x", "u", "c1"), ("x", None, "c2"), ("y", "u", "c1")], "f string, u string, c string"
    )
    got = {(r.f, r.u, r.level): r.n for r in interact.drill_down(df, ["f", "u"], "c", "DISTINCT_COUNT", "n").collect()}
    assert got == {
        (None, None, 0): 2,
        ("x", None, 1): 2,
        ("y", None, 1): 1,
        ("x", "u", 2): 1,
        ("x", None, 2): 1,
        ("y", "u", 2): 1,
    }
    counts = interact.drill_down(df, ["f", "u"], "u", "COUNT", "n").filter("level = 0").first()
    assert counts.n == 3


def test_change_compares_neighbouring_periods_only(spark):
    weeks = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 10), (dt.date(2024, 1, 8), 15), (dt.date(2024, 1, 29), 5)], "week date, n int"
    )
    got = as_dict(trend.change(weeks, "week", "n", "WEEK"), "week", "change")
    assert list(got.values()) == [None, 5, None]
    months = spark.createDataFrame([(dt.date(2023, 12, 1), 1), (dt.date(2024, 1, 1), 4)], "month date, n int")
    assert as_dict(trend.change(months, "month", "n", "MONTH"), "month", "change")[dt.date(2024, 1, 1)] == 3


def test_trailing_ratio_weighs_days(spark):
    days = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1, 10), (dt.date(2024, 1, 3), 9, 10), (dt.date(2024, 1, 9), 5, 10), (dt.date(2024, 3, 1), 1, 1)],
        "day date, bad int, n int",
    )
    got = as_dict(trend.trailing_ratio(days, "day", "bad", "n"), "day", "trailing_ratio")
    assert list(got.values()) == [None, 0.1, 0.9, None]


@pytest.mark.parametrize("spread", [3, 50, 5000])
def test_percent_rank_equals_brute_force(spark, spread):
    rng = random.Random(spread)
    people = {f"u{i}": (1 if i % 3 == 0 else rng.randrange(spread)) for i in range(400)}
    df = spark.createDataFrame(list(people.items()), "user_name string, sessions bigint")
    got = as_dict(trend.share_at_or_above(df, "user_name", "sessions"), "user_name", "percent_rank")
    everyone = list(people.values())
    assert got == {u: sum(v < s for v in everyone) / (len(everyone) - 1) for u, s in people.items()}


def test_percent_rank_of_a_single_row(spark):
    df = spark.createDataFrame([("u", 5)], "user_name string, sessions bigint")
    assert trend.share_at_or_above(df, "user_name", "sessions").first().percent_rank == 0.0


def test_growth_and_limits(spark):
    rows = [usage(1, docs=3), usage(2, docs=5), usage(9, docs=4, size=9 << 30), usage(1, "s2")]
    index = datasets.index_usage(table(spark, "index_usage_logs", rows))
    growth = {(r.source_name, r.day.day): r.growth for r in insights.document_growth(index).collect()}
    assert growth == {("s1", 1): None, ("s1", 2): 2, ("s1", 9): -1, ("s2", 1): None}
    near = insights.near_limit(index, 10.0).collect()
    assert [(r.source_name, r.used_share) for r in near] == [("s1", 0.9)]


def test_idle_sources(spark):
    index = datasets.index_usage(table(spark, "index_usage_logs", [usage(1, "s1", docs=10), usage(1, "s2", docs=10), usage(1, "s3", docs=1)]))
    events = [{"event_name": "X", "resource_arn": "arn/s2"}] * 9 + [{"event_name": "X", "resource_arn": ""}]
    audit = datasets.api_audit_trail(table(spark, "cloudtrail_events", events))
    assert [(r.source_name, r.calls) for r in insights.idle_sources(index, audit, 5, 0.5).collect()] == [("s1", 0)]


def test_satisfaction_and_errors(spark):
    feedback = table(spark, "feedback_logs", [{"timestamp": "2024-01-01", "feedback_type": t} for t in ("Useful", "Useful", "Not Useful", None)])
    score = insights.satisfaction_score(datasets.feedback_analysis(feedback)).first()
    assert (score.responses, score.useful) == (3, 2)
    events = [{"event_name": "A", "error_code": c} for c in ("", None, "Denied", "Denied")] + [{"event_name": "B", "error_code": "X"}]
    audit = datasets.api_audit_trail(table(spark, "cloudtrail_events", events))
    assert as_dict(insights.error_rate(audit, ["api_action"]), "api_action", "error_rate") == {"A": 0.5, "B": 1.0}
    assert [tuple(r) for r in insights.failure_patterns(audit, 1).collect()] == [("A", "Denied", 2)]


def test_overage(spark):
    rows = [{"timestamp": "2024-01-01", "reporting_service": "FLOW", "usage_group": g, "usage_hours": h} for g, h in (("Extra", 1.0), ("Included", 3.0), (None, None))]
    got = insights.overage(datasets.agent_hours_usage(table(spark, "agent_hours_logs", rows))).first()
    assert (got.total_hours, got.extra_hours, got.overage_share) == (4.0, 1.0, 0.25)


def test_feature_extremes_and_underused(spark):
    names = [c for i, c in enumerate("abcdefghijkl", 1) for _ in range(i)]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    rows = insights.feature_extremes(df, "f", 2).collect()
    assert sorted((r.side, r.f) for r in rows) == [("least", "a"), ("least", "b"), ("most", "k"), ("most", "l")]
    assert sorted(r.f for r in insights.underused(df, "f", 2.5 / 78).collect()) == ["a", "b"]


def test_quality_reports(spark):
    rows = chat(spark, row(1, latency="-"), row(1, latency="5"), {"timestamp": "x"})
    got = as_dict(quality.unparseable(rows, {"timestamp": "timestamp_ntz", "latency": "double"}), "column_name", "bad_rows")
    assert got == {"timestamp": 1, "latency": 1}
    labels = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "l string")
    assert [tuple(r) for r in quality.outside_domain(labels, "l", ["A"]).collect()] == [("B", 2)]


def test_visuals_name_only_dataset_columns():
    assert len(visuals.VISUALS) == 27
    for spec in visuals.VISUALS.values():
        used = {*spec.by, *spec.rows, *spec.drill, *spec.only, *([spec.measure[0]] if spec.measure else [])}
        assert used <= set(datasets.PROJECTIONS[spec.dataset])


def test_a_hot_user_is_counted_whole(spark):
    """A third of all rows on one key, through every grouped operator that meets it."""
    rows = [row(1 + i % 28, "a/hot" if i % 3 == 0 else f"a/u{i % 50}", f"c{i % 97}") for i in range(3000)]
    data = datasets.chat_activity(chat(spark, *rows))
    expected = defaultdict(set)
    for r in rows:
        expected[r["user_arn"][2:]].add(r["conversation_id"])
    got = as_dict(visuals.build(data, "m05", n=None), "user_name", "chat_sessions")
    assert got == {u: len(c) for u, c in expected.items()}
    level2 = interact.drill_down(data, ["user_name", "status"], "conversation_id", "DISTINCT_COUNT", "n").filter("level = 1")
    assert as_dict(level2, "user_name", "n") == got


def test_metrics_scan_only_the_columns_they_use(spark, folder):
    path = f"{folder}/t"
    lake.overwrite_partitions(table(spark, "chat_logs", [{**row(1), "year": 2024, "month": 1, "day": 1}]), path)
    stored = spark.read.schema(schemas.feed("chat_logs").schema).parquet(path)
    plan = visuals.build(datasets.chat_activity(stored), "m01")._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert read == "timestamp:string,user_arn:string"
    assert "IsNotNull(timestamp)" in plan


def test_latency_and_its_percentiles(spark):
    rows = [row(1, latency=str(i), time_to_first_token="") for i in range(1, 101)] + [row(1, latency="-")]
    data = datasets.chat_activity(chat(spark, *rows))
    got = insights.latency_percentiles(data).first()
    assert (got.p50_latency_ms, got.p95_latency_ms) == (50.0, 95.0)
    mean = insights.latency(data).first()
    assert (mean.avg_latency_ms, mean.avg_time_to_first_token_ms, mean.measured) == (50.5, None, 100)


def test_sketched_distinct_count_is_close(spark):
    df = spark.range(20000).select((F.col("id") % 7000).alias("k"))
    got = aggregate.metric(df, [aggregate.measure("k", "APPROX_DISTINCT_COUNT", "n")]).first().n
    assert got == pytest.approx(7000, rel=0.15)
