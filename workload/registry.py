"""Every registered query: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas, session
from usagelens.functions import expressions as E
from usagelens.functions import classify, masking
from usagelens.operators import aggregate, governance, interact, quality
from usagelens.plans import catalog, datasets, insights, reports, views, visuals
from usagelens.sources import audit, envelopes, lake, snapshots, store
from usagelens.streaming import feeds
from workload import derive

AS_OF = dt.datetime(2024, 1, 20, 12, 0, 0)
RANGE = dt.date(2024, 1, 5), dt.date(2024, 1, 12)
INGEST_DATE = dt.date(2024, 2, 1)
LIMIT_GB = 0.05
FILE_RECORDS = 50_000  # a gzipped file is one task's to read
MASKED = list(masking.PATTERNS)


class Inputs:
    """Derived tables, views and datasets of one test folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.prepare(spark)
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return derive.source(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return derive.table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        table, make = views.VIEWS[name]
        return make(self.table(table))

    def dataset(self, name: str) -> DataFrame:
        table, make = datasets.DATASETS[name]
        return make(self.table(table))

    @cached_property
    def records(self) -> DataFrame:
        return derive.log_records(self.spark, self.sf_dir)

    @cached_property
    def audit_records(self) -> DataFrame:
        return derive.audit_records(self.spark, self.sf_dir)

    def events(self, include_content: bool = False) -> DataFrame:
        return envelopes.transform_log_records(self.records, "chat_logs", include_content)

    def flat_audit(self) -> DataFrame:
        return audit.flatten_audit(audit.read_audit_records(self.audit_records), F.lit(INGEST_DATE))

    def scratch(self, name: str) -> str:
        return session.scratch_dir(self.spark, name)

    def landed(self, *names: str) -> str:
        """Land the named tables as raw JSON; returns the root."""
        root = self.scratch("landed")
        lake.land_feeds({name: self.table(name) for name in names}, root)
        return root


_REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(key: str):
    def add(make):
        assert key not in _REGISTRY, key
        _REGISTRY[key] = make
        return make

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(make):
        return lambda spark, sf_dir: make(Inputs(spark, sf_dir))

    return {key: bind(make) for key, make in _REGISTRY.items()}


# --- I: sources and sinks ---------------------------------------------------------


@query("i01_decode_envelopes")
def _(x):
    return envelopes.decode_envelopes(x.records).select("record_id", F.col("payload").isNotNull().alias("decoded"))


@query("i02_drop_control")
def _(x):
    read = envelopes.read_envelopes(envelopes.decode_envelopes(x.records))
    return envelopes.drop_control(read).select("record_id", "kind")


@query("i03_explode_events")
def _(x):
    read = envelopes.read_envelopes(envelopes.decode_envelopes(x.records)).filter("kind = 'events'")
    time = F.try_variant_get("envelope_time", "$", "bigint").alias("envelope_ms")
    return envelopes.explode_events(read).select("record_id", "log_group", "log_stream", time, "message")


@query("i04_parse_message")
def _(x):
    events = _raw_events(x)
    parsed = envelopes.parse_message(events)
    return parsed.select("event_id", "raw_message", F.col("fields.conversation_id").alias("conversation_id"))


def _raw_events(x: Inputs) -> DataFrame:
    """The raw messages as exploded events, without their envelopes."""
    return derive._raw(x.spark, x.sf_dir, derive.RAW_CHAT).select(
        "event_id",
        F.lit("/g").alias("log_group"),
        F.lit("s").alias("log_stream"),
        F.parse_json(F.col("envelope_ms").cast("string")).alias("envelope_time"),
        "message",
    )


@query("i05_event_time")
def _(x):
    events = envelopes.conform_keys(envelopes.parse_message(_raw_events(x)))
    return events.select("event_id", "timestamp", "reason")


@query("i06_conform_keys")
def _(x):
    events = envelopes.conform_keys(envelopes.parse_message(_raw_events(x)))
    columns = "event_id log_group log_stream message_type user_arn account_id event_timestamp latency user_message"
    return events.select(*columns.split(), "raw_message")


@query("i06_extra_fields")
def _(x):
    return envelopes.conform_keys(envelopes.parse_message(_raw_events(x))).select("event_id", "extra_fields")


@query("i07_strip_sensitive")
def _(x):
    usable = envelopes.usable(x.events(include_content=False))
    return usable.select("record_id", F.lit(",".join(usable.columns)).alias("columns_kept"), "conversation_id")


@query("i08_nested_json_text")
def _(x):
    parsed = envelopes.parse_message(_raw_events(x))
    return parsed.select("event_id", F.col("fields.user_selected_resources").alias("user_selected_resources"))


@query("i09_route_records")
def _(x):
    return envelopes.route_records(x.records).select("record_id", "result")


@query("i09_rejected_events")
def _(x):
    return envelopes.rejected(x.events()).select("record_id", "reason", "rejected_message")


@query("i10_passthrough")
def _(x):
    return envelopes.passthrough(x.records).select("record_id", "payload")


@query("i11_flatten_audit")
def _(x):
    return x.flat_audit()


@query("i12_partition_keys")
def _(x):
    return x.flat_audit().groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("row_count"))


@query("i13_resource_type")
def _(x):
    return x.flat_audit().select("event_id", "resources", "resource_type")


@query("i14_resource_arn")
def _(x):
    return x.flat_audit().select("event_id", "resource_arn")


@query("i15_filter_audit_feed")
def _(x):
    read = audit.filter_audit_feed(audit.read_audit_records(x.audit_records))
    return read.select("record_id", F.col("event.source").alias("source"))


def _delivered(x: Inputs, table: str, log_type: str, type_key: str, account_key: str) -> DataFrame:
    names = {"message_type": type_key, "account_id": account_key}
    return envelopes.select_record_fields(x.table(table).withColumnsRenamed(names), log_type)


@query("i16_chat_fields")
def _(x):
    return _delivered(x, "chat_logs", "CHAT_LOGS", "logType", "accountId")


@query("i16_feedback_fields")
def _(x):
    return _delivered(x, "feedback_logs", "FEEDBACK_LOGS", "logType", "accountId")


@query("i16_agent_hours_fields")
def _(x):
    return _delivered(x, "agent_hours_logs", "AGENT_HOURS_LOGS", "logType", "accountId")


@query("i16_index_usage_fields")
def _(x):
    return _delivered(x, "index_usage_logs", "INDEX_USAGE_LOGS", "log_type", "account_id")


@query("i17_read_raw")
def _(x):
    return lake.read_raw(x.spark, x.landed("chat_logs"), "chat_logs")


@query("i18_read_range")
def _(x):
    return lake.read_range(x.spark, x.landed("cloudtrail_events"), "cloudtrail_events", *RANGE)


@query("i19_skip_missing")
def _(x):
    root = x.landed("feedback_logs", "agent_hours_logs")
    found = {t: lake.read_raw_or_none(x.spark, root, t) for t in schemas.TABLES}
    return lake.table_counts({t: df for t, df in found.items() if df is not None})


@query("i20_partitions_from_path")
def _(x):
    return lake.landed_days(lake.read_raw(x.spark, x.landed("agent_hours_logs"), "agent_hours_logs"))


@query("i21_ensure_columns")
def _(x):
    loose = x.table("feedback_logs").select(
        "timestamp",
        F.concat("rating", F.lit("x")).alias("event_timestamp"),
        F.col("event_timestamp").alias("rating"),
        F.col("year").cast("string").alias("year"),
        "user_arn",
        F.lit(1).alias("extra"),
    )
    return lake.ensure_columns(loose, schemas.feed("feedback_logs").schema)


@query("i22_create_table")
def _(x):
    root = x.scratch("curated")
    lake.create_table(x.spark, root, "feedback_logs")
    empty = lake.read_curated(x.spark, root, "feedback_logs")
    lake.overwrite_partitions(x.table("feedback_logs"), lake.create_table(x.spark, root, "feedback_logs"))
    full = lake.read_curated(x.spark, root, "feedback_logs")
    return lake.table_counts({"created": empty, "filled": full})


@query("i23_overwrite_partitions")
def _(x):
    """Everything, then a day range again, then everything again: nothing twice."""
    path = f"{x.scratch('curated')}/feedback_logs"
    rows = x.table("feedback_logs")
    for part in (rows, rows.filter(lake.day_range(*RANGE)), rows):
        lake.overwrite_partitions(part, path)
    return x.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("i24_land")
def _(x):
    path = x.scratch("landing")
    lake.land(x.table("agent_hours_logs"), path, F.lit(INGEST_DATE))
    landed = x.spark.read.schema(schemas.feed("agent_hours_logs").schema).json(path)
    return landed.select("user_arn", "usage_hours", "year", "month", "day")


@query("i24_shared_root")
def _(x):
    """A stream and a load that is repeated, under one root, read by range."""
    name, late = "feedback_logs", F.col("day") > 10
    records = derive.feed_records(x.spark, x.sf_dir, name, "FEEDBACK_LOGS", late)
    root = _streamed(x, name, records)
    rest = x.table(name).filter(~late).drop(*schemas.PARTITION_COLUMNS)
    for _run in range(2):
        lake.land(rest, f"{root}/{schemas.PREFIXES[name]}", F.lit(INGEST_DATE), load="backfill")
    return lake.read_range(x.spark, root, name, INGEST_DATE, INGEST_DATE).drop(*schemas.PARTITION_COLUMNS)


def _curated(x: Inputs) -> dict[str, DataFrame]:
    raw, curated = x.landed(*schemas.TABLES), x.scratch("curated")
    lake.curate_all(x.spark, raw, curated)
    return {t: lake.read_curated(x.spark, curated, t) for t in schemas.TABLES}


@query("i25_curate_all")
def _(x):
    return lake.table_counts(_curated(x))


@query("i25_broken_feed")
def _(x):
    """One feed has a file that can't be read: it is reported, the others are curated."""
    raw, curated = x.landed(*schemas.TABLES), x.scratch("curated")
    store.create(x.spark, f"{raw}/{schemas.PREFIXES['feedback_logs']}/year=2024/month=01/day=01/broken.json.gz", "no gzip")
    outcomes = lake.curate_feeds(x.spark, raw, curated)
    failed = x.spark.createDataFrame([(o.table, o.error is not None) for o in outcomes], "table_name string, failed boolean")
    return lake.table_counts({t: lake.read_curated(x.spark, curated, t) for t in schemas.TABLES}).join(failed, "table_name")


@query("i25_quarantine")
def _(x):
    """Lines with quoted measures, some cut off: rows of the whole ones, and the broken ones apart."""
    raw, curated, name = x.scratch("landed"), x.scratch("curated"), "agent_hours_logs"
    line = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in schemas.feed(name).data.names]))
    cut = F.when(F.col("event_timestamp") % 10 == 3, F.left(line, F.lit(25))).otherwise(line)
    lines = x.table(name).select(cut.alias("value"), *schemas.PARTITION_COLUMNS)
    lines.write.partitionBy(*schemas.PARTITION_COLUMNS).text(f"{raw}/{schemas.PREFIXES[name]}")
    lake.curate(x.spark, raw, curated, name)
    rows = lake.read_curated(x.spark, curated, name).select("user_arn", "usage_hours", "event_timestamp", *schemas.PARTITION_COLUMNS)
    return rows.unionByName(lake.read_quarantine(x.spark, curated, name), allowMissingColumns=True)


@query("i26_refresh_dataset")
def _(x):
    """A first refresh without the last days, then two with all."""
    path, chat = x.scratch("snapshot"), x.dataset("chat-activity")
    for rows in (chat.filter("event_time < '2024-01-12' OR event_time IS NULL"), chat, chat):
        snapshots.refresh(rows, path)
    return snapshots.read(x.spark, path, chat.schema)


@query("i26_snapshot_days")
def _(x):
    """Days as the last version lists them, and how many refreshes have written them."""
    path, chat = x.scratch("snapshot"), x.dataset("chat-activity")
    written = [snapshots.refresh(rows, path) for rows in (chat.filter("event_time < '2024-01-12' OR event_time IS NULL"), chat, chat)]
    times = x.spark.createDataFrame([(d, 1) for days in written for d in days], "event_day date, n int").groupBy("event_day").agg(F.sum("n").alias("times"))
    days = snapshots.version(x.spark, path, snapshots.versions(x.spark, path)[-1]).alias("v")
    joined = days.join(times.alias("t"), F.col("v.event_day").eqNullSafe(F.col("t.event_day")))
    return joined.select("v.event_day", "row_count", "times")


@query("i27_datasets_ready")
def _(x):
    return lake.datasets_ready({name: x.dataset(name) for name in datasets.DATASETS})


@query("i28_table_counts")
def _(x):
    return lake.table_counts({name: x.table(name) for name in schemas.TABLES})


# --- W, D: views and datasets -------------------------------------------------------

for _i, _name in enumerate(views.VIEWS, 1):
    query(f"w{_i}_{_name}")(lambda x, name=_name: x.view(name))

for _i, _name in enumerate(datasets.DATASETS, 1):
    query(f"d{_i}_{_name.replace('-', '_')}")(lambda x, name=_name: x.dataset(name))


@query("d6_projection")
def _(x):
    return datasets.project(x.view("agent_hours_usage"), "agent-hours-usage")


@query("d7_by_database")
def _(x):
    curated = x.scratch("curated")
    lake.overwrite_partitions(x.table("agent_hours_logs"), lake.create_table(x.spark, curated, "agent_hours_logs"))
    database = f"usage_{curated[-32:]}"
    lake.publish(x.spark, database, curated)
    named = datasets.dataset(x.spark, "agent-hours-usage", database)
    return named.groupBy("service").agg(F.sum("hours").alias("hours"))


# --- F: expressions -------------------------------------------------------------------


def _expression(key: str, table: str, keep: list[str], **columns):
    query(key)(lambda x: x.table(table).select(*keep, *[c().alias(n) for n, c in columns.items()]))


_expression("f01_event_time", "cloudtrail_events", ["event_id", "timestamp"], event_time=lambda: E.wall_time(F.col("timestamp")))
_expression("f02_short_name", "chat_logs", ["user_arn"], user_name=lambda: E.short_name(F.col("user_arn")))
_expression("f03_chat_feature", "chat_logs", ["flow_id", "agent_id"], feature=lambda: E.chat_feature(F.col("flow_id"), F.col("agent_id")))
_expression("f04_feedback_source", "feedback_logs", ["research_id"], feedback_source=lambda: E.feedback_source(F.col("research_id")))
_expression("f05_view_feature", "cloudtrail_events", ["event_name"], api_feature=lambda: classify.view_feature(F.col("event_name")))
_expression("f06_dataset_feature", "cloudtrail_events", ["event_name"], api_feature=lambda: classify.dataset_feature(F.col("event_name")))
_expression("f07_resource_label", "agent_hours_logs", ["reporting_service"], resource_type=lambda: E.resource_label(F.col("reporting_service")))
_expression("f08_read_or_write", "cloudtrail_events", ["read_only"], read_or_write=lambda: E.read_or_write(F.col("read_only")))
_expression("f09_text_to_double", "chat_logs", ["latency", "time_to_first_token"], latency_ms=lambda: E.as_double(F.col("latency")), ttft_ms=lambda: E.as_double(F.col("time_to_first_token")))
_expression("f10_bytes_to_gb_mb", "index_usage_logs", ["consumed_source_size"], gb=lambda: E.gigabytes(F.col("consumed_source_size")), mb=lambda: E.megabytes(F.col("consumed_source_size")))


@query("f11_json_scalars")
def _(x):
    found = E.json_scalars(F.col("service_event_details"), views.QUERY_DETAILS, views.QUERY_FIELDS)
    return x.table("cloudtrail_events").select("event_id", *[c.alias(n) for n, c in found.items()])


@query("f12_not_null_time")
def _(x):
    return views.timed(x.table("chat_logs")).select("timestamp", "system_message_id")


@query("f13_name_and_source")
def _(x):
    return x.table("cloudtrail_events").filter(views.is_database_query()).select("event_id", "event_name", "event_source")


@query("f14_calendar_day")
def _(x):
    return x.view("chat_activity").select("event_time", E.calendar_day(F.col("event_time")).alias("event_day"))


@query("f15_percent")
def _(x):
    counts = x.view("chat_activity").groupBy("user_name").agg(
        F.count_if(F.col("web_search") == "true").alias("web"), F.count(F.lit(1)).alias("messages")
    )
    return counts.withColumn("percentage", E.percent(F.col("web"), F.col("messages")))


# --- A, N: aggregation, sort and limit ---------------------------------------------------


@query("a01_distinct_count")
def _(x):
    return aggregate.metric(x.view("chat_activity"), [aggregate.measure("user_name", "DISTINCT_COUNT", "users")], ["surface_type"])


@query("a01_approx_distinct_count")
def _(x):
    """The sketch beside the exact count, which it must meet within a tenth."""
    names = {"DISTINCT_COUNT": "sessions", "APPROX_DISTINCT_COUNT": "about"}
    measures = [aggregate.measure("conversation_id", a, n) for a, n in names.items()]
    counts = aggregate.metric(x.view("chat_activity"), measures, ["surface_type"])
    close = F.abs(F.col("about") - F.col("sessions")) <= 0.1 * F.col("sessions")
    return counts.select("surface_type", "sessions", close.alias("close"))


@query("a02_count")
def _(x):
    reasons = aggregate.measure("reason", "COUNT", "with_reason")
    return aggregate.metric(x.view("feedback_analysis"), [reasons, F.count(F.lit(1)).alias("row_count")], ["satisfaction"])


@query("a03_sum")
def _(x):
    return aggregate.metric(x.view("agent_hours_usage"), [aggregate.measure("hours", "SUM", "hours")], ["resource_id"])


@query("a04_max")
def _(x):
    # The text is grouped by first: its maximum needs a sort, which then meets few rows.
    user = E.short_name(F.col("user_arn")).alias("user_name")
    per_user = x.table("index_usage_logs").groupBy("source_type", user).agg(F.max("consumed_source_size").alias("size"))
    return per_user.groupBy("source_type").agg(F.max("size").alias("largest"), F.max("user_name").alias("last_user"))


@query("a05_average")
def _(x):
    return aggregate.metric(x.view("chat_activity"), [aggregate.measure("latency_ms", "AVERAGE", "latency_ms")], ["feature"])


@query("a06_dedup_by_grouping")
def _(x):
    return x.view("index_usage").groupBy("source_name", "day").agg(F.count(F.lit(1)).alias("row_count"))


@query("a07_day_grain")
def _(x):
    return aggregate.metric(x.view("agent_hours_usage"), [F.count(F.lit(1)).alias("row_count")], ["event_time"])


@query("a08_second_dimension")
def _(x):
    return aggregate.metric(x.view("agent_hours_usage"), [aggregate.measure("hours", "SUM", "hours")], ["event_time", "usage_group"])


@query("a09_aggregated_table")
def _(x):
    measures = [aggregate.measure("hours", "SUM", "hours"), aggregate.measure("user_name", "DISTINCT_COUNT", "users")]
    return aggregate.metric(x.view("agent_hours_usage"), measures, ["subscription_type", "resource_type"])


@query("a10_measure_builder")
def _(x):
    specs = [("latency_ms", a) for a in ("COUNT", "DISTINCT_COUNT", "SUM", "AVERAGE", "MAX", "MIN")]
    return aggregate.metric(x.view("chat_activity"), [aggregate.measure(f, a) for f, a in specs], ["surface_type"])


@query("n1_share_of_total")
def _(x):
    counts = x.view("api_audit_trail").groupBy("api_action").agg(F.count(F.lit(1)).alias("calls"))
    return aggregate.share_of_total(counts, "calls")


@query("n2_sort_by_measure")
def _(x):
    calls = x.view("api_audit_trail").groupBy("api_action").agg(F.count(F.lit(1)).alias("calls"))
    return aggregate.sort_desc(calls, "calls", ["api_action"])


@query("n3_sort_by_time")
def _(x):
    return aggregate.sort_desc(x.view("api_audit_trail").select("event_time", "event_id"), "event_time", ["event_id"])


@query("n4_top_n")
def _(x):
    calls = x.view("api_audit_trail").groupBy("user_name").agg(F.count(F.lit(1)).alias("calls"))
    return aggregate.top_n(calls, "calls", ["user_name"], 12)


# --- V: interaction -------------------------------------------------------------------------


@query("v1_time_range")
def _(x):
    return interact.time_range(x.dataset("api-audit-trail"), AS_OF).select("event_time", "event_id")


@query("v2_category_filter")
def _(x):
    return interact.category(x.dataset("index-usage"), "source_type", ["KB"]).select("event_time", "source_name", "source_type")


@query("v3_last_30_days")
def _(x):
    return interact.last_days(x.dataset("chat-activity"), AS_OF + dt.timedelta(days=20)).select("event_time", "conversation_id")


def _snapshot(x: Inputs, name: str) -> tuple[str, DataFrame]:
    path, rows = x.scratch("snapshot"), x.dataset(name)
    snapshots.refresh(rows, path)
    return path, rows


@query("v1_snapshot_time_range")
def _(x):
    path, rows = _snapshot(x, "api-audit-trail")
    return interact.snapshot_time_range(x.spark, path, rows.schema, AS_OF).select("event_time", "event_id")


@query("v3_snapshot_last_30_days")
def _(x):
    path, rows = _snapshot(x, "chat-activity")
    return interact.snapshot_last_days(x.spark, path, rows.schema, AS_OF + dt.timedelta(days=20)).select("event_time", "conversation_id")


@query("v4_click_through")
def _(x):
    picked = {"event_time": dt.date(2024, 1, 9), "feature": "Flow"}
    return interact.click_through(x.dataset("chat-activity"), picked).select("event_time", "feature", "conversation_id")


@query("v4_click_through_many")
def _(x):
    chat = x.dataset("chat-activity")
    per_user = chat.groupBy("user_name", "feature").agg(F.count(F.lit(1)).alias("n"))
    busiest = aggregate.top_n(per_user, "n", ["user_name", "feature"], 20).drop("n")
    return interact.click_through_many(chat, busiest).select("user_name", "feature", "conversation_id", "event_time")


for _key, _spec in visuals.VISUALS.items():
    if _spec.drill:
        query(f"v5_drill_{_key}")(lambda x, key=_key, name=_spec.dataset: visuals.drill(x.dataset(name), key))


@query("v5_drill_average")
def _(x):
    return interact.drill_down(x.dataset("chat-activity"), ["event_time", "feature", "surface_type"], "latency_ms", "AVERAGE", "latency_ms")


# --- M, R: visuals and reports -----------------------------------------------------------------

for _key, _spec in visuals.VISUALS.items():
    _label = "_".join("".join(c if c.isalnum() else " " for c in _spec.title.lower()).split())
    query(f"{_key}_{_label}")(lambda x, key=_key, name=_spec.dataset: visuals.build(x.dataset(name), key))

query("r1_daily_adoption")(lambda x: reports.daily_adoption(x.view("chat_activity")))
query("r2_satisfaction")(lambda x: reports.satisfaction(x.view("feedback_analysis")))
query("r3_hours_by_service")(lambda x: reports.hours_by_service(x.view("agent_hours_usage")))
query("r4_api_activity")(lambda x: reports.api_activity(x.view("api_audit_trail")))
query("r5_largest_sources")(lambda x: reports.largest_sources(x.view("index_usage")))


# --- T: semantic layer ------------------------------------------------------------------------


@query("t1_catalog")
def _(x):
    rows = catalog.catalog_frame({name: x.dataset(name) for name in datasets.DATASETS})
    counts = lake.table_counts({name: x.dataset(name) for name in datasets.DATASETS})
    on = rows["dataset"] == counts["table_name"]
    return rows.join(counts, on).groupBy("dataset", "role", "row_count").agg(F.count(F.lit(1)).alias("columns"))


@query("t1_catalog_columns")
def _(x):
    """Every entry of the catalog, and how many rows have a value in its column."""
    frames = {name: x.dataset(name) for name in datasets.DATASETS}
    rows = catalog.catalog_frame(frames).withColumn("synonyms", F.array_join("synonyms", ", "))
    filled = None
    for name, df in frames.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "filled").withColumn("dataset", F.lit(name))
        filled = counts if filled is None else filled.unionByName(counts)
    return rows.join(filled, ["dataset", "column_name"])


@query("t2_default_aggregation")
def _(x):
    terms = ["conversation_id", "latency_ms", "time_to_first_token_ms", "status"]
    return catalog.metric_query(x.dataset("chat-activity"), "chat-activity", terms, ["surface_type"])


@query("t3_default_date")
def _(x):
    name = "agent-hours-usage"
    return catalog.metric_query(x.dataset(name), name, ["hours"], [catalog.date_column(name)])


@query("t4_synonyms")
def _(x):
    name = "index-usage"
    return catalog.metric_query(
        x.dataset(name), name, ["docs", "Source GB"], ["owner", "kb or space"], filters={"type": ["KB", "SPACE"]}
    )


@query("t5_shown_columns")
def _(x):
    return catalog.shown(x.dataset("feedback-analysis"), "feedback-analysis")


@query("t6_label_domains")
def _(x):
    found = []
    for (name, column), known in catalog.DOMAINS.items():
        labels = x.dataset(name).groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
        inside = F.coalesce(F.col("label").isin(*known), F.lit(False)).alias("known")
        found.append(labels.select(F.lit(column).alias("column_name"), "label", "row_count", inside))
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


# --- X: insights ------------------------------------------------------------------------------


@query("x01_top_users_by_hours")
def _(x):
    return insights.top_users(x.dataset("agent-hours-usage"), F.sum("hours"), "hours")


@query("x01_top_users_by_sessions")
def _(x):
    return insights.top_users(x.dataset("chat-activity"), F.count_distinct("conversation_id"), "sessions")


@query("x01_top_users_by_activity")
def _(x):
    return insights.top_users(x.dataset("api-audit-trail"), F.count(F.lit(1)), "calls")


@query("x02_feature_extremes")
def _(x):
    return insights.feature_extremes(x.dataset("api-audit-trail"), "api_feature")


@query("x03_week_over_week")
def _(x):
    sessions = F.count_distinct("conversation_id")
    return insights.period_change(x.dataset("chat-activity"), sessions, "sessions", "WEEK")


@query("x04_month_over_month")
def _(x):
    return insights.period_change(x.dataset("agent-hours-usage"), F.sum("hours"), "hours", "MONTH")


@query("x05_latency")
def _(x):
    return insights.latency(x.dataset("chat-activity"), ["feature"])


@query("x05_latency_percentiles")
def _(x):
    return insights.latency_percentiles(x.dataset("chat-activity"), ["feature"])


query("x06_overage")(lambda x: insights.overage(x.dataset("agent-hours-usage")))
query("x07_satisfaction_score")(lambda x: insights.satisfaction_score(x.dataset("feedback-analysis"), ["feedback_source"]))
query("x07_reason_themes")(lambda x: insights.reason_themes(x.dataset("feedback-analysis")))
query("x08_error_rate")(lambda x: insights.error_rate(x.dataset("api-audit-trail")))
query("x08_failure_patterns")(lambda x: insights.failure_patterns(x.dataset("api-audit-trail")))
query("x09_storage_by_type")(lambda x: insights.storage_by_type(x.dataset("index-usage")))
query("x10_document_growth")(lambda x: insights.document_growth(x.dataset("index-usage")))
query("x11_underused_features")(lambda x: insights.underused(x.dataset("api-audit-trail"), "api_feature", 0.04))
query("x12_latency_drift")(lambda x: insights.latency_drift(x.dataset("chat-activity")))
query("x12_error_drift")(lambda x: insights.error_drift(x.dataset("api-audit-trail")))
query("x13_index_size_by_day")(lambda x: insights.index_size_by_day(x.dataset("index-usage")))
query("x13_current_index_size")(lambda x: insights.current_index_size(x.dataset("index-usage")))
query("x14_power_users")(lambda x: insights.power_users(x.dataset("chat-activity")))
query("x15_near_limit")(lambda x: insights.near_limit(x.dataset("index-usage"), LIMIT_GB))
query("x16_idle_sources")(
    lambda x: insights.idle_sources(x.dataset("index-usage"), x.dataset("api-audit-trail"), 5, 3.2)
)
query("x17_web_search_usage")(lambda x: insights.web_search_usage(x.dataset("chat-activity")))
query("x18_regional_calls")(lambda x: insights.regional_calls(x.dataset("api-audit-trail")))


# --- G, Q: governance and quality -----------------------------------------------------------------


def _conversations(x: Inputs, include_content: bool) -> DataFrame:
    records = derive.conversation_records(x.spark, x.sf_dir)
    return envelopes.usable(envelopes.transform_log_records(records, "chat_logs", include_content))


@query("g1_restricted_view")
def _(x):
    governance.restricted_view(_conversations(x, True), "chat_logs_open")
    rows = x.spark.table("chat_logs_open")
    return rows.select("conversation_id", "system_message_id", F.lit(len(rows.columns)).alias("n_columns"))


@query("g2_mask_documents")
def _(x):
    return governance.mask_columns(x.source("documents").select("doc_id", "text"), ["text"], MASKED)


@query("g2_mask_all_patterns")
def _(x):
    masked = governance.mask_columns(x.source("conversations"), ["text"])
    return masked.select("conv_id", "turn", "text")


@query("g2_pattern_hits")
def _(x):
    hits = [F.sum(masking.hits(F.col("text"), name)).alias(name.lower()) for name in MASKED]
    return x.source("documents").groupBy("source").agg(*hits)


@query("g3_content_opt_in")
def _(x):
    kept = _conversations(x, True)
    return kept.select("conversation_id", "system_message_id", "user_message", "system_text_message")


@query("g4_use_curated")
def _(x):
    raw, curated = x.landed(*schemas.TABLES), x.scratch("curated")
    lake.register_tables(x.spark, {t: lake.read_raw(x.spark, raw, t) for t in schemas.TABLES})
    lake.curate_all(x.spark, raw, curated)
    lake.use_curated(x.spark, curated)
    return reports.hours_by_service(views.agent_hours_usage(x.spark.table("agent_hours_logs")))


@query("q1_ingest_report")
def _(x):
    return quality.ingest_report(envelopes.route_records(x.records), ["kind"])


@query("q1_ingest_days")
def _(x):
    """What the stream's batches have counted, and the broken lines that were then set apart."""
    root, curated = _streamed(x), x.scratch("curated")
    cut = x.source("events").filter("event_id % 50 = 0").select(F.format_string('{"broken": %d', "event_id").alias("value"))
    days = lake.place(cut, F.lit(INGEST_DATE)).withColumn("batch", F.lit("by-hand"))
    padded = days.withColumns({c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day")})
    padded.write.mode("append").partitionBy(*schemas.PARTITION_COLUMNS, "batch").text(f"{root}/{schemas.PREFIXES['chat_logs']}")
    lake.curate(x.spark, root, curated, "chat_logs")
    return feeds.ingest_days(x.spark, root, "chat_logs", curated)


@query("q1_audit_days")
def _(x):
    root = x.scratch("stream")
    stream = feeds.read_records(x.spark, _delivered_files(x, x.audit_records, "records"))
    feeds.ingest_audit(stream, root, f"{root}-progress", INGEST_DATE, continuous=False).awaitTermination()
    return feeds.ingest_days(x.spark, root, "cloudtrail_events")


@query("q1_unparseable")
def _(x):
    types = {"timestamp": "timestamp_ntz", "latency": "double", "time_to_first_token": "double"}
    return quality.unparseable(x.table("chat_logs"), types)


@query("q2_outside_domain")
def _(x):
    known = catalog.DOMAINS["agent-hours-usage", "service"]
    return quality.outside_domain(x.dataset("agent-hours-usage"), "resource_type", known)


# --- P: streaming -----------------------------------------------------------------------------------


def _delivered_files(x: Inputs, records: DataFrame, name: str) -> str:
    path = x.scratch(name)
    records.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).json(path)
    return path


def _streamed(x: Inputs, table: str = "chat_logs", records: DataFrame | None = None) -> str:
    """Run a log feed to the end of its files; returns the landing root."""
    root = x.scratch("stream")
    stream = feeds.read_records(x.spark, _delivered_files(x, x.records if records is None else records, "records"))
    feeds.ingest_logs(
        stream, table, root, f"{root}-progress", ingest_date=INGEST_DATE, continuous=False
    ).awaitTermination()
    return root


@query("p1_stream_chat_feed")
def _(x):
    rows = lake.read_raw(x.spark, _streamed(x), "chat_logs")
    return rows.select("timestamp", "message_type", "user_arn", "conversation_id", "account_id", "event_timestamp")


def _stream_feed(x: Inputs, table: str, log_type: str) -> DataFrame:
    """A table's rows as delivered records, through the stream, as landed: every column must come back."""
    root = _streamed(x, table, derive.feed_records(x.spark, x.sf_dir, table, log_type))
    return lake.read_raw(x.spark, root, table).drop(*schemas.PARTITION_COLUMNS)


query("p1_stream_feedback_feed")(lambda x: _stream_feed(x, "feedback_logs", "FEEDBACK_LOGS"))
query("p1_stream_hours_feed")(lambda x: _stream_feed(x, "agent_hours_logs", "AGENT_HOURS_LOGS"))
query("p1_stream_index_feed")(lambda x: _stream_feed(x, "index_usage_logs", "INDEX_USAGE_LOGS"))


@query("p1_passthrough")
def _(x):
    kept = f"{_streamed(x)}/{schemas.PASSTHROUGH_PREFIX}/chat_logs"
    return x.spark.read.schema("record_id string, payload string").json(kept).select("record_id", "payload")


@query("p1_stream_audit_feed")
def _(x):
    root = x.scratch("stream")
    stream = feeds.read_records(x.spark, _delivered_files(x, x.audit_records, "records"))
    feeds.ingest_audit(stream, root, f"{root}-progress", INGEST_DATE, continuous=False).awaitTermination()
    rows = lake.read_raw(x.spark, root, "cloudtrail_events")
    return rows.select("event_id", "timestamp", "user_name", "resource_type", "year", "month", "day")


@query("p2_arrival_days")
def _(x):
    return lake.landed_days(lake.read_raw(x.spark, _streamed(x), "chat_logs"))


@query("p3_failure_stream")
def _(x):
    root = _streamed(x)
    errors = f"{root}/{schemas.ERROR_PREFIX}/chat_logs"
    records = x.spark.read.schema("record_id string, data string").json(f"{errors}/records")
    events = x.spark.read.schema("record_id string, reason string").json(f"{errors}/events")
    return records.select("record_id", F.lit("unreadable").alias("reason")).unionByName(
        events.select("record_id", "reason")
    )


@query("p4_scheduled_refresh")
def _(x):
    """Two landings, a refresh after each; days of both are whole and single."""
    raw, curated = x.scratch("raw"), x.scratch("curated")
    rows = x.table("feedback_logs")
    early = F.col("day") <= 10
    overlap = (F.col("day") == 10) & (F.col("feedback_type") == "Useful")
    for part in (rows.filter(early & ~overlap), rows.filter(~early | overlap)):
        lake.land(part, f"{raw}/{schemas.PREFIXES['feedback_logs']}")
        feeds.refresh_once(x.spark, raw, curated, "feedback_logs", f"{curated}-progress")
    return lake.read_curated(x.spark, curated, "feedback_logs")


def _run_to_table(x: Inputs, stream: DataFrame, name: str) -> DataFrame:
    path = x.scratch(name)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-progress").trigger(
        availableNow=True
    ).start(path).awaitTermination()
    return x.spark.read.schema(stream.schema).parquet(path)


def _stream_of(x: Inputs, rows: DataFrame, name: str) -> DataFrame:
    path = x.scratch(name)
    rows.write.parquet(path)
    return x.spark.readStream.schema(rows.schema).parquet(path)


@query("p5_deduplicate")
def _(x):
    events = x.source("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    again = _stream_of(x, events.unionByName(events), "redelivered")
    return _run_to_table(x, feeds.deduplicate(again, "ts", delay="60 days"), "deduplicated").select(
        "event_id", "event_type"
    )


def _daily(x: Inputs) -> DataFrame:
    events = x.source("events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    return _run_to_table(x, feeds.daily_activity(_stream_of(x, events, "activity"), "ts", "user_id"), "daily")


query("p6_daily_calls")(lambda x: _daily(x).select("day", "calls"))
query("p6_daily_active_users")(lambda x: _daily(x).select("day", "active_users"))
