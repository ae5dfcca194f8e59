"""The six curated views, each a function from a table to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import classify
from usagelens.functions import expressions as E
from usagelens.schemas import PARTITION_COLUMNS

# --- fixed values: which audit events are database queries, and where their
# details sit ------------------------------------------------------------------
QUERY_EVENT = "QueryDatabase"
QUERY_SOURCE = "quicksight.amazonaws.com"
QUERY_DETAILS = "eventRequestDetails"
QUERY_FIELDS = {
    "datasource_id": "dataSourceId",
    "query_id": "queryId",
    "dashboard_or_analysis_id": "resourceId",
    "dataset_id": "dataSetId",
    "dataset_mode": "dataSetMode",
}
# --- end of fixed values ------------------------------------------------------


def timed(df: DataFrame) -> DataFrame:
    """Rows that carry a timestamp text at all."""
    return df.filter(F.col("timestamp").isNotNull())


def _user() -> list:
    return [F.col("user_arn").alias("user_id"), E.short_name(F.col("user_arn")).alias("user_name")]


def chat_activity(chat_logs: DataFrame, time=E.wall_time) -> DataFrame:
    return timed(chat_logs).select(
        time(F.col("timestamp")).alias("event_time"),
        *_user(),
        F.col("status_code").alias("status"),
        "conversation_id",
        "agent_id",
        "flow_id",
        "action_connectors",
        "namespace",
        E.chat_feature(F.col("flow_id"), F.col("agent_id")).alias("feature"),
        E.as_double(F.col("latency")).alias("latency_ms"),
        E.as_double(F.col("time_to_first_token")).alias("time_to_first_token_ms"),
        "surface_type",
        "web_search",
        "message_scope",
        "account_id",
        *PARTITION_COLUMNS,
    )


def feedback_analysis(feedback_logs: DataFrame, time=E.wall_time, type_name: str = "satisfaction") -> DataFrame:
    return timed(feedback_logs).select(
        time(F.col("timestamp")).alias("event_time"),
        *_user(),
        F.col("status_code").alias("status"),
        "conversation_id",
        "research_id",
        E.feedback_source(F.col("research_id")).alias("feedback_source"),
        F.col("feedback_type").alias(type_name),
        F.col("feedback_reason").alias("reason"),
        F.col("feedback_details").alias("details"),
        "rating",
        "namespace",
        "account_id",
        *PARTITION_COLUMNS,
    )


def agent_hours_usage(agent_hours_logs: DataFrame, time=E.wall_time) -> DataFrame:
    service = F.col("reporting_service")
    return timed(agent_hours_logs).select(
        time(F.col("timestamp")).alias("event_time"),
        *_user(),
        "subscription_type",
        service.alias("service"),
        "usage_group",
        F.col("usage_hours").alias("hours"),
        "service_resource_arn",
        E.resource_label(service).alias("resource_type"),
        E.short_name(F.col("service_resource_arn")).alias("resource_id"),
        "account_id",
        *PARTITION_COLUMNS,
    )


def audit_columns(cloudtrail_events: DataFrame, time, feature) -> DataFrame:
    """Audit columns under either classifier; all rows."""
    name = F.col("event_name")
    return cloudtrail_events.select(
        time(F.col("timestamp")).alias("event_time"),
        "event_id",
        name.alias("api_action"),
        "event_source",
        "event_type",
        "user_name",
        "user_type",
        "source_ip",
        "user_agent",
        "aws_region",
        E.read_or_write(F.col("read_only")).alias("read_or_write"),
        "error_code",
        "error_message",
        "resource_type",
        "resource_arn",
        "request_parameters",
        "recipient_account_id",
        "shared_event_id",
        feature(name).alias("api_feature"),
        "account_id",
        *PARTITION_COLUMNS,
    )


def api_audit_trail(cloudtrail_events: DataFrame) -> DataFrame:
    return audit_columns(timed(cloudtrail_events), E.wall_time, classify.view_feature)


def is_database_query():
    return (F.col("event_name") == QUERY_EVENT) & (F.col("event_source") == QUERY_SOURCE)


def querydatabase_events(cloudtrail_events: DataFrame) -> DataFrame:
    details = E.json_scalars(F.col("service_event_details"), QUERY_DETAILS, QUERY_FIELDS)
    return timed(cloudtrail_events).filter(is_database_query()).select(
        E.wall_time(F.col("timestamp")).alias("event_time"),
        "event_id",
        "user_name",
        "user_type",
        "aws_region",
        "error_code",
        *[column.alias(name) for name, column in details.items()],
        "account_id",
        *PARTITION_COLUMNS,
    )


def index_usage(index_usage_logs: DataFrame) -> DataFrame:
    """One row per source, totals and day.

    The feed repeats a source's totals once per indexed document. Maxima of text
    cannot be kept in a hash aggregate, which would mean sorting every row first.
    So the texts are grouped by before they are compared: the first step hashes
    the repeats away on the map side, the second meets only what is left.
    """
    index_size, source_size = F.col("consumed_index_size"), F.col("consumed_source_size")
    keys = [
        "source_arn",
        "source_type",
        "source_name",
        "consumed_index_size",
        "consumed_source_size",
        "consumed_source_doc_count",
        *PARTITION_COLUMNS,
    ]
    return (
        timed(index_usage_logs)
        .groupBy(*keys, E.short_name(F.col("user_arn")).alias("user_name"), "resource_arn", "account_id")
        .agg(F.max(E.wall_time(F.col("timestamp"))).alias("event_time"))
        .groupBy(*keys)
        .agg(
            F.max("event_time").alias("event_time"),
            F.max("user_name").alias("user_name"),
            F.max("resource_arn").alias("resource_arn"),
            F.max("account_id").alias("account_id"),
        )
        .select(
            "event_time",
            "user_name",
            "consumed_index_size",
            E.gigabytes(index_size).alias("consumed_index_size_gb"),
            E.megabytes(index_size).alias("consumed_index_size_mb"),
            "source_type",
            "source_name",
            "source_arn",
            "consumed_source_size",
            E.gigabytes(source_size).alias("consumed_source_size_gb"),
            E.megabytes(source_size).alias("consumed_source_size_mb"),
            "consumed_source_doc_count",
            "resource_arn",
            "account_id",
            *PARTITION_COLUMNS,
        )
    )


# View name -> (table, function).
VIEWS = {
    "chat_activity": ("chat_logs", chat_activity),
    "feedback_analysis": ("feedback_logs", feedback_analysis),
    "agent_hours_usage": ("agent_hours_logs", agent_hours_usage),
    "api_audit_trail": ("cloudtrail_events", api_audit_trail),
    "querydatabase_events": ("cloudtrail_events", querydatabase_events),
    "index_usage": ("index_usage_logs", index_usage),
}


def register_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Build every view whose table is given and expose it to SQL by name."""
    built = {name: make(tables[table]) for name, (table, make) in VIEWS.items() if table in tables}
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    return built
