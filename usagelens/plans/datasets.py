"""The five dashboard datasets: near copies of the views, with stated changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.functions import classify
from usagelens.functions import expressions as E
from usagelens.plans import views

# --- fixed values: columns a dataset delivers, in order -----------------------
PROJECTIONS = {
    "chat-activity": """
        event_time user_name feature status conversation_id agent_id flow_id
        latency_ms time_to_first_token_ms surface_type web_search
        message_scope action_connectors namespace account_id""".split(),
    "feedback-analysis": """
        event_time user_name status conversation_id research_id
        feedback_source feedback_type reason details rating namespace
        account_id""".split(),
    "agent-hours-usage": """
        event_time user_name service hours usage_group resource_type
        resource_id subscription_type service_resource_arn
        account_id""".split(),
    "api-audit-trail": """
        event_time event_id api_action event_source event_type user_name
        user_type source_ip user_agent aws_region read_or_write error_code
        error_message resource_type resource_arn request_parameters
        recipient_account_id api_feature account_id""".split(),
    "index-usage": """
        event_time user_name consumed_index_size consumed_index_size_gb
        consumed_index_size_mb source_type source_name source_arn
        consumed_source_size consumed_source_size_gb consumed_source_size_mb
        consumed_source_doc_count account_id""".split(),
}
# --- end of fixed values ------------------------------------------------------


def project(df: DataFrame, dataset: str) -> DataFrame:
    """The dataset's columns only, in its order."""
    return df.select(*PROJECTIONS[dataset])


def chat_activity(chat_logs: DataFrame) -> DataFrame:
    return project(views.chat_activity(chat_logs, E.instant), "chat-activity")


def feedback_analysis(feedback_logs: DataFrame) -> DataFrame:
    """Keeps the name ``feedback_type``, which the view changes."""
    return project(views.feedback_analysis(feedback_logs, E.instant, "feedback_type"), "feedback-analysis")


def agent_hours_usage(agent_hours_logs: DataFrame) -> DataFrame:
    return project(views.agent_hours_usage(agent_hours_logs, E.instant), "agent-hours-usage")


def api_audit_trail(cloudtrail_events: DataFrame) -> DataFrame:
    """Own classifier, and rows without a timestamp stay."""
    rows = views.audit_columns(cloudtrail_events, E.instant, classify.dataset_feature)
    return project(rows, "api-audit-trail")


def index_usage(index_usage_logs: DataFrame) -> DataFrame:
    return project(views.index_usage(index_usage_logs), "index-usage")


# Dataset name -> (table, function).
DATASETS = {
    "chat-activity": ("chat_logs", chat_activity),
    "feedback-analysis": ("feedback_logs", feedback_analysis),
    "agent-hours-usage": ("agent_hours_logs", agent_hours_usage),
    "api-audit-trail": ("cloudtrail_events", api_audit_trail),
    "index-usage": ("index_usage_logs", index_usage),
}


def dataset(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A dataset over the registered tables, of ``database`` when one is named."""
    table, make = DATASETS[name]
    return make(spark.table(f"{database}.{table}" if database else table))
