"""Table schemas and the feed registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names, types and order of the five tables ----------
CHAT_LOGS = """
timestamp string, log_group string, log_stream string, message_type string,
user_arn string, user_type string, agent_id string, flow_id string,
conversation_id string, system_message_id string, user_message_id string,
user_selected_resources string, status_code string, message_scope string,
action_connectors string, cited_resource string, file_attachment string,
resource_arn string, account_id string, event_timestamp bigint,
namespace string, latency string, time_to_first_token string,
surface_type string, web_search string
"""
FEEDBACK_LOGS = """
timestamp string, log_group string, log_stream string, message_type string,
user_arn string, user_type string, conversation_id string,
system_message_id string, user_message_id string, research_id string,
feedback_type string, feedback_reason string, feedback_details string,
rating string, status_code string, resource_arn string, account_id string,
event_timestamp bigint, namespace string
"""
AGENT_HOURS_LOGS = """
timestamp string, log_group string, log_stream string, message_type string,
user_arn string, subscription_type string, reporting_service string,
usage_group string, usage_hours double, service_resource_arn string,
resource_arn string, account_id string, event_timestamp bigint
"""
CLOUDTRAIL_EVENTS = """
timestamp string, event_id string, event_name string, event_source string,
event_type string, event_category string, aws_region string,
source_ip string, user_agent string, user_type string, principal_id string,
user_name string, user_arn string, account_id string,
recipient_account_id string, shared_event_id string, read_only boolean,
error_code string, error_message string, request_parameters string,
response_elements string, service_event_details string, resources string,
resource_type string, resource_arn string
"""
INDEX_USAGE_LOGS = """
timestamp string, log_group string, log_stream string, message_type string,
user_arn string, consumed_index_size bigint, source_type string,
source_name string, source_arn string, consumed_source_size bigint,
consumed_source_doc_count bigint, resource_arn string, account_id string,
event_timestamp bigint
"""
PARTITIONS = "year int, month int, day int"
SENSITIVE = ("user_message", "system_text_message")

# Columns every log table takes from the envelope, never from the message.
ENVELOPE_COLUMNS = ("timestamp", "log_group", "log_stream", "message_type")

# Fields delivered per log type, in delivery order. The last feed spells the
# type and account keys in snake case.
RECORD_FIELDS = {
    "CHAT_LOGS": """
        user_arn user_type status_code conversation_id system_message_id
        user_message_id agent_id flow_id message_scope user_selected_resources
        action_connectors cited_resource file_attachment resource_arn
        event_timestamp logType accountId namespace latency
        time_to_first_token surface_type web_search""".split(),
    "FEEDBACK_LOGS": """
        user_arn user_type status_code conversation_id system_message_id
        user_message_id research_id feedback_type feedback_reason
        feedback_details rating resource_arn event_timestamp logType accountId
        namespace""".split(),
    "AGENT_HOURS_LOGS": """
        user_arn subscription_type reporting_service usage_group usage_hours
        service_resource_arn resource_arn event_timestamp logType
        accountId""".split(),
    "INDEX_USAGE_LOGS": """
        resource_arn event_timestamp log_type account_id user_arn
        consumed_index_size source_type source_name source_arn
        consumed_source_size consumed_source_doc_count""".split(),
}

# Landing prefix of each feed.
PREFIXES = {
    "chat_logs": "cloudwatch-logs/chat",
    "feedback_logs": "cloudwatch-logs/feedback",
    "agent_hours_logs": "cloudwatch-logs/agent-hours",
    "cloudtrail_events": "cloudtrail",
    "index_usage_logs": "cloudwatch-logs/index-usage",
}
ERROR_PREFIX = "errors"
PASSTHROUGH_PREFIX = "passthrough"
QUARANTINE_PREFIX = "quarantine"
REPORT_PREFIX = "reports"

# Range the projected scan accepts.
FIRST_YEAR, LAST_YEAR = 2024, 2030
# --- end of fixed values ------------------------------------------------------

_DDL = {
    "chat_logs": CHAT_LOGS,
    "feedback_logs": FEEDBACK_LOGS,
    "agent_hours_logs": AGENT_HOURS_LOGS,
    "cloudtrail_events": CLOUDTRAIL_EVENTS,
    "index_usage_logs": INDEX_USAGE_LOGS,
}


@dataclass(frozen=True)
class Feed:
    """One feed: its table, where it lands, and the schema it must have."""

    table: str
    prefix: str
    data: T.StructType

    @property
    def schema(self) -> T.StructType:
        return T.StructType(self.data.fields + PARTITION_SCHEMA.fields)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
}


def _parse(columns: str) -> T.StructType:
    # Not StructType.fromDDL: that needs a running session at import.
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PARTITION_SCHEMA = _parse(PARTITIONS)
PARTITION_COLUMNS = PARTITION_SCHEMA.fieldNames()
TABLES = tuple(_DDL)


def feed(table: str, include_content: bool = False) -> Feed:
    """The feed behind ``table``; message content is an opt-in of the chat feed."""
    data = _parse(_DDL[table])
    if include_content and table == "chat_logs":
        for name in SENSITIVE:
            data = data.add(name, T.StringType())
    return Feed(table, PREFIXES[table], data)
