"""Semantic catalog: what each dataset column means and how it aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.operators import aggregate

@dataclass(frozen=True)
class Entry:
    """A dataset column as a reader knows it.

    Its default aggregation, if it has one, and its kind of meaning: DATE makes the
    default date column, at day grain. What isn't shown is hidden from readers.
    """

    column: str
    label: str
    description: str | None = None
    aggregation: str | None = None
    meaning: str | None = None
    synonyms: Sequence[str] = ()
    shown: bool = True


# --- fixed values -------------------------------------------------------------
CATALOG = {
    "chat-activity": [
        Entry("event_time", "Event Time", description="Timestamp of the chat message", meaning="DATE", synonyms=["date", "time", "when", "timestamp", "message date"]),
        Entry("user_name", "User", description="Name of the user who sent the message", meaning="PERSON", synonyms=["person", "employee", "who", "sender"]),
        Entry("feature", "Feature", description="Which feature was used: Chat Agent, Flow, Automation, or Direct Chat", meaning="CATEGORY", synonyms=["product", "capability", "feature type", "what feature"]),
        Entry("status", "Status", description="Response status code (success, request_blocked, no_answer_found)", meaning="CATEGORY", synonyms=["result", "outcome", "status code"]),
        Entry("conversation_id", "Conversation", description="Unique conversation identifier", aggregation="DISTINCT_COUNT", synonyms=["chat", "session", "thread"]),
        Entry("agent_id", "Chat Agent", description="Chat agent that handled the message", aggregation="DISTINCT_COUNT", synonyms=["bot", "assistant", "agent", "q agent"]),
        Entry("flow_id", "Flow", description="Flow identifier used in the conversation", aggregation="DISTINCT_COUNT", synonyms=["workflow", "flow"]),
        Entry("action_connectors", "Action Connector", description="Automation action connector invoked during the conversation", synonyms=["automation", "connector", "action"]),
        Entry("latency_ms", "Latency (ms)", description="End-to-end response latency in milliseconds", aggregation="AVERAGE", meaning="DURATION", synonyms=["response time", "delay", "speed", "how long", "duration"]),
        Entry("time_to_first_token_ms", "Time to First Token (ms)", description="Time until the first response token in milliseconds", aggregation="AVERAGE", meaning="DURATION", synonyms=["ttft", "first token", "initial response time"]),
        Entry("surface_type", "Surface Type", description="Where the chat originated (console, IDE, etc.)", meaning="CATEGORY", synonyms=["channel", "interface", "source", "origin"]),
        Entry("web_search", "Web Search Used", description="Whether web search was used for the response", meaning="CATEGORY", synonyms=["internet", "web", "search"]),
        Entry("message_scope", "Message Scope", description="Resource scope of the message: no_resources, all_resources, or specific_resource", meaning="CATEGORY", synonyms=["scope", "resource scope", "context"]),
        Entry("namespace", "Namespace"),
        Entry("account_id", "Account Id", shown=False),
    ],
    "feedback-analysis": [
        Entry("event_time", "Event Time", description="When the feedback was submitted", meaning="DATE", synonyms=["date", "time", "when", "timestamp"]),
        Entry("user_name", "User", description="User who submitted feedback", meaning="PERSON", synonyms=["person", "employee", "who", "reviewer"]),
        Entry("feedback_source", "Feedback Source", description="Whether feedback is for Research or Chat", meaning="CATEGORY", synonyms=["source", "from research", "from chat"]),
        Entry("reason", "Reason", description="Reason selected for the feedback", meaning="CATEGORY", synonyms=["why", "cause", "feedback reason"]),
        Entry("details", "Details", description="Free-text feedback details written by the user", synonyms=["comment", "note", "text", "written feedback"]),
        Entry("rating", "Rating", description="Numeric rating if provided", synonyms=["score", "stars", "numeric rating"]),
        Entry("status", "Status", description="Response status code for the feedback event", meaning="CATEGORY", synonyms=["result", "outcome", "status code"]),
        Entry("conversation_id", "Conversation", description="Conversation the feedback relates to", aggregation="DISTINCT_COUNT", synonyms=["chat", "session", "thread"]),
        Entry("research_id", "Research ID", description="Research session the feedback relates to", aggregation="DISTINCT_COUNT", synonyms=["research", "research session"]),
        Entry("namespace", "Namespace"),
        Entry("account_id", "Account Id", shown=False),
        Entry("feedback_type", "Feedback Type"),
    ],
    "agent-hours-usage": [
        Entry("event_time", "Event Time", description="When the usage was recorded", meaning="DATE", synonyms=["date", "time", "when", "timestamp"]),
        Entry("user_name", "User", description="User consuming agent hours", meaning="PERSON", synonyms=["person", "employee", "who", "consumer"]),
        Entry("subscription_type", "Subscription", description="Subscription tier (Pro, Reader, etc.)", meaning="CATEGORY", synonyms=["plan", "tier", "license"]),
        Entry("service", "Service", description="Service consuming hours: Research, Chat, Automation, Flows, etc.", meaning="CATEGORY", synonyms=["product", "feature", "reporting service", "research", "chat", "automation", "flows"]),
        Entry("usage_group", "Usage Group", description="Whether hours are included or extra", meaning="CATEGORY", synonyms=["included", "extra", "overage", "billing group"]),
        Entry("hours", "Hours", description="Number of agent hours consumed", aggregation="SUM", synonyms=["usage", "consumption", "time used", "agent hours", "cost"]),
        Entry("resource_type", "Resource Type", description="Service consuming hours: Automation, Flow, Research", meaning="CATEGORY", synonyms=["resource", "asset", "service type"]),
        Entry("resource_id", "Resource ID", description="Specific resource identifier consuming hours", aggregation="DISTINCT_COUNT", synonyms=["resource name", "resource id"]),
        Entry("service_resource_arn", "Service Resource Arn"),
        Entry("account_id", "Account Id", shown=False),
    ],
    "api-audit-trail": [
        Entry("event_time", "Event Time", description="When the API call occurred", meaning="DATE", synonyms=["date", "time", "when", "timestamp"]),
        Entry("event_id", "Event ID", description="Unique event identifier of the audit trail, for cross-referencing", synonyms=["event id", "trail id", "cloudtrail id"]),
        Entry("api_action", "API Action", description="API operation called (CreateDashboard, DescribeDataSet, etc.)", meaning="CATEGORY", synonyms=["operation", "action", "event", "api call", "method"]),
        Entry("event_source", "Event Source", description="Service that generated the event", meaning="CATEGORY", synonyms=["source service", "aws service"]),
        Entry("user_name", "Caller", description="IAM user or role that made the call", meaning="PERSON", synonyms=["who", "user", "caller", "identity", "principal"]),
        Entry("source_ip", "Source IP", description="IP address the call originated from", meaning="IP_ADDRESS", synonyms=["ip", "ip address", "origin", "client ip"]),
        Entry("aws_region", "Region", description="AWS region where the API call was made", meaning="CATEGORY", synonyms=["region", "location"]),
        Entry("error_code", "Error Code", description="Error code if the call failed", meaning="CATEGORY", synonyms=["error", "failure", "exception"]),
        Entry("read_or_write", "Read or Write", description="Whether the API call was read-only or a write operation", meaning="CATEGORY", synonyms=["read", "write", "mutation"]),
        Entry("resource_type", "Resource Type", description="Type of resource affected (dashboard, dataset, analysis, etc.)", meaning="CATEGORY", synonyms=["resource", "asset type"]),
        Entry("resource_arn", "Resource ARN", description="ARN of the primary resource affected", synonyms=["arn", "resource"]),
        Entry("request_parameters", "Request Parameters", description="JSON payload of the API call showing what was requested", synonyms=["parameters", "payload", "request", "what changed"]),
        Entry("recipient_account_id", "Recipient Account", description="Account that received the event (for cross-account scenarios)", synonyms=["recipient", "target account", "cross account"]),
        Entry("user_agent", "User Agent", description="Client user agent string (SDK, console, CLI)", synonyms=["client", "sdk", "tool"]),
        Entry("error_message", "Error Message", description="Detailed error message if the API call failed", synonyms=["error detail", "failure message", "what went wrong"]),
        Entry("api_feature", "API Feature", description="Feature category of the API call: Dashboard, Space, Knowledge Base, Dataset, Topic, etc.", meaning="CATEGORY", synonyms=["feature", "category", "what feature", "space", "knowledge base", "dashboard"]),
        Entry("user_type", "User Type"),
        Entry("event_type", "Event Type"),
        Entry("account_id", "Account Id", shown=False),
    ],
    "index-usage": [
        Entry("event_time", "Event Time", description="Timestamp of the index usage measurement", meaning="DATE", synonyms=["date", "time", "when", "timestamp", "measurement date"]),
        Entry("consumed_index_size_gb", "Index Size (GB)", description="Total consumed index size in gigabytes", aggregation="SUM", synonyms=["index size", "total size", "index gb", "storage size", "index storage"]),
        Entry("consumed_source_size_gb", "Source Size (GB)", description="Size consumed by this source in gigabytes", aggregation="SUM", synonyms=["source size", "source gb", "kb size", "space size", "data size"]),
        Entry("consumed_source_doc_count", "Document Count", description="Number of documents from this source", aggregation="SUM", synonyms=["docs", "documents", "doc count", "number of documents", "file count"]),
        Entry("source_type", "Source Type", description="Type of source: KB (Knowledge Base) or SPACE", meaning="CATEGORY", synonyms=["type", "kb or space", "knowledge base", "space", "source category"]),
        Entry("source_name", "Source Name", description="Human-readable name of the knowledge base or Space", synonyms=["name", "kb name", "space name", "source", "resource name"]),
        Entry("source_arn", "Source ARN", description="Full ARN of the source resource", synonyms=["arn", "resource arn", "source resource"]),
        Entry("user_name", "User", description="User associated with the index usage event", meaning="PERSON", synonyms=["person", "employee", "who", "owner"]),
        Entry("account_id", "Account Id", shown=False),
    ],
}
# Labels the datasets are documented to carry.
DOMAINS = {
    ("agent-hours-usage", "service"): ["RESEARCH", "FLOW", "AUTOMATION", "CHAT"],
    ("agent-hours-usage", "usage_group"): ["Included", "Extra"],
    ("chat-activity", "feature"): ["System Chat Agent (My Assistant)", "Custom Chat Agent", "Flow"],
    ("chat-activity", "status"): ["success", "request_blocked", "no_answer_found"],
    ("chat-activity", "message_scope"): ["no_resources", "all_resources", "specific_resource"],
    ("feedback-analysis", "feedback_type"): ["Useful", "Not Useful"],
    ("feedback-analysis", "reason"): ["Inaccurate", "Incomplete", "Too wordy", "Too slow"],
    ("index-usage", "source_type"): ["SPACE", "KB"],
    ("api-audit-trail", "read_or_write"): ["Read", "Write"],
}
# --- end of fixed values ------------------------------------------------------

# How a measure is summed without rounding drift: decimals of a scaled column.
_SCALE = {"consumed_index_size_gb": 4, "consumed_source_size_gb": 4}


def entries(dataset: str) -> list[Entry]:
    """The dataset's catalog, in order."""
    return CATALOG[dataset]


def entry(dataset: str, column: str) -> Entry:
    return {e.column: e for e in entries(dataset)}[column]


def catalog_frame(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The catalog of the given datasets as rows, checked against their schemas.

    A catalog column a dataset lacks is an error.
    """
    rows = []
    for name, df in datasets.items():
        types = dict(df.dtypes)
        for e in entries(name):
            if e.column not in types:
                raise ValueError(f"{name} has no column {e.column}")
            role = "MEASURE" if e.aggregation in ("SUM", "AVERAGE") else "DIMENSION"
            rows.append((name, e.column, e.label, e.description, role, e.aggregation, e.meaning, list(e.synonyms), types[e.column], e.shown))
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame(
        rows,
        "dataset string, column_name string, label string, description string, role string,"
        " aggregation string, meaning string, synonyms array<string>, data_type string, shown boolean",
    )


def shown(df: DataFrame, dataset: str) -> DataFrame:
    """The dataset without its hidden columns."""
    visible = {e.column for e in entries(dataset) if e.shown}
    return df.select(*[c for c in df.columns if c in visible])


def resolve(dataset: str, term: str) -> str:
    """Column behind a name, label or synonym; exact but for letter case.

    A column's own name beats a label, a label beats a synonym.
    """
    wanted = term.strip().lower()
    catalog = entries(dataset)
    for key in (
        lambda e: [e.column],
        lambda e: [e.label.lower()],
        lambda e: [s.lower() for s in e.synonyms],
    ):
        hits = [e.column for e in catalog if e.shown and wanted in key(e)]
        if len(hits) > 1:
            raise ValueError(f"{term!r} means several columns of {dataset}: {hits}")
        if hits:
            return hits[0]
    raise KeyError(f"{dataset} has no column called {term!r}")


def date_column(dataset: str) -> str:
    return next(e.column for e in entries(dataset) if e.meaning == "DATE")


def measure(dataset: str, column: str, agg: str | None = None, name: str | None = None) -> Column:
    """A measure, by default with the column's own aggregation, else a count.

    Sums of columns with fixed decimals are taken exactly, so the result does
    not depend on the order in which partitions arrive.
    """
    agg = agg or entry(dataset, column).aggregation or "COUNT"
    if agg == "SUM" and column in _SCALE:
        exact = F.sum(F.col(column).cast(f"decimal(38,{_SCALE[column]})")).cast("double")
        return exact.alias(name or f"{column}_sum")
    return aggregate.measure(column, agg, name)


def metric_query(
    df: DataFrame,
    dataset: str,
    measures: Sequence[str | tuple[str, str]],
    dims: Sequence[str] = (),
    grain: str = "DAY",
    filters: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Measures by dimensions, all named as a reader would name them.

    A measure is a term, aggregated by its default, or (term, aggregation).
    """
    for term, values in (filters or {}).items():
        df = df.filter(F.col(resolve(dataset, term)).isin(*values))
    wanted = [m if isinstance(m, tuple) else (m, None) for m in measures]
    columns = [measure(dataset, resolve(dataset, term), agg) for term, agg in wanted]
    return aggregate.metric(df, columns, [resolve(dataset, d) for d in dims], grain)
