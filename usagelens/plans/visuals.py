"""The 27 dashboard visuals, as data, and the one builder that runs them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from usagelens.operators import aggregate, interact
from usagelens.plans import catalog

CHAT, HOURS, FEEDBACK, AUDIT, INDEX = (
    "chat-activity",
    "agent-hours-usage",
    "feedback-analysis",
    "api-audit-trail",
    "index-usage",
)


@dataclass(frozen=True)
class Visual:
    """A measure by dimensions, or (with ``rows``) the rows themselves."""

    title: str
    dataset: str
    measure: tuple[str, str, str] | None = None  # column, aggregation, output name
    by: tuple[str, ...] = ()
    top: bool = False
    rows: tuple[str, ...] = ()
    latest_first: bool = False
    only: dict[str, list[str]] = field(default_factory=dict)
    drill: tuple[str, ...] = ()


_USERS = ("user_name", "DISTINCT_COUNT", "unique_users")
_SESSIONS = ("conversation_id", "DISTINCT_COUNT", "chat_sessions")
_HOURS = ("hours", "SUM", "agent_hours")
_CALLS = ("api_action", "COUNT", "api_calls")
_INDEX_GB = ("consumed_index_size_gb", "SUM", "index_size_gb")
_SOURCE_GB = ("consumed_source_size_gb", "SUM", "source_size_gb")

# --- fixed values: the visuals, sheet by sheet ---------------------------------
VISUALS = {
    "m01": Visual("Active Users", CHAT, _USERS),
    "m02": Visual("Total Chat Sessions", CHAT, _SESSIONS),
    "m03": Visual(
        "User Adoption Trend", CHAT, _USERS, ("event_time",), drill=("event_time", "feature", "user_name")
    ),
    "m04": Visual("Chat Sessions by Feature", CHAT, _SESSIONS, ("feature",), drill=("feature", "user_name")),
    "m05": Visual(
        "Top Users by Chat Sessions", CHAT, _SESSIONS, ("user_name",), top=True, drill=("user_name", "feature")
    ),
    "m06": Visual(
        "Feature Adoption Over Time",
        CHAT,
        _SESSIONS,
        ("event_time", "feature"),
        drill=("event_time", "feature", "user_name"),
    ),
    "m07": Visual("Sessions by Status", CHAT, _SESSIONS, ("status",), drill=("status", "user_name")),
    "m08": Visual(
        "Chat Session Details",
        CHAT,
        rows=("event_time", "user_name", "feature", "status", "conversation_id", "latency_ms", "surface_type"),
        latest_first=True,
    ),
    "m09": Visual("Total Agent Hours", HOURS, _HOURS),
    "m10": Visual(
        "Agent Hours by Service", HOURS, _HOURS, ("service",), drill=("service", "resource_type", "user_name")
    ),
    "m11": Visual(
        "Top Users by Agent Hours", HOURS, _HOURS, ("user_name",), top=True, drill=("user_name", "service")
    ),
    "m12": Visual(
        "Included vs Extra Hours",
        HOURS,
        _HOURS,
        ("usage_group",),
        drill=("usage_group", "service", "user_name"),
    ),
    "m13": Visual(
        "Agent Hours Trend by Service",
        HOURS,
        _HOURS,
        ("event_time", "service"),
        drill=("event_time", "service", "user_name"),
    ),
    "m14": Visual(
        "Agent Hours Details",
        HOURS,
        rows=("event_time", "user_name", "service", "hours", "usage_group", "resource_type", "resource_id"),
        latest_first=True,
    ),
    "m15": Visual(
        "Satisfaction Distribution",
        FEEDBACK,
        ("feedback_type", "COUNT", "feedback_responses"),
        ("feedback_type",),
        drill=("feedback_type", "user_name"),
    ),
    "m16": Visual(
        "Top Feedback Reasons",
        FEEDBACK,
        ("reason", "COUNT", "feedback_responses"),
        ("reason",),
        drill=("reason", "user_name"),
    ),
    "m17": Visual(
        "Feedback Details",
        FEEDBACK,
        rows=("user_name", "feedback_type", "feedback_source", "reason", "details"),
    ),
    "m18": Visual(
        "API Activity by Feature",
        AUDIT,
        _CALLS,
        ("api_feature",),
        drill=("api_feature", "api_action", "user_name"),
    ),
    "m19": Visual(
        "API Callers by Identity Type", AUDIT, _CALLS, ("user_type",), drill=("user_type", "api_feature")
    ),
    "m20": Visual(
        "Recent API Operations",
        AUDIT,
        rows=(
            "event_time",
            "event_id",
            "api_action",
            "api_feature",
            "user_name",
            "user_type",
            "read_or_write",
            "resource_arn",
            "error_code",
        ),
        latest_first=True,
    ),
    "m21": Visual("Total Index Size (GB)", INDEX, _INDEX_GB),
    "m22": Visual("Storage by Source Type", INDEX, _SOURCE_GB, ("source_type",)),
    "m23": Visual("Index Storage Trend", INDEX, _INDEX_GB, ("event_time",)),
    "m24": Visual(
        "Top Knowledge Bases by Size", INDEX, _SOURCE_GB, ("source_name",), top=True, only={"source_type": ["KB"]}
    ),
    "m25": Visual(
        "Top Spaces by Size", INDEX, _SOURCE_GB, ("source_name",), top=True, only={"source_type": ["SPACE"]}
    ),
    "m26": Visual("Top Users by Storage", INDEX, _SOURCE_GB, ("user_name",), top=True),
    "m27": Visual(
        "All Sources Detail",
        INDEX,
        rows=(
            "event_time",
            "source_name",
            "source_type",
            "source_arn",
            "consumed_source_size_gb",
            "consumed_source_doc_count",
            "consumed_index_size_gb",
            "user_name",
        ),
        latest_first=True,
    ),
}
# --- end of fixed values --------------------------------------------------------

def build(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Run one visual over its dataset. All rows of a top list, largest first; ``n`` keeps the first ones."""
    spec = VISUALS[key]
    for column, values in spec.only.items():
        df = interact.category(df, column, values)
    if spec.rows:
        detail = df.select(*spec.rows)
        return aggregate.sort_desc(detail, spec.rows[0], spec.rows[1:]) if spec.latest_first else detail
    column, agg, name = spec.measure
    result = aggregate.metric(df, [catalog.measure(spec.dataset, column, agg, name)], spec.by)
    if not spec.top:
        return result
    return aggregate.top_n(result, name, spec.by, n) if n else aggregate.sort_desc(result, name, spec.by)


def drill(df: DataFrame, key: str) -> DataFrame:
    """All levels of a visual's drill path."""
    spec = VISUALS[key]
    column, agg, name = spec.measure
    return interact.drill_down(df, spec.drill, column, agg, name)
