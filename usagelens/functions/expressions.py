"""Scalar column expressions shared by views, datasets and metrics.

Everything is a built-in expression, so each stays inside whole-stage codegen.
Dirty text never raises: ``try_*`` turns it into NULL, and the quality report
counts those rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
ABSENT = ("", "-")
SYSTEM_AGENT = "SYSTEM"
FEATURE_FLOW = "Flow"
FEATURE_SYSTEM = "System Chat Agent (My Assistant)"
FEATURE_CUSTOM = "Custom Chat Agent"
SOURCE_RESEARCH, SOURCE_CHAT = "Research", "Chat"
RESOURCE_LABELS = {"AUTOMATION": "Automation", "FLOW": "Flow", "RESEARCH": "Research"}
BYTES_PER_GB, BYTES_PER_MB = 1073741824.0, 1048576.0
# --- end of fixed values ------------------------------------------------------


def wall_time(text: Column) -> Column:
    """ISO text to a zone-less timestamp: the wall clock the text shows."""
    return text.try_cast("timestamp_ntz")


def instant(text: Column) -> Column:
    """ISO text to the UTC wall clock of the instant it names.

    Differs from :func:`wall_time` only for text with a non-UTC offset. The
    session zone must be UTC, as everywhere in this library.
    """
    return text.try_cast("timestamp").cast("timestamp_ntz")


def short_name(arn: Column) -> Column:
    """Text after the last slash; the whole text when there is none."""
    return F.substring_index(arn, "/", -1)


def is_present(identifier: Column) -> Column:
    """True for a usable id: NULL, empty and the dash all mean absent."""
    return F.coalesce(~identifier.isin(*ABSENT), F.lit(False))


def chat_feature(flow_id: Column, agent_id: Column) -> Column:
    return (
        F.when(is_present(flow_id), FEATURE_FLOW)
        .when(agent_id == SYSTEM_AGENT, FEATURE_SYSTEM)
        .when(is_present(agent_id), FEATURE_CUSTOM)
        .otherwise("")
    )


def feedback_source(research_id: Column) -> Column:
    return F.when(is_present(research_id), SOURCE_RESEARCH).otherwise(SOURCE_CHAT)


def resource_label(service: Column) -> Column:
    """Display label of a service; services without one keep their own name."""
    return F.coalesce(*[F.when(service == k, v) for k, v in RESOURCE_LABELS.items()], service)


def read_or_write(read_only: Column) -> Column:
    return F.when(read_only, "Read").otherwise("Write")


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def gigabytes(size: Column) -> Column:
    return F.round(size / F.lit(BYTES_PER_GB), 4)


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(BYTES_PER_MB), 2)


def calendar_day(event_time: Column) -> Column:
    return F.to_date(event_time)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, one place."""
    return F.round(F.lit(100.0) * part / whole, 1)


def json_scalars(text: Column, parent: str, keys: dict[str, str]) -> dict[str, Column]:
    """Scalar members of ``$.parent`` as text: output name -> column.

    One parse serves all members. An object or array member is not a scalar and
    gives NULL; only a value whose text starts like one pays for the second look
    that tells it from a string with the same first letter.
    """
    members = ", ".join(f"`{key}`: string" for key in keys.values())
    parsed = F.from_json(text, f"`{parent}` struct<{members}>")
    return {name: _scalar(text, parsed[parent][key], f"$.{parent}.{key}") for name, key in keys.items()}


def _scalar(text: Column, value: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant"))
    nested = F.when(F.left(value, F.lit(1)).isin("{", "["), kind != "STRING").otherwise(False)
    return F.when(~nested, value)
