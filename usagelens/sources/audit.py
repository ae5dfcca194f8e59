"""Audit events: one nested JSON event per record, flattened to 25 columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.binding import bind
from usagelens.sources import envelopes

# --- fixed values: event selection, and payload field -> column ---------------
AUDIT_SOURCES = ["aws.quicksight"]
AUDIT_DETAIL_TYPES = ["AWS API Call via CloudTrail", "AWS Service Event via CloudTrail"]
DETAIL_FIELDS = {
    "timestamp": "eventTime",
    "event_id": "eventID",
    "event_name": "eventName",
    "event_source": "eventSource",
    "event_type": "eventType",
    "event_category": "eventCategory",
    "aws_region": "awsRegion",
    "source_ip": "sourceIPAddress",
    "user_agent": "userAgent",
    "recipient_account_id": "recipientAccountId",
    "shared_event_id": "sharedEventID",
    "error_code": "errorCode",
    "error_message": "errorMessage",
}
IDENTITY_FIELDS = {
    "user_type": "type",
    "principal_id": "principalId",
    "user_name": "userName",
    "user_arn": "arn",
    "account_id": "accountId",
}
FRAGMENT_FIELDS = {
    "request_parameters": "requestParameters",
    "response_elements": "responseElements",
    "service_event_details": "serviceEventDetails",
}
# --- end of fixed values ------------------------------------------------------


def _struct(names) -> str:
    return ", ".join(f"{n}: string" for n in names)


_DETAIL = (
    f"struct<{_struct(DETAIL_FIELDS.values())}, {_struct(FRAGMENT_FIELDS.values())},"
    f" readOnly: boolean, resources: string, userIdentity: struct<{_struct(IDENTITY_FIELDS.values())}>>"
)
_EVENT = f"array<struct<source: string, `detail-type`: string, detail: {_DETAIL}>>"


def read_audit_records(df: DataFrame, col: str = "data") -> DataFrame:
    """Decode delivered audit records: adds ``payload`` and ``event``."""
    decoded = envelopes.decode_plain(df, col)
    return bind(decoded, event=envelopes.one_object(F.col("payload"), _EVENT))


def _is_watched() -> Column:
    event = F.col("event")
    return event["source"].isin(AUDIT_SOURCES) & event["detail-type"].isin(AUDIT_DETAIL_TYPES)


def filter_audit_feed(df: DataFrame) -> DataFrame:
    """Events of the watched source and detail types."""
    return df.filter(_is_watched())


def resource_type(resources: Column) -> Column:
    """Type of the first resource, after the last ``::``; '' without one."""
    kind = F.get_json_object(F.nullif(resources, F.lit("[]")), "$[0].type")
    return F.coalesce(F.substring_index(kind, "::", -1), F.lit(""))


def resource_arn(resources: Column) -> Column:
    return F.coalesce(F.get_json_object(F.nullif(resources, F.lit("[]")), "$[0].ARN"), F.lit(""))


def event_day(text: Column, fallback: Column) -> Column:
    """Date the text itself shows, or ``fallback`` when it shows no valid time."""
    shown = F.when(text.try_cast("timestamp").isNotNull(), F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd"))
    return F.coalesce(shown, fallback)


def partition_keys(day: Column) -> list[Column]:
    return [F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day")]


def _lost(text: Column, key: str, value: Column) -> Column:
    """True where ``key`` is in the object ``text`` but its value is not usable."""
    there = F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
    return F.when(value.isNull(), there).otherwise(False)


def _is_valid() -> Column:
    """False where a container that must be an object is there but is not one.

    The key look-ups run only for events that lack the container.
    """
    event, payload = F.col("event"), F.col("payload")
    detail = event["detail"]
    no_detail = _lost(payload, "detail", detail)
    no_identity = _lost(F.get_json_object(payload, "$.detail"), "userIdentity", detail["userIdentity"])
    return event.isNotNull() & ~no_detail & ~no_identity


def route_audit_records(df: DataFrame) -> DataFrame:
    """Add ``result``: Ok, or ProcessingFailed with ``data`` untouched."""
    return read_audit_records(df).select(
        *df.columns, F.when(_is_valid(), envelopes.OK).otherwise(envelopes.FAILED).alias("result")
    )


def fate() -> Column:
    """What becomes of a decoded record in the feed: failed, dropped by the selection, or landed."""
    return F.when(~_is_valid(), envelopes.FAILED).when(F.coalesce(_is_watched(), F.lit(False)), envelopes.OK).otherwise(envelopes.DROPPED)


def kept_parts(read: DataFrame) -> DataFrame:
    """Decoded records with their ``fate``, and of each what is still to be written.

    That is the event where it is landed, with the payload where :func:`flatten_audit`
    looks into it for nulls, and the record as it came where it failed.
    """
    landed = F.col("fate") == envelopes.OK
    return read.withColumn("fate", fate()).withColumns(
        {
            "data": F.when(F.col("fate") == envelopes.FAILED, F.col("data")),
            "payload": F.when(landed & _may_hold_null(), F.col("payload")),
            "event": F.when(landed, F.col("event")),
        }
    )


def _may_hold_null() -> Column:
    """Only an event that has the word can have given a field as null."""
    return F.contains("payload", F.lit("null"))


def invalid(read: DataFrame) -> DataFrame:
    """Records that are no audit event."""
    return read.filter(~_is_valid())


def flatten_audit(df: DataFrame, ingest_date: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Decoded audit events to the table's 25 columns and the partition keys.

    Missing text is '', a missing flag false, a missing object ``{}``; text or a flag
    given as null is NULL, an object given as null the text ``null``. ``ingest_date``
    stands in for the day of an event whose time cannot be read, so that a re-run gives
    the same rows.
    """
    detail = F.col("event")["detail"]
    # Which fields are given as null, their keys tell.
    detail_text = F.when(_may_hold_null(), F.get_json_object("payload", "$.detail"))
    keys = F.json_object_keys(detail_text)
    identity_keys = F.json_object_keys(F.get_json_object(detail_text, "$.userIdentity"))

    def given(value: Column, key: str, absent: Column, null: Column, among: str = "_keys") -> Column:
        return F.coalesce(value, F.when(F.array_contains(among, key), null).otherwise(absent))

    def text(value: Column, key: str, among: str = "_keys") -> Column:
        return given(value, key, F.lit(""), F.lit(None), among)

    resources = F.coalesce(detail["resources"], F.lit("[]"))
    made = {name: text(detail[key], key) for name, key in DETAIL_FIELDS.items()}
    made |= {name: text(detail["userIdentity"][key], key, "_identity_keys") for name, key in IDENTITY_FIELDS.items()}
    made |= {name: given(detail[key], key, F.lit("{}"), F.lit("null")) for name, key in FRAGMENT_FIELDS.items()}
    made |= {
        "read_only": given(detail["readOnly"], "readOnly", F.lit(False), F.lit(None).cast("boolean")),
        "resources": resources,
        "resource_type": resource_type(resources),
        "resource_arn": resource_arn(resources),
    }
    names = schemas.feed("cloudtrail_events").data.fieldNames()
    day = event_day(F.col("timestamp"), F.col("_ingest_date"))
    return (
        bind(df.filter(_is_valid()), _keys=keys, _identity_keys=identity_keys)
        .select(*[made[n].alias(n) for n in names], ingest_date.alias("_ingest_date"), *carry)
        .select(*names, *partition_keys(day), *carry)
    )
