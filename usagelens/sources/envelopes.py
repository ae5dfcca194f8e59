"""Log envelopes: decode, explode, parse, conform and route.

A delivered record carries base64 text, gzipped or plain, of one envelope::

    {"messageType", "logGroup", "logStream", "logEvents": [{"timestamp", "message"}]}

Each log event becomes one flat row. A record ends as ``Ok``, ``Dropped`` or
``ProcessingFailed``; an event that cannot be used keeps its text and a reason
instead of vanishing. The only Python in the path is the gunzip helper.
"""

from __future__ import annotations

import gzip
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.functions.binding import bind, let

# --- fixed values -------------------------------------------------------------
OK, DROPPED, FAILED = "Ok", "Dropped", "ProcessingFailed"
CONTROL = "CONTROL_MESSAGE"
UNKNOWN = "UNKNOWN"
MILLIS_ABOVE = 9999999999
# --- end of fixed values ------------------------------------------------------

# Seconds a timestamp can hold: years 1 to 9999.
_MIN_SECOND, _MAX_SECOND = -62135596800, 253402300799

_ENVELOPE = (
    "array<struct<messageType: string, logGroup: string, logStream: string,"
    " logEvents: array<struct<timestamp: variant, message: string>>>>"
)


def _gunzip(data: Column) -> Column:
    """Inflate gzipped bytes, an Arrow batch at a time; NULL where they are broken."""

    # Nested, so that it travels to the workers whole: they need not have this package.
    def inflate(blobs: pd.Series) -> pd.Series:
        def one(blob):
            try:
                return None if blob is None else gzip.decompress(blob)
            except (OSError, EOFError, zlib.error):
                return None

        return blobs.map(one)

    return F.pandas_udf(inflate, T.BinaryType())(data)


def one_object(text: Column, schema: str) -> Column:
    """The struct in ``text`` when it holds exactly one JSON object, else NULL."""
    return objects(text, schema)[0]


def objects(text: Column, schema: str) -> Column:
    """As :func:`one_object`, in an array, which ``inline`` turns into a row or none.

    Reading the text as a one-element array makes trailing garbage an error,
    which a plain struct read would overlook.
    """
    kept = F.when(F.ltrim(text).startswith("{") & F.rtrim(text).endswith("}"), text)
    values = F.from_json(F.concat(F.lit("["), kept, F.lit("]")), schema)
    return let(values, lambda v: F.when(F.size(v) == 1, v))


def _is_other_json(text: Column) -> Column:
    """True for exactly one JSON value that is not an object."""
    values = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    one = F.coalesce(let(values, lambda v: F.size(v) == 1), F.lit(False))
    return F.when(F.ltrim(text).startswith("{"), False).otherwise(one)


def _base64(col: str) -> Column:
    """Bytes of base64 text; characters foreign to it are ignored, as lenient decoders do."""
    return F.expr(
        f"coalesce(try_to_binary(`{col}`, 'base64'),"
        f" try_to_binary(regexp_replace(`{col}`, '[^A-Za-z0-9+/=]', ''), 'base64'))"
    )


def decode_plain(df: DataFrame, col: str = "data") -> DataFrame:
    """Add ``payload`` of records that are never gzipped: no Python at all."""
    return df.withColumn("payload", F.try_validate_utf8(_base64(col).cast("string")))


def decode_envelopes(df: DataFrame, col: str = "data") -> DataFrame:
    """Add ``payload``: the record's JSON text, NULL when it cannot be decoded.

    Only gzipped bytes cross to Python; plain ones are decoded in the JVM.
    """
    zipped = F.substring("_bytes", 1, 2) == F.unhex(F.lit("1F8B"))
    text = F.coalesce(F.col("_inflated"), F.when(~zipped, F.col("_bytes"))).cast("string")
    return (
        df.withColumn("_bytes", _base64(col))
        .withColumn("_inflated", _gunzip(F.when(zipped, F.col("_bytes"))))
        .withColumn("payload", F.try_validate_utf8(text))
        .drop("_bytes", "_inflated")
    )


def read_envelopes(df: DataFrame) -> DataFrame:
    """Add ``envelope`` (NULL when the payload is no JSON object) and ``kind``.

    ``kind`` is ``events``, ``control``, ``passthrough`` (JSON without log
    events, delivered as it is) or ``unreadable``. Payloads are parsed once; only
    those without a list of events get a second look.
    """
    env = F.col("envelope")
    first = F.left(F.ltrim("payload"), F.lit(1))
    has_key = F.array_contains(F.json_object_keys("payload"), "logEvents")
    kind = (
        F.when(env["logEvents"].isNotNull(), F.when(env["messageType"] == CONTROL, "control").otherwise("events"))
        .when(env.isNotNull() & ~has_key, "passthrough")
        .when(env.isNotNull() & (env["messageType"] == CONTROL), "control")
        .when(env.isNull() & first.isin("[", '"') & _is_other_json(F.col("payload")), "passthrough")
        .otherwise("unreadable")
    )
    parsed = bind(df, envelope=one_object(F.col("payload"), _ENVELOPE))
    return parsed.withColumn("kind", kind)


def drop_control(df: DataFrame) -> DataFrame:
    """Health checks carry no data; an envelope without a type is kept."""
    return df.filter(~F.col("envelope.messageType").eqNullSafe(CONTROL))


def explode_events(df: DataFrame) -> DataFrame:
    """One row per log event: ``message``, ``envelope_time``, group and stream."""
    carried = [c for c in df.columns if c not in ("data", "payload", "envelope", "kind")]
    return df.select(
        *carried,
        F.coalesce("envelope.logGroup", F.lit("")).alias("log_group"),
        F.coalesce("envelope.logStream", F.lit("")).alias("log_stream"),
        F.explode("envelope.logEvents").alias("_event"),
    ).select(
        *carried,
        "log_group",
        "log_stream",
        F.col("_event.timestamp").alias("envelope_time"),
        F.coalesce("_event.message", F.lit("")).alias("message"),
    )


def _message_schema(fields: list[str]) -> str:
    typed = ["logType: variant", "log_type: variant", "event_timestamp: bigint"]
    typed += ["accountId: string", "account_id: string"]
    typed += [f"`{f}`: string" for f in fields if f not in ("account_id", "event_timestamp")]
    return f"array<struct<{', '.join(typed)}>>"


def _payload_fields(table: str, include_content: bool) -> list[str]:
    names = schemas.feed(table, include_content).data.fieldNames()
    return [n for n in names if n not in schemas.ENVELOPE_COLUMNS]


def parse_message(df: DataFrame, table: str = "chat_logs", include_content: bool = True) -> DataFrame:
    """Add ``fields`` (typed by the table's columns) and ``raw_message``.

    Text that is not JSON is kept whole as ``raw_message``. JSON that is not an
    object has neither; :func:`conform_keys` gives it a reason.
    """
    message = F.col("message")
    schema = _message_schema(_payload_fields(table, include_content))
    plain = F.col("fields").isNull() & ~_is_other_json(message)
    return bind(
        bind(df, fields=one_object(message, schema)),
        raw_message=F.when(plain, message),
    )


def _whole(value: Column) -> Column:
    """A JSON number (or boolean) rounded down; NULL for any other value."""
    numeric = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    return F.when(numeric, F.floor(F.try_variant_get(value, "$", "decimal(38,6)")).cast("bigint"))


def _not_given(value: Column) -> Column:
    """Missing, null, zero, false, '' and empty containers all mean "not given"."""
    return value.isNull() | F.to_json(value).isin("null", "0", "0.0", "false", '""', "[]", "{}")


def given_time(event_time: Column, message: Column) -> Column:
    """The time a message gives in any other way than as a plain whole number, which ``event_time`` holds.

    Only a message that names it, as it is or with escapes, is looked at again for it.
    """
    named = F.contains(message, F.lit("event_timestamp")) | F.contains(message, F.lit("\\u"))
    looked_up = F.try_variant_get(F.try_parse_json(message), "$.event_timestamp", "variant")
    return F.when(F.coalesce(event_time == 0, F.lit(True)) & named, looked_up)


def event_seconds(event_time: Column, given: Column, envelope_time: Column) -> Column:
    """Epoch seconds of an event; NULL when neither source gives a usable number.

    The message's own time wins, in milliseconds above ten digits and in seconds
    otherwise. Only when it is absent does the envelope's (milliseconds) count.
    ``event_time`` holds a plain whole number, ``given`` what :func:`given_time` has found.
    """

    def scaled(n: Column) -> Column:
        return F.when(n > MILLIS_ABOVE, F.floor(n / 1000)).otherwise(n).cast("bigint")

    def odd(value: Column) -> Column:
        arrival = F.floor(F.when(envelope_time.isNull(), F.lit(0)).otherwise(_whole(envelope_time)) / 1000)
        return F.when(_not_given(value), arrival).otherwise(let(_whole(value), scaled))

    seconds = F.when(event_time != 0, scaled(event_time)).otherwise(odd(given))
    return let(seconds, lambda s: F.when(s.between(_MIN_SECOND, _MAX_SECOND), s))


def second_text(seconds: Column) -> Column:
    """Epoch seconds as ISO text in UTC without a zone, whatever the session's."""
    at = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.replace(at.cast("string"), F.lit(" "), F.lit("T"))


def fitted(text: Column, kind: T.DataType) -> Column:
    """Text as a column's type, NULL where it does not fit; a whole number may end in ``.0``."""
    if kind != T.LongType():
        return text.try_cast(kind)
    exact = text.try_cast("decimal(38,18)")
    return F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def extra_fields(message: Column, table: str, include_content: bool = True) -> Column:
    """The fields of an object that the table has no column for, as JSON; NULL if there are none.

    Fields named like envelope columns are left out, and so is message content,
    which has columns of its own where it was opted in. Only messages with such fields are parsed for them;
    where their values cannot be kept as they are, their text is.
    """
    known = {*_payload_fields(table, include_content), *schemas.ENVELOPE_COLUMNS}
    known |= {"logType", "log_type", "accountId", "account_id", *schemas.SENSITIVE}
    unknown = F.array_except(F.json_object_keys(message), F.array(*[F.lit(n) for n in sorted(known)]))

    def rest(names: Column, kind: str) -> Column:
        return F.to_json(F.map_filter(F.from_json(message, f"map<string,{kind}>"), lambda k, _: F.array_contains(names, k)))

    return let(unknown, lambda n: F.when(F.size(n) > 0, F.coalesce(rest(n, "variant"), rest(n, "string"))))


def conform_keys(df: DataFrame, table: str = "chat_logs", include_content: bool = True) -> DataFrame:
    """Parsed events to the table's columns and types, plus ``raw_message``, ``extra_fields`` and ``reason``.

    Envelope columns never come from the message. Both spellings of the type and
    the account are read; an explicit null type stays null. ``reason`` is NULL
    for a usable event; a value that does not fit its column is a reason, too.
    """
    f = F.col("fields")
    used = ("log_group", "log_stream", "envelope_time", "message", "fields", "raw_message")
    carried = [c for c in df.columns if c not in used]
    type_value = F.coalesce(f["logType"], f["log_type"])
    message_type = F.when(type_value.isNull(), UNKNOWN).otherwise(F.try_variant_get(type_value, "$", "string"))
    special = {
        "account_id": F.coalesce(f["accountId"], f["account_id"]),
        "event_timestamp": F.coalesce(f["event_timestamp"], F.try_variant_get("_given", "$", "bigint")),
    }
    kinds = {c.name: c.dataType for c in schemas.feed(table, include_content).data}
    names = _payload_fields(table, include_content)
    columns = [special[n].alias(n) if n in special else fitted(f[n], kinds[n]).alias(n) for n in names]
    measures = [n for n in names if n not in special and kinds[n] != T.StringType()]
    misfits = [f[n].isNotNull() & fitted(f[n], kinds[n]).isNull() for n in measures]
    reason = (
        F.when(f.isNull() & F.col("raw_message").isNull(), "not_an_object")
        .when(F.col("_seconds").isNull(), "bad_event_time")
        .when(reduce(Column.__or__, misfits, F.lit(False)), "bad_value")
    )
    looked_up = bind(df, _given=given_time(f["event_timestamp"], F.col("message")))
    timed = bind(looked_up, _seconds=event_seconds(f["event_timestamp"], F.col("_given"), F.col("envelope_time")))
    return timed.select(
        *carried,
        second_text(F.col("_seconds")).alias("timestamp"),
        "log_group",
        "log_stream",
        message_type.alias("message_type"),
        *columns,
        "raw_message",
        F.when(f.isNotNull(), extra_fields(F.col("message"), table, include_content)).alias("extra_fields"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("message")).alias("rejected_message"),
    )


def strip_sensitive(df: DataFrame, include: bool = False) -> DataFrame:
    """Drop message content unless it was opted in."""
    return df if include else df.drop(*schemas.SENSITIVE)


def transform_log_records(df: DataFrame, table: str, include_content: bool = False) -> DataFrame:
    """Delivered records to event rows: usable ones and rejected ones (``reason``).

    Works alike on a batch and a streaming DataFrame; no shuffle.
    """
    return transform_envelopes(read_envelopes(decode_envelopes(df)), table, include_content)


def transform_envelopes(read: DataFrame, table: str, include_content: bool = False) -> DataFrame:
    """As :func:`transform_log_records`, of records whose envelopes are read already."""
    events = parse_message(explode_events(read.filter("kind = 'events'")), table, include_content)
    return strip_sensitive(conform_keys(events, table, include_content), include_content)


def usable(events: DataFrame) -> DataFrame:
    return events.filter("reason IS NULL").drop("reason", "rejected_message")


def rejected(events: DataFrame) -> DataFrame:
    return events.filter("reason IS NOT NULL")


_TIME_ONLY = "array<struct<event_timestamp: bigint>>"


def _event_survives(event: Column) -> Column:
    message = F.coalesce(event["message"], F.lit(""))

    def outcome(parsed: Column) -> Column:
        readable = parsed.isNotNull() | ~_is_other_json(message)
        own = parsed["event_timestamp"]
        return readable & let(given_time(own, message), lambda given: event_seconds(own, given, event["timestamp"])).isNotNull()

    return let(one_object(message, _TIME_ONLY), outcome)


def with_result(read: DataFrame) -> DataFrame:
    """Add ``result``, the fate of each record, to records whose envelopes are read.

    A record is ``Ok`` when at least one of its events survives or when it holds
    no log events at all. Whether values fit a table is not looked at here. Events
    are looked at up to the first that survives.
    """
    survives = F.exists("envelope.logEvents", _event_survives)
    result = (
        F.when(F.col("kind") == "unreadable", FAILED)
        .when(F.col("kind") == "passthrough", OK)
        .when((F.col("kind") == "events") & survives, OK)
        .otherwise(DROPPED)
    )
    return read.withColumn("result", result)


def kept_parts(read: DataFrame) -> DataFrame:
    """Of each record what is still to be written: its text where that is kept as it came, its events where they are landed."""
    kind = F.col("kind")
    return read.withColumns(
        {
            "data": F.when(kind == "unreadable", F.col("data")),
            "payload": F.when(kind == "passthrough", F.col("payload")),
            "envelope": F.when(kind == "events", F.col("envelope")),
        }
    )


def route_records(df: DataFrame) -> DataFrame:
    """Add ``kind`` and ``result``: the fate of each delivered record, its ``data`` untouched."""
    return with_result(read_envelopes(decode_envelopes(df))).select(*df.columns, "kind", "result")


def passthrough(df: DataFrame) -> DataFrame:
    """Payloads without log events, as they came."""
    return read_envelopes(decode_envelopes(df)).filter("kind = 'passthrough'").drop("envelope", "kind")


def unreadable(df: DataFrame) -> DataFrame:
    """Records that end as ProcessingFailed; no message is parsed to tell."""
    return read_envelopes(decode_envelopes(df)).filter("kind = 'unreadable'").select(*df.columns)


def select_record_fields(df: DataFrame, log_type: str, include_content: bool = False) -> DataFrame:
    """The fields a log type delivers, in delivery order."""
    names = list(schemas.RECORD_FIELDS[log_type])
    if include_content and log_type == "CHAT_LOGS":
        names += schemas.SENSITIVE
    return df.select(*names)
