"""Log envelopes: decoding, time rules, keys, routing."""

import base64
import gzip
import json

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.sources import envelopes as V

ENVELOPE_MS = 1700000000999


def pack(payload, zipped=False):
    raw = payload if isinstance(payload, bytes) else payload.encode()
    return base64.b64encode(gzip.compress(raw) if zipped else raw).decode()


def envelope(*messages, **extra):
    events = [{"timestamp": ENVELOPE_MS, "message": m if isinstance(m, str) else json.dumps(m)} for m in messages]
    return json.dumps({"messageType": "DATA_MESSAGE", "logGroup": "/g", "logStream": "s", "logEvents": events} | extra)


def records(spark, *datas):
    return spark.createDataFrame([(str(i), d) for i, d in enumerate(datas)], "record_id string, data string")


def transformed(spark, *messages, table="chat_logs", include=False):
    rows = V.transform_log_records(records(spark, pack(envelope(*messages))), table, include).collect()
    return rows[0] if len(messages) == 1 else rows


def fates(spark, *datas):
    rows = V.route_records(records(spark, *datas)).collect()
    return [r.result for r in sorted(rows, key=lambda r: int(r.record_id))]


def test_gzip_and_plain_payloads_decode_alike(spark):
    text = envelope({"user_arn": "ü"})
    rows = V.decode_envelopes(records(spark, pack(text), pack(text, True))).collect()
    assert [r.payload for r in rows] == [text, text]


def test_base64_with_line_breaks_decodes(spark):
    text = envelope({"a": 1})
    data = pack(text)
    broken = data[:10] + "\n" + data[10:20] + "\r\n" + data[20:]
    assert V.decode_envelopes(records(spark, broken)).first().payload == text


@pytest.mark.parametrize("data", [None, "x", pack(b"\x1f\x8bjunk"), pack(b"\xff\xfe{}")])
def test_undecodable_payload_is_null(spark, data):
    assert V.decode_envelopes(records(spark, data)).first().payload is None


def test_fate_of_each_kind_of_record(spark):
    ok, text, lost = {"event_timestamp": 1700000000}, "no json", "[1]"
    got = fates(
        spark,
        pack(envelope(ok)),
        pack(envelope(ok), True),
        pack(envelope(ok, messageType="CONTROL_MESSAGE")),
        pack(envelope()),
        pack('{"other": 1}'),
        pack("[1, 2]"),
        pack('"text"'),
        pack("5"),
        pack("null"),
        pack("{broken"),
        pack(envelope(ok) + " trailing"),
        pack("[1] x"),
        pack(envelope(text)),
        pack(envelope(lost)),
        pack(envelope(lost, ok)),
        pack(envelope(logEvents=None)),
        None,
    )
    ok_, drop, fail = V.OK, V.DROPPED, V.FAILED
    assert got == [ok_, ok_, drop, drop, ok_, ok_, ok_, fail, fail, fail, fail, fail, ok_, drop, ok_, fail, fail]


def test_routing_keeps_the_original_data(spark):
    data = pack("{broken")
    assert V.route_records(records(spark, data)).first().data == data
    assert V.unreadable(records(spark, data)).first().data == data


def test_control_messages_are_dropped_and_untyped_ones_kept(spark):
    untyped = json.dumps({"logEvents": [{"timestamp": 1, "message": "m"}]})
    read = V.read_envelopes(
        V.decode_envelopes(records(spark, pack(envelope("m", messageType="CONTROL_MESSAGE")), pack(untyped)))
    )
    assert [r.record_id for r in V.drop_control(read).collect()] == ["1"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ({"event_timestamp": 1700000000123}, "2023-11-14T22:13:20"),
        ({"event_timestamp": 1700000000}, "2023-11-14T22:13:20"),
        ({"event_timestamp": 9999999999}, "2286-11-20T17:46:39"),
        ({"event_timestamp": 10000000000}, "1970-04-26T17:46:40"),
        ({"event_timestamp": 1700000000.75}, "2023-11-14T22:13:20"),
        ({"event_timestamp": 0}, "2023-11-14T22:13:20"),
        ({"event_timestamp": None}, "2023-11-14T22:13:20"),
        ({"event_timestamp": ""}, "2023-11-14T22:13:20"),
        ({"event_timestamp": []}, "2023-11-14T22:13:20"),
        ({"event_timestamp": True}, "1970-01-01T00:00:01"),
        ({"event_timestamp": -1}, "1969-12-31T23:59:59"),
        ({}, "2023-11-14T22:13:20"),
    ],
)
def test_event_time(spark, given, expected):
    row = transformed(spark, given)
    assert (row.timestamp, row.reason) == (expected, None)


@pytest.mark.parametrize("bad", ["1700000000", [1], {"a": 1}, 10**18])
def test_unusable_event_time_is_rejected_with_its_text(spark, bad):
    row = transformed(spark, {"event_timestamp": bad, "user_arn": "u"})
    assert row.reason == "bad_event_time"
    assert json.loads(row.rejected_message)["user_arn"] == "u"


def test_envelope_time_must_be_a_number_only_when_needed(spark):
    text = '{"logEvents": [{"timestamp": "x", "message": "{}"}, {"timestamp": "x", "message": "{\\"event_timestamp\\": 1}"}, {"message": "{}"}]}'
    rows = V.transform_log_records(records(spark, pack(text)), "chat_logs").collect()
    assert [(r.timestamp, r.reason) for r in rows] == [
        (None, "bad_event_time"),
        ("1970-01-01T00:00:01", None),
        ("1970-01-01T00:00:00", None),
    ]


@pytest.mark.parametrize(
    "message, expected",
    [
        ({"logType": "A", "log_type": "B"}, "A"),
        ({"log_type": "B"}, "B"),
        ({}, "UNKNOWN"),
        ({"logType": None, "log_type": "B"}, None),
        ({"log_type": None}, None),
    ],
)
def test_message_type(spark, message, expected):
    assert transformed(spark, message).message_type == expected


def test_messages_never_override_envelope_columns(spark):
    row = transformed(spark, {"timestamp": "spoof", "log_group": "x", "log_stream": "y", "message_type": "z"})
    assert (row.timestamp, row.log_group, row.log_stream, row.message_type) == (
        "2023-11-14T22:13:20",
        "/g",
        "s",
        "UNKNOWN",
    )


@pytest.mark.parametrize("key", ["accountId", "account_id"])
def test_both_account_spellings(spark, key):
    assert transformed(spark, {key: "42"}).account_id == "42"


def test_nested_values_become_compact_json_in_their_own_key_order(spark):
    row = transformed(spark, {"cited_resource": {"z": 1, "a": [1, {"k": "v w"}]}, "latency": 12, "web_search": True})
    assert row.cited_resource == '{"z":1,"a":[1,{"k":"v w"}]}'
    assert (row.latency, row.web_search) == ("12", "true")


@pytest.mark.parametrize("text", ["plain", "", "  ", '{"open": ', '{"a": 1} trailing', "{", "[1] x", "5 6", "1, 2"])
def test_text_that_is_not_json_is_kept_whole(spark, text):
    row = transformed(spark, text)
    assert (row.raw_message, row.reason, row.message_type) == (text, None, "UNKNOWN")


@pytest.mark.parametrize("text", ["[1]", "5", '"s"', "null", "true"])
def test_json_that_is_no_object_is_rejected(spark, text):
    row = transformed(spark, text)
    assert (row.reason, row.rejected_message, row.raw_message) == ("not_an_object", text, None)


def test_content_is_stripped_unless_opted_in(spark):
    message = {"user_message": "hi", "system_text_message": "ho"}
    assert not set(schemas.SENSITIVE) & set(transformed(spark, message).asDict())
    kept = transformed(spark, message, include=True)
    assert (kept.user_message, kept.system_text_message) == ("hi", "ho")


@pytest.mark.parametrize("table", [t for t in schemas.TABLES if t != "cloudtrail_events"])
def test_every_log_feed_conforms_to_its_table(spark, table):
    row = transformed(spark, {"event_timestamp": 1}, table=table)
    assert set(schemas.feed(table).data.fieldNames()) <= set(row.asDict())


def test_passthrough_returns_the_payload_unchanged(spark):
    text = '{"b": 1,  "a": [2]}'
    assert V.passthrough(records(spark, pack(text, True))).first().payload == text


def test_delivered_fields_per_log_type(spark):
    names = {n for fields in schemas.RECORD_FIELDS.values() for n in fields} | set(schemas.SENSITIVE)
    row = spark.range(1).select(*[F.lit("x").alias(n) for n in names])
    for log_type, fields in schemas.RECORD_FIELDS.items():
        assert V.select_record_fields(row, log_type).columns == fields
    chat = V.select_record_fields(row, "CHAT_LOGS", include_content=True)
    assert chat.columns[-2:] == list(schemas.SENSITIVE)


def test_ingest_has_no_shuffle_and_one_python_step(spark):
    plan = V.transform_log_records(records(spark, "x"), "chat_logs")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1


def test_a_second_zone_does_not_move_times(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert transformed(spark, {"event_timestamp": 1700000000}).timestamp == "2023-11-14T22:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_measures_take_their_columns_types(spark):
    row = transformed(spark, {"usage_hours": "1.5"}, table="agent_hours_logs")
    assert (row.usage_hours, row.reason) == (1.5, None)
    row = transformed(spark, {"consumed_index_size": 12.0, "consumed_source_size": None}, table="index_usage_logs")
    assert (row.consumed_index_size, row.consumed_source_size, row.reason) == (12, None, None)


@pytest.mark.parametrize("bad", ["many", "", 1.5, [1], 2**63])
def test_a_value_that_does_not_fit_is_rejected_with_its_text(spark, bad):
    row = transformed(spark, {"consumed_index_size": bad, "source_name": "s"}, table="index_usage_logs")
    assert (row.reason, json.loads(row.rejected_message)["source_name"]) == ("bad_value", "s")


@pytest.mark.parametrize(
    "message, extra",
    [
        ({"user_arn": "u", "accountId": "1", "log_type": "t", "timestamp": "spoof"}, None),
        ({"new": 5, "user_arn": "u", "user_message": "secret"}, {"new": 5}),
        ({"a": {"z": [1, None]}, "b": None, "c": "x"}, {"a": {"z": [1, None]}, "b": None, "c": "x"}),
    ],
)
def test_fields_without_a_column_are_kept(spark, message, extra):
    kept = transformed(spark, message).extra_fields
    assert (kept and json.loads(kept)) == extra


def test_text_and_other_json_have_no_extra_fields(spark):
    assert [r.extra_fields for r in transformed(spark, "plain", "[1]", '{"x": 1} y')] == [None] * 3
