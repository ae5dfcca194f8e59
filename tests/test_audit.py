"""Audit events: flattening, defaults, partition days."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.sources import audit, envelopes

INGEST = dt.date(2024, 5, 6)


def records(spark, *payloads):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    rows = [(str(i), base64.b64encode(t.encode()).decode()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "record_id string, data string")


def flat(spark, detail):
    df = records(spark, {"detail": detail})
    return audit.flatten_audit(audit.read_audit_records(df), F.lit(INGEST)).first()


def test_full_event(spark):
    row = flat(
        spark,
        {
            "eventTime": "2024-01-15T10:30:45Z",
            "eventID": "e1",
            "eventName": "CreateDashboard",
            "sourceIPAddress": "10.0.0.1",
            "userIdentity": {"type": "IAMUser", "principalId": "P", "userName": "n", "arn": "arn:x", "accountId": "7"},
            "readOnly": True,
            "requestParameters": {"b": 1, "a": [1, 2]},
            "responseElements": None,
            "resources": [{"type": "AWS::X::Dashboard", "ARN": "arn:r"}, {"type": "Y", "ARN": "z"}],
        },
    )
    assert (row.timestamp, row.event_id, row.event_name, row.source_ip) == (
        "2024-01-15T10:30:45Z",
        "e1",
        "CreateDashboard",
        "10.0.0.1",
    )
    assert (row.user_type, row.principal_id, row.user_name, row.user_arn, row.account_id) == (
        "IAMUser",
        "P",
        "n",
        "arn:x",
        "7",
    )
    assert row.read_only is True
    assert row.request_parameters == '{"b":1,"a":[1,2]}'
    assert (row.response_elements, row.service_event_details) == ("null", "{}")
    assert (row.resource_type, row.resource_arn) == ("Dashboard", "arn:r")
    assert (row.year, row.month, row.day) == (2024, 1, 15)


def test_columns_and_defaults(spark):
    row = flat(spark, {})
    schema = schemas.feed("cloudtrail_events").schema
    assert list(row.asDict()) == schema.fieldNames()
    given = row.asDict()
    texts = {n for n, v in given.items() if v == ""}
    assert given["read_only"] is False
    assert {n: given[n] for n in ("request_parameters", "response_elements", "service_event_details", "resources")} == {
        "request_parameters": "{}",
        "response_elements": "{}",
        "service_event_details": "{}",
        "resources": "[]",
    }
    assert len(texts) == 20
    assert (row.year, row.month, row.day) == (2024, 5, 6)


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-15T23:30:00-05:00", dt.date(2024, 1, 15)),
        ("2024-02-29T00:00:00Z", dt.date(2024, 2, 29)),
        ("2024-01-15", dt.date(2024, 1, 15)),
        ("soon", INGEST),
        ("", INGEST),
        ("2024-13-01T00:00:00Z", INGEST),
        (None, INGEST),
    ],
)
def test_partition_day_is_the_shown_date_or_the_ingest_date(spark, text, day):
    row = flat(spark, {"eventTime": text})
    assert dt.date(row.year, row.month, row.day) == day


@pytest.mark.parametrize(
    "resources, kind, arn",
    [
        ([], "", ""),
        (None, "", ""),
        ([{}], "", ""),
        ([{"type": "Plain"}], "Plain", ""),
        ([{"type": "A::B::C", "ARN": "x"}], "C", "x"),
        ([{"type": "A::", "ARN": "x"}], "", "x"),
        ([{"type": None, "ARN": "x"}, {"type": "T", "ARN": "y"}], "", "x"),
    ],
)
def test_first_resource(spark, resources, kind, arn):
    row = flat(spark, {"resources": resources})
    assert (row.resource_type, row.resource_arn) == (kind, arn)


def test_routing(spark):
    df = records(spark, {"detail": {}}, {}, {"detail": None}, {"detail": {"userIdentity": None}}, "junk", "[1]")
    got = {r.record_id: r.result for r in audit.route_audit_records(df).collect()}
    assert got == {
        "0": envelopes.OK,
        "1": envelopes.OK,
        "2": envelopes.FAILED,
        "3": envelopes.FAILED,
        "4": envelopes.FAILED,
        "5": envelopes.FAILED,
    }
    read = audit.read_audit_records(df)
    assert sorted(r.record_id for r in audit.invalid(read).collect()) == ["2", "3", "4", "5"]


def test_feed_filter(spark):
    def event(source, kind):
        return {"source": source, "detail-type": kind, "detail": {}}

    good = [event(audit.AUDIT_SOURCES[0], kind) for kind in audit.AUDIT_DETAIL_TYPES]
    bad = [event("other", audit.AUDIT_DETAIL_TYPES[0]), event(audit.AUDIT_SOURCES[0], "other"), {"detail": {}}]
    read = audit.read_audit_records(records(spark, *good, *bad))
    assert sorted(r.record_id for r in audit.filter_audit_feed(read).collect()) == ["0", "1"]


def test_a_field_given_as_null_is_null_a_missing_one_has_its_default(spark):
    row = flat(spark, {"eventTime": None, "eventID": "null", "errorCode": None, "readOnly": None, "userIdentity": {"type": None, "arn": "a"}, "resources": None})
    assert (row.timestamp, row.event_id, row.event_name, row.error_code, row.error_message) == (None, "null", "", None, "")
    assert (row.read_only, row.user_type, row.user_arn, row.user_name, row.resources) == (None, None, "a", "", "[]")
    assert (row.year, row.month, row.day) == (INGEST.year, INGEST.month, INGEST.day)
    row = flat(spark, {"userIdentity": {}, "errorMessage": "null"})
    assert (row.read_only, row.user_type, row.request_parameters, row.error_message) == (False, "", "{}", "null")


def test_fate_agrees_with_the_feed(spark):
    watched = {"source": audit.AUDIT_SOURCES[0], "detail-type": audit.AUDIT_DETAIL_TYPES[0]}
    read = audit.read_audit_records(records(spark, watched | {"detail": {}}, watched | {"detail": None}, {"detail": {}}, "junk"))
    assert [r.f for r in read.orderBy("record_id").select(audit.fate().alias("f")).collect()] == [envelopes.OK, envelopes.FAILED, envelopes.DROPPED, envelopes.FAILED]
