"""The five tables and the raw feeds, derived from the given parquet tables.

Each derivation is one expression list or SQL text that Spark and DuckDB read
alike; only a few functions differ, held in ``SPARK`` and ``DUCKDB``.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.plans import views
from usagelens.sources import audit, lake

_NAMES = {"query_source": views.QUERY_SOURCE, "audit_source": audit.AUDIT_SOURCES[0]}
SPARK = _NAMES | {
    "iso": """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")""",
    "epoch": "unix_seconds(cast(ts as timestamp))",
}
DUCKDB = _NAMES | {
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "epoch": "cast(floor(epoch(ts)) as bigint)",
}

_DAY = "cast(year(ts) as int) AS year, cast(month(ts) as int) AS month, cast(day(ts) as int) AS day"
_ARN = (
    "CASE WHEN user_id % 10 = 0 THEN 'svc-' || user_id"
    " ELSE 'arn:aws:assistant:us-east-1:111122223333:user/default/u' || user_id END"
)
_CONVERSATION = "'conv-' || user_id || '-' || (event_id % 20)"

# event_id spreads values over columns; each table holds every event or document.
TABLES = {
    "chat_logs": f"""
SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE {{iso}} END AS timestamp,
  'assistant/chat' AS log_group, 'stream-' || (event_id % 3) AS log_stream, 'CHAT_LOGS' AS message_type,
  {_ARN} AS user_arn, CASE WHEN user_id % 10 = 0 THEN 'SERVICE' ELSE 'USER' END AS user_type,
  CASE event_id % 4 WHEN 0 THEN 'SYSTEM' WHEN 1 THEN 'agent-' || (event_id % 7) WHEN 2 THEN '-' END AS agent_id,
  CASE event_id % 5 WHEN 0 THEN 'flow-' || (event_id % 3) WHEN 1 THEN '-' WHEN 2 THEN '' END AS flow_id,
  {_CONVERSATION} AS conversation_id,
  'sm-' || event_id AS system_message_id, 'um-' || event_id AS user_message_id,
  CASE WHEN event_id % 6 = 0 THEN '[]' END AS user_selected_resources,
  CASE WHEN event_id % 11 = 0 THEN 'request_blocked' WHEN event_id % 7 = 0 THEN 'no_answer_found' ELSE 'success' END AS status_code,
  CASE event_id % 3 WHEN 0 THEN 'no_resources' WHEN 1 THEN 'all_resources' ELSE 'specific_resource' END AS message_scope,
  CASE WHEN event_id % 9 = 0 THEN 'connector-' || (event_id % 4) ELSE '-' END AS action_connectors,
  CAST(NULL AS VARCHAR(20)) AS cited_resource, CAST(NULL AS VARCHAR(20)) AS file_attachment,
  'arn:aws:assistant:us-east-1:111122223333:account' AS resource_arn, '111122223333' AS account_id,
  {{epoch}} * 1000 AS event_timestamp, 'default' AS namespace,
  CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR(20)) END AS latency,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR(20)) END AS time_to_first_token,
  CASE event_id % 3 WHEN 0 THEN 'console' WHEN 1 THEN 'ide' ELSE 'mobile' END AS surface_type,
  CASE WHEN event_id % 4 = 0 THEN 'true' ELSE 'false' END AS web_search, {_DAY}
FROM {{events}}""",
    "feedback_logs": f"""
SELECT {{iso}} AS timestamp, 'assistant/feedback' AS log_group, 'stream-0' AS log_stream, 'FEEDBACK_LOGS' AS message_type,
  {_ARN} AS user_arn, CASE WHEN user_id % 10 = 0 THEN 'SERVICE' ELSE 'USER' END AS user_type,
  {_CONVERSATION} AS conversation_id, 'sm-' || event_id AS system_message_id, 'um-' || event_id AS user_message_id,
  CASE event_id % 3 WHEN 0 THEN 'res-' || (event_id % 9) WHEN 1 THEN '-' ELSE '' END AS research_id,
  CASE WHEN value < 25 THEN 'Not Useful' ELSE 'Useful' END AS feedback_type,
  CASE event_id % 4 WHEN 0 THEN 'Inaccurate' WHEN 1 THEN 'Incomplete' WHEN 2 THEN 'Too slow' END AS feedback_reason,
  CASE WHEN event_id % 8 = 0 THEN 'note ' || event_id END AS feedback_details,
  regexp_extract(props, '([0-9]+)', 1) AS rating, 'success' AS status_code,
  'arn:aws:assistant:us-east-1:111122223333:account' AS resource_arn, '111122223333' AS account_id,
  {{epoch}} * 1000 AS event_timestamp, 'default' AS namespace, {_DAY}
FROM {{events}}""",
    "agent_hours_logs": f"""
SELECT {{iso}} AS timestamp, 'assistant/agent-hours' AS log_group, 'stream-0' AS log_stream, 'AGENT_HOURS_LOGS' AS message_type,
  {_ARN} AS user_arn, CASE WHEN user_id % 4 = 0 THEN 'Reader' ELSE 'Pro' END AS subscription_type,
  CASE event_id % 4 WHEN 0 THEN 'AUTOMATION' WHEN 1 THEN 'FLOW' WHEN 2 THEN 'RESEARCH' ELSE 'CHAT' END AS reporting_service,
  CASE WHEN event_id % 6 = 0 THEN 'Extra' ELSE 'Included' END AS usage_group,
  floor(value * 4) / 16.0 AS usage_hours_raw,
  CASE WHEN event_id % 7 = 0 THEN 'res-plain' ELSE 'arn:aws:assistant:us-east-1:111122223333:flow/f' || (event_id % 12) END AS service_resource_arn,
  'arn:aws:assistant:us-east-1:111122223333:account' AS resource_arn, '111122223333' AS account_id,
  {{epoch}} AS event_timestamp, {_DAY}
FROM {{events}}""",
    "cloudtrail_events": f"""
SELECT CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 97 = 0 THEN '' ELSE {{iso}} || 'Z' END AS timestamp,
  'evt-' || event_id AS event_id,
  CASE event_id % 31
    WHEN 0 THEN 'CreateDashboard' WHEN 1 THEN 'QueryDatabase' WHEN 2 THEN 'SearchAutomations' WHEN 3 THEN 'StartDeployment'
    WHEN 4 THEN 'UpdateActionConnector' WHEN 5 THEN 'PassActionRole' WHEN 6 THEN 'RunWorkflow' WHEN 7 THEN 'StartResearch'
    WHEN 8 THEN 'GetAssistant' WHEN 9 THEN 'ListIntegrations' WHEN 10 THEN 'DescribeAnalysis' WHEN 11 THEN 'ListAnalyses'
    WHEN 12 THEN 'CreateDataSet' WHEN 13 THEN 'UpdateDataSource' WHEN 14 THEN 'CreateIngestion' WHEN 15 THEN 'DescribeTopic'
    WHEN 16 THEN 'CreateSpace' WHEN 17 THEN 'DescribeNamespace' WHEN 18 THEN 'CreateKnowledgeBase' WHEN 19 THEN 'InvokeFlow'
    WHEN 20 THEN 'CreateFolder' WHEN 21 THEN 'ListTemplates' WHEN 22 THEN 'UpdateTheme' WHEN 23 THEN 'RegisterUser'
    WHEN 24 THEN 'GenerateEmbedUrl' WHEN 25 THEN 'DescribeAccountSettings' WHEN 26 THEN 'GetAuthorization'
    WHEN 27 THEN 'SearchThings' WHEN 28 THEN 'QueryDatabase' WHEN 29 THEN 'ListSpaces' ELSE 'TagResource' END AS event_name,
  CASE WHEN event_id % 12 = 0 THEN 'other.example.com' ELSE '{{query_source}}' END AS event_source,
  'AwsApiCall' AS event_type, 'Management' AS event_category,
  CASE event_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-2' ELSE 'eu-west-1' END AS aws_region,
  '10.0.' || (user_id % 200) || '.1' AS source_ip, 'sdk/1.0' AS user_agent,
  CASE event_id % 3 WHEN 0 THEN 'IAMUser' WHEN 1 THEN 'AssumedRole' ELSE 'AWSService' END AS user_type,
  'P' || user_id AS principal_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE 'u' || user_id END AS user_name,
  {_ARN} AS user_arn, '111122223333' AS account_id, '111122223333' AS recipient_account_id, '' AS shared_event_id,
  CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS read_only,
  CASE WHEN event_id % 8 = 0 THEN 'AccessDenied' WHEN event_id % 10 = 0 THEN 'Throttling' ELSE '' END AS error_code,
  CASE WHEN event_id % 8 = 0 THEN 'not allowed' ELSE '' END AS error_message,
  '{{{{"n":' || event_id || '}}}}' AS request_parameters, '{{{{}}}}' AS response_elements,
  CASE WHEN event_id % 19 = 0 THEN 'not json' ELSE '{{{{"eventRequestDetails":{{{{"dataSourceId":"ds-' || (event_id % 6)
    || '","queryId":"q-' || event_id || '","resourceId":' || CASE WHEN event_id % 2 = 0 THEN '{{{{"id":1}}}}' ELSE '"dash-' || (event_id % 9) || '"' END
    || ',"dataSetMode":' || CASE WHEN event_id % 4 = 0 THEN '"{{{{odd"' ELSE '"DIRECT"' END || '}}}}}}}}' END AS service_event_details,
  '[]' AS resources, 'Source' AS resource_type,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE 'arn:aws:assistant:us-east-1:111122223333:source/src' || (event_id % 23) END AS resource_arn, {_DAY}
FROM {{events}}""",
    # Totals per source grow day by day; every document repeats those of its day.
    "index_usage_logs": """
WITH per_day AS (
  SELECT source, doc_id % 28 + 1 AS d, count(*) AS n, sum(n_chars) AS c FROM {documents} GROUP BY source, doc_id % 28 + 1
), running AS (
  SELECT source, d, sum(n) OVER (PARTITION BY source ORDER BY d) AS docs, sum(c) OVER (PARTITION BY source ORDER BY d) AS chars
  FROM per_day
), total AS (
  SELECT d, sum(c) OVER (ORDER BY d) AS chars FROM (SELECT d, sum(c) AS c FROM per_day GROUP BY d) AS days
)
SELECT '2024-01-' || lpad(CAST(r.d AS VARCHAR(2)), 2, '0') || 'T00:00:00' AS timestamp,
  'assistant/index' AS log_group, 'stream-0' AS log_stream, 'INDEX_USAGE_LOGS' AS message_type,
  'arn:aws:assistant:us-east-1:111122223333:user/default/owner-' || o.source AS user_arn,
  CAST(t.chars * 1024 AS BIGINT) AS consumed_index_size,
  CASE WHEN CAST(replace(o.source, 'src', '') AS INT) % 2 = 0 THEN 'KB' ELSE 'SPACE' END AS source_type,
  o.source AS source_name, 'arn:aws:assistant:us-east-1:111122223333:source/' || o.source AS source_arn,
  CAST(r.chars * 1024 AS BIGINT) AS consumed_source_size, CAST(r.docs AS BIGINT) AS consumed_source_doc_count,
  'arn:aws:assistant:us-east-1:111122223333:account' AS resource_arn, '111122223333' AS account_id,
  CAST(1704067200 + (r.d - 1) * 86400 AS BIGINT) AS event_timestamp,
  2024 AS year, 1 AS month, CAST(r.d AS INT) AS day
FROM {documents} AS o JOIN running AS r ON o.source = r.source AND o.doc_id % 28 + 1 = r.d JOIN total AS t ON r.d = t.d""",
}


def _render(table: str, dialect: dict, events: str, documents: str) -> str:
    return TABLES[table].format(events=events, documents=documents, **dialect)


def duckdb_sql(table: str) -> str:
    """The derivation as DuckDB SQL over the given views."""
    text = _render(table, DUCKDB, "events", "documents")
    if table == "agent_hours_logs":
        return f"SELECT * EXCLUDE (usage_hours_raw), CAST(usage_hours_raw AS DOUBLE) AS usage_hours FROM ({text})"
    return text


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table with the columns of its schema, in order."""
    given = "documents" if name == "index_usage_logs" else "events"
    view = f"given_{given}"
    source(spark, sf_dir, given).createOrReplaceTempView(view)
    df = spark.sql(_render(name, SPARK, view, view))
    if name == "agent_hours_logs":
        df = df.withColumnRenamed("usage_hours_raw", "usage_hours")
    return lake.ensure_columns(df, schemas.feed(name).schema)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


# --- raw feeds ------------------------------------------------------------------

# One chat message per event. Its shape and its time field vary, see the CASEs.
RAW_CHAT = """
SELECT event_id, CAST(floor(event_id / 8) AS BIGINT) AS batch, {epoch} * 1000 AS envelope_ms,
  CASE WHEN event_id % 23 = 0 THEN 'plain text ' || event_id
    WHEN event_id % 29 = 0 THEN '[' || event_id || ']'
    WHEN event_id % 31 = 0 THEN '{{"broken": ' || event_id
    ELSE '{{"timestamp":"spoofed","user_arn":"u/' || user_id || '","conversation_id":"conv-' || event_id % 50 || '"'
      || CASE event_id % 4 WHEN 0 THEN ',"logType":"CHAT_LOGS"' WHEN 1 THEN ',"log_type":"CHAT_SNAKE"' WHEN 2 THEN ',"logType":null' ELSE '' END
      || CASE event_id % 6 WHEN 1 THEN ',"trace":{{"at":"edge","hop":' || event_id % 5 || '}}' WHEN 2 THEN ',"retry":' || event_id % 3 ELSE '' END
      || CASE WHEN event_id % 2 = 0 THEN ',"accountId":"a' ELSE ',"account_id":"a' END || event_id % 9 || '"'
      || CASE WHEN event_id % 10 IN (0, 1, 2, 3) THEN ',"event_timestamp":' || ({epoch} * 1000 + 5250)
           WHEN event_id % 10 IN (4, 5) THEN ',"event_timestamp":' || ({epoch} + 7)
           WHEN event_id % 10 = 6 THEN ',"event_timestamp":0'
           WHEN event_id % 10 = 7 THEN ',"event_timestamp":null'
           WHEN event_id % 10 = 8 THEN ',"event_timestamp":"' || {epoch} || '"'
           ELSE '' END
      || ',"latency":' || event_id % 77 || ',"user_selected_resources": [{{"z": ' || event_id || ', "a": [1, 2]}}]'
      || ',"user_message":"hello ' || event_id || '"}}'
  END AS message
FROM {events}"""

# One audit event per record.
RAW_AUDIT = """
SELECT event_id, 'r' || event_id AS record_id,
  CASE WHEN event_id % 43 = 0 THEN 'not json' ELSE
    '{{"source":"' || CASE WHEN event_id % 13 = 0 THEN 'aws.other' ELSE '{audit_source}' END
    || '","detail-type":"' || CASE WHEN event_id % 17 = 0 THEN 'Something Else' WHEN event_id % 2 = 0 THEN 'AWS API Call via CloudTrail' ELSE 'AWS Service Event via CloudTrail' END
    || '","detail":{{"eventID":"evt-' || event_id || '","eventName":"CreateDashboard","eventSource":"{query_source}"'
    || CASE WHEN event_id % 103 = 0 THEN '' WHEN event_id % 97 = 0 THEN ',"eventTime":"soon"' ELSE ',"eventTime":"' || {iso} || 'Z"' END
    || ',"awsRegion":"us-east-1","userIdentity":' || CASE WHEN event_id % 41 = 0 THEN 'null' ELSE
         '{{"type":"IAMUser","arn":"arn/u' || user_id || '"' || CASE WHEN event_id % 5 = 0 THEN '' ELSE ',"userName":"u' || user_id || '"' END || '}}' END
    || CASE event_id % 3 WHEN 0 THEN ',"readOnly":true' WHEN 1 THEN ',"readOnly":false' ELSE '' END
    || CASE WHEN event_id % 8 = 0 THEN ',"errorCode":"AccessDenied"' ELSE '' END
    || ',"requestParameters":{{"b": ' || event_id || ', "a": {{"x": [1, 2]}}}}'
    || CASE WHEN event_id % 2 = 0 THEN ',"responseElements":null' ELSE '' END
    || CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN ',"resources":[]'
         WHEN 2 THEN ',"resources":[{{"type":"AWS::Assistant::Dashboard","ARN":"arn:d/' || event_id || '"}},{{"type":"X","ARN":"y"}}]'
         ELSE ',"resources":[{{"type":"Plain"}}]' END
    || '}}}}' END AS payload
FROM {events}"""


def _gzip(text: Column) -> Column:
    def deflate(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: gzip.compress(t.encode("utf-8"), mtime=0))

    return F.pandas_udf(deflate, T.BinaryType())(text)


def raw_sql(text: str, dialect: dict, events: str = "events") -> str:
    return text.format(events=events, **dialect)


def _raw(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    source(spark, sf_dir, "events").createOrReplaceTempView("given_events")
    return spark.sql(raw_sql(text, SPARK, "given_events"))


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered log records: envelopes of up to eight events, half of them gzipped.

    By batch number: control messages, empty batches, payloads without events
    (an object, a list) and corrupt ones come up too.
    """
    event = F.struct(
        F.col("event_id"), F.struct(F.col("envelope_ms").alias("timestamp"), "message").alias("e")
    )
    batches = _raw(spark, sf_dir, RAW_CHAT).groupBy("batch").agg(F.sort_array(F.collect_list(event)).alias("es"))
    kind, tail = F.col("batch") % 10, F.col("batch") % 11
    events = F.when(kind == 8, F.array().cast("array<struct<timestamp: bigint, message: string>>")).otherwise(
        F.col("es.e")
    )
    envelope = F.to_json(
        F.struct(
            F.when(kind == 9, "CONTROL_MESSAGE").otherwise("DATA_MESSAGE").alias("messageType"),
            F.lit("/g").alias("logGroup"),
            F.concat(F.lit("stream-"), F.col("batch") % 3).alias("logStream"),
            events.alias("logEvents"),
        )
    )
    payload = (
        F.when(tail == 3, "not json {")
        .when(kind == 7, F.format_string('{"note":%d}', "batch"))
        .when(kind == 6, F.format_string("[%d]", "batch"))
        .otherwise(envelope)
    )
    packed = (
        F.when((tail == 3) & (F.col("batch") % 2 == 0), F.unhex(F.lit("1F8B0000")))
        .when(F.col("batch") % 2 == 0, F.col("zipped"))
        .otherwise(F.encode("payload", "UTF-8"))
    )
    return (
        batches.withColumn("payload", payload)
        .withColumn("zipped", _gzip(F.col("payload")))
        .select(F.concat(F.lit("b"), F.col("batch")).alias("record_id"), F.base64(packed).alias("data"))
    )


def feed_records(spark: SparkSession, sf_dir: str, name: str, log_type: str, only: Column | None = None) -> DataFrame:
    """Delivered records of a log table's rows (those of ``only``), one event each, under the feed's own keys."""
    columns = {"logType": "message_type", "log_type": "message_type", "accountId": "account_id"}
    fields = [F.col(columns.get(f, f)).alias(f) for f in schemas.RECORD_FIELDS[log_type]]
    event = F.struct(F.lit(0).alias("timestamp"), F.to_json(F.struct(*fields)).alias("message"))
    envelope = F.struct(
        F.lit("DATA_MESSAGE").alias("messageType"),
        F.col("log_group").alias("logGroup"),
        F.col("log_stream").alias("logStream"),
        F.array(event).alias("logEvents"),
    )
    data = F.base64(F.encode(F.to_json(envelope), "UTF-8"))
    rows = table(spark, sf_dir, name)
    rows = rows if only is None else rows.filter(only)
    return rows.select(F.lit(log_type).alias("record_id"), data.alias("data"))


def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, RAW_AUDIT)
    return raw.select("record_id", F.base64(F.encode("payload", "UTF-8")).alias("data"))


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered chat records that carry message content: one per conversation turn."""
    c = source(spark, sf_dir, "conversations")
    is_user = F.col("role") == "user"
    message = F.to_json(
        F.struct(
            F.lit("CHAT_LOGS").alias("logType"),
            F.lit(1704067200).alias("event_timestamp"),
            F.col("conv_id").cast("string").alias("conversation_id"),
            F.col("turn").cast("string").alias("system_message_id"),
            F.when(is_user, F.col("text")).alias("user_message"),
            F.when(~is_user, F.col("text")).alias("system_text_message"),
        )
    )
    event = F.struct(F.lit(1704067200000).alias("timestamp"), message.alias("message"))
    envelope = F.to_json(
        F.struct(F.lit("DATA_MESSAGE").alias("messageType"), F.array(event).alias("logEvents"))
    )
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("record_id"),
        F.base64(F.encode(envelope, "UTF-8")).alias("data"),
    )
