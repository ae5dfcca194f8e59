"""DuckDB SQL with the result each registered query must give."""

from __future__ import annotations

import re

from workload import catalog_sql, derive

_GB, _MB = 1073741824.0, 1048576.0
_YMD = "year, month, day"
_QUERY_SOURCE = derive.DUCKDB["query_source"]


def _named(column: str) -> str:
    """Usable id: neither NULL, empty nor a dash."""
    return f"nullif(nullif({column}, ''), '-') IS NOT NULL"


def _last_part(column: str) -> str:
    return f"string_split({column}, '/')[-1]"


_TIME = "TRY_CAST(timestamp AS TIMESTAMP)"
_CHAT = f"""SELECT {_TIME} AS event_time, user_arn AS user_id, {_last_part('user_arn')} AS user_name, status_code AS status,
  conversation_id, agent_id, flow_id, action_connectors, namespace,
  CASE WHEN {_named('flow_id')} THEN 'Flow' WHEN NOT ({_named('agent_id')}) THEN ''
    WHEN agent_id = 'SYSTEM' THEN 'System Chat Agent (My Assistant)' ELSE 'Custom Chat Agent' END AS feature,
  TRY_CAST(latency AS DOUBLE) AS latency_ms, TRY_CAST(time_to_first_token AS DOUBLE) AS time_to_first_token_ms,
  surface_type, web_search, message_scope, account_id, {_YMD}
FROM chat_logs WHERE timestamp IS NOT NULL"""
_FEEDBACK = f"""SELECT {_TIME} AS event_time, user_arn AS user_id, {_last_part('user_arn')} AS user_name, status_code AS status,
  conversation_id, research_id, if({_named('research_id')}, 'Research', 'Chat') AS feedback_source,
  feedback_type AS satisfaction, feedback_reason AS reason, feedback_details AS details, rating, namespace, account_id, {_YMD}
FROM feedback_logs WHERE timestamp IS NOT NULL"""
_HOURS = f"""SELECT {_TIME} AS event_time, user_arn AS user_id, {_last_part('user_arn')} AS user_name, subscription_type,
  reporting_service AS service, usage_group, usage_hours AS hours, service_resource_arn,
  CASE WHEN reporting_service IN ('AUTOMATION', 'FLOW', 'RESEARCH')
    THEN reporting_service[1] || lower(reporting_service[2:]) ELSE reporting_service END AS resource_type,
  {_last_part('service_resource_arn')} AS resource_id, account_id, {_YMD}
FROM agent_hours_logs WHERE timestamp IS NOT NULL"""


def _audit(feature: str, where: str) -> str:
    return f"""SELECT {_TIME} AS event_time, event_id, event_name AS api_action, event_source, event_type, user_name, user_type,
  source_ip, user_agent, aws_region, if(coalesce(read_only, false), 'Read', 'Write') AS read_or_write, error_code,
  error_message, resource_type, resource_arn, request_parameters, recipient_account_id, shared_event_id,
  {feature} AS api_feature, account_id, {_YMD}
FROM cloudtrail_events {where}"""


_VIEW_FEATURE = """CASE
  WHEN regexp_matches(event_name, 'Automation|Deployment') THEN 'Automation'
  WHEN regexp_matches(event_name, 'ActionConnector|PassAction') THEN 'Connector'
  WHEN event_name LIKE '%Workflow%' THEN 'Workflow'
  WHEN event_name LIKE '%Research%' THEN 'Research'
  WHEN regexp_matches(event_name, 'Assistant|Chat|Conversation') THEN 'Chat'
  WHEN event_name LIKE '%Integration%' THEN 'Integration'
  WHEN event_name LIKE '%Dashboard%' THEN 'Dashboard'
  WHEN event_name LIKE '%Analys%' THEN 'Analysis'
  WHEN regexp_matches(event_name, 'Data[Ss]et') THEN 'Dataset'
  WHEN event_name LIKE '%DataSource%' THEN 'Data Source'
  WHEN regexp_matches(event_name, 'Ingestion|Refresh') THEN 'Ingestion'
  WHEN event_name LIKE '%Topic%' THEN 'Q Topic'
  WHEN regexp_matches(event_name, 'Space|Namespace') THEN 'Space'
  WHEN event_name LIKE '%Knowledge%' THEN 'Knowledge Base'
  WHEN event_name LIKE '%Flow%' THEN 'Flow'
  WHEN event_name LIKE '%Folder%' THEN 'Folder'
  WHEN event_name LIKE '%Template%' THEN 'Template'
  WHEN event_name LIKE '%Theme%' THEN 'Theme'
  WHEN regexp_matches(event_name, 'User|Group|Membership') THEN 'User & Access'
  WHEN event_name LIKE '%Embed%' THEN 'Embedding'
  WHEN regexp_matches(event_name, 'Account|Setting') THEN 'Account Settings'
  WHEN event_name LIKE '%Authorization%' THEN 'Authorization'
  WHEN event_name LIKE '%Search%' THEN 'Search'
  ELSE 'Other' END"""
_DATASET_FEATURE = """CASE
  WHEN regexp_matches(event_name, 'Automation|Deployment') AND event_name NOT LIKE 'Search%' THEN 'Automation'
  WHEN event_name LIKE '%PassAction%' THEN 'Connector'
  WHEN event_name LIKE '%Workflow%' THEN 'Workflow'
  WHEN event_name LIKE '%Research%' THEN 'Research'
  WHEN event_name LIKE '%Dashboard%' THEN 'Dashboard'
  WHEN event_name LIKE '%Analys%' THEN 'Analysis'
  WHEN regexp_matches(event_name, 'Data[Ss]et') THEN 'Dataset'
  WHEN event_name LIKE '%DataSource%' THEN 'Data Source'
  WHEN regexp_matches(event_name, 'Ingestion|Refresh') THEN 'Ingestion'
  WHEN event_name LIKE '%Topic%' THEN 'Topic'
  WHEN event_name LIKE '%Space' THEN 'Space'
  WHEN event_name LIKE '%Knowledge%' THEN 'Knowledgebase'
  WHEN event_name LIKE '%Folder%' THEN 'Folder'
  WHEN event_name LIKE '%Template%' THEN 'Template'
  WHEN event_name LIKE '%Theme%' THEN 'Theme'
  WHEN event_name LIKE '%Embed%' THEN 'Embedding'
  WHEN event_name LIKE '%Authorization%' THEN 'Authorization'
  WHEN event_name LIKE 'Search%' THEN 'Search'
  WHEN event_name LIKE '%Database%' THEN 'Database'
  ELSE event_name END"""


def _scalar(name: str) -> str:
    """A JSON member as text unless it is an object or array; NULL for bad JSON."""
    valid = "CASE WHEN json_valid(service_event_details) THEN service_event_details END"
    path = f"$.eventRequestDetails.{name}"
    return (
        f"CASE WHEN json_type({valid}, '{path}') NOT IN ('OBJECT', 'ARRAY')"
        f" THEN json_extract_string({valid}, '{path}') END"
    )


_SCALARS = ", ".join(
    f"{_scalar(key)} AS {name}"
    for name, key in {
        "datasource_id": "dataSourceId",
        "query_id": "queryId",
        "dashboard_or_analysis_id": "resourceId",
        "dataset_id": "dataSetId",
        "dataset_mode": "dataSetMode",
    }.items()
)

_INDEX = f"""SELECT max({_TIME}) AS event_time, max({_last_part('user_arn')}) AS user_name,
  consumed_index_size, round(consumed_index_size / {_GB}, 4) AS consumed_index_size_gb, round(consumed_index_size / {_MB}, 2) AS consumed_index_size_mb,
  source_type, source_name, source_arn,
  consumed_source_size, round(consumed_source_size / {_GB}, 4) AS consumed_source_size_gb, round(consumed_source_size / {_MB}, 2) AS consumed_source_size_mb,
  consumed_source_doc_count, max(resource_arn) AS resource_arn, max(account_id) AS account_id, {_YMD}
FROM index_usage_logs WHERE timestamp IS NOT NULL GROUP BY ALL"""

_D_CHAT = """SELECT event_time, user_name, feature, status, conversation_id, agent_id, flow_id, latency_ms, time_to_first_token_ms,
  surface_type, web_search, message_scope, action_connectors, namespace, account_id FROM chat_activity"""
_D_FEEDBACK = """SELECT event_time, user_name, status, conversation_id, research_id, feedback_source, satisfaction AS feedback_type,
  reason, details, rating, namespace, account_id FROM feedback_analysis"""
_D_HOURS = """SELECT event_time, user_name, service, hours, usage_group, resource_type, resource_id, subscription_type,
  service_resource_arn, account_id FROM agent_hours_usage"""
_D_AUDIT = f"""SELECT event_time, event_id, api_action, event_source, event_type, user_name, user_type, source_ip, user_agent,
  aws_region, read_or_write, error_code, error_message, resource_type, resource_arn, request_parameters,
  recipient_account_id, api_feature, account_id FROM ({_audit(_DATASET_FEATURE, '')})"""
_D_INDEX = f"SELECT * EXCLUDE (resource_arn, {_YMD}) FROM index_usage"

# --- raw feeds: what each record and event must come to --------------------------------

# The batch rules of derive.log_records, by batch number.
_BATCHES = """SELECT DISTINCT batch, CASE WHEN batch % 11 = 3 THEN 'unreadable' WHEN batch % 10 IN (6, 7) THEN 'passthrough'
  WHEN batch % 10 = 9 THEN 'control' ELSE 'events' END AS kind, batch % 10 = 8 AS empty FROM raw_chat"""
_EVENTS = """SELECT r.*, t.* EXCLUDE (event_id),
  CASE WHEN own > 9999999999 THEN own // 1000 WHEN own <> 0 THEN own ELSE envelope_ms // 1000 END AS seconds,
  CASE WHEN r.event_id % 23 <> 0 AND r.event_id % 29 = 0 THEN 'not_an_object' WHEN text_time THEN 'bad_event_time' END AS reason
FROM raw_chat r JOIN (
  SELECT event_id, is_object, is_object AND event_id % 10 = 8 AS text_time,
    CASE WHEN is_object AND event_id % 10 <> 8 THEN TRY_CAST(json_extract_string(message, '$.event_timestamp') AS BIGINT) END AS own,
    CASE WHEN event_id % 23 = 0 OR (event_id % 29 <> 0 AND event_id % 31 = 0) THEN message END AS raw_message,
    CASE WHEN is_object THEN message END AS object
  FROM (SELECT event_id, message, event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 31 <> 0 AS is_object FROM raw_chat)
) t USING (event_id)"""
_ISO_SECONDS = "strftime(make_timestamp(seconds * 1000000), '%Y-%m-%dT%H:%M:%S')"
_MESSAGE_TYPE = "CASE WHEN is_object THEN CASE event_id % 4 WHEN 0 THEN 'CHAT_LOGS' WHEN 1 THEN 'CHAT_SNAKE' WHEN 3 THEN 'UNKNOWN' END ELSE 'UNKNOWN' END"
_DELIVERED = """SELECT e.*, b.kind FROM raw_events e JOIN batches b USING (batch) WHERE b.kind = 'events' AND NOT b.empty"""


def _member(name: str) -> str:
    return f"json_extract_string(object, '$.{name}')"


_AUDIT_OK = "event_id % 43 <> 0 AND event_id % 41 <> 0"
_FLAT_AUDIT = f"""SELECT coalesce(eventTime, '') AS timestamp, 'evt-' || event_id AS event_id, 'CreateDashboard' AS event_name,
  '{_QUERY_SOURCE}' AS event_source, '' AS event_type, '' AS event_category, 'us-east-1' AS aws_region,
  '' AS source_ip, '' AS user_agent, 'IAMUser' AS user_type, '' AS principal_id,
  if(event_id % 5 = 0, '', 'u' || user_id) AS user_name, 'arn/u' || user_id AS user_arn, '' AS account_id,
  '' AS recipient_account_id, '' AS shared_event_id, event_id % 3 = 0 AS read_only,
  if(event_id % 8 = 0, 'AccessDenied', '') AS error_code, '' AS error_message,
  '{{"b":' || event_id || ',"a":{{"x":[1,2]}}}}' AS request_parameters,
  if(event_id % 2 = 0, 'null', '{{}}') AS response_elements, '{{}}' AS service_event_details,
  CASE event_id % 4 WHEN 2 THEN '[{{"type":"AWS::Assistant::Dashboard","ARN":"arn:d/' || event_id || '"}},{{"type":"X","ARN":"y"}}]'
    WHEN 3 THEN '[{{"type":"Plain"}}]' ELSE '[]' END AS resources,
  CASE event_id % 4 WHEN 2 THEN 'Dashboard' WHEN 3 THEN 'Plain' ELSE '' END AS resource_type,
  if(event_id % 4 = 2, 'arn:d/' || event_id, '') AS resource_arn,
  CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day
FROM (SELECT *, CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'soon' ELSE {derive.DUCKDB['iso']} || 'Z' END AS eventTime,
  if(event_id % 103 = 0 OR event_id % 97 = 0, DATE '2024-02-01', CAST(ts AS DATE)) AS d
  FROM events WHERE {_AUDIT_OK})"""

_CTES = {name: derive.duckdb_sql(name) for name in derive.TABLES} | {
    "raw_chat": derive.raw_sql(derive.RAW_CHAT, derive.DUCKDB),
    "batches": _BATCHES,
    "raw_events": _EVENTS,
    "delivered": _DELIVERED,
    "flat_audit": _FLAT_AUDIT,
    "chat_activity": _CHAT,
    "feedback_analysis": _FEEDBACK,
    "agent_hours_usage": _HOURS,
    "api_audit_trail": _audit(_VIEW_FEATURE, "WHERE timestamp IS NOT NULL"),
    "index_usage": _INDEX,
    "d_chat": _D_CHAT,
    "d_feedback": _D_FEEDBACK,
    "d_hours": _D_HOURS,
    "d_audit": _D_AUDIT,
    "d_index": _D_INDEX,
    "source_days": """SELECT source_arn, source_name, source_type, CAST(event_time AS DATE) AS day,
  max(consumed_source_size_gb) AS source_size_gb, max(consumed_source_doc_count) AS doc_count FROM d_index GROUP BY ALL""",
    "latest_sources": """SELECT * FROM source_days QUALIFY row_number() OVER (PARTITION BY source_arn, source_name, source_type ORDER BY day DESC) = 1""",
}


def _needs(sql: str, found: list[str]) -> list[str]:
    for name, text in _CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            # A table's own derivation names no other entry but the given tables.
            _needs(text, found)
            if name not in found:
                found.append(name)
    return found


def sql(body: str) -> str:
    """The body behind the derivations it names."""
    names = _needs(body, [])
    ctes = ", ".join(f"{name} AS ({_CTES[name]})" for name in names)
    if ctes and body.startswith("WITH "):
        return f"WITH {ctes}, {body.removeprefix('WITH ')}"
    return f"WITH {ctes} {body}" if ctes else body


def _gb(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(38, 4))) AS DOUBLE)"


_DAY = "CAST(event_time AS DATE)"
_FRAMES = {
    "chat-activity": "d_chat",
    "feedback-analysis": "d_feedback",
    "agent-hours-usage": "d_hours",
    "api-audit-trail": "d_audit",
    "index-usage": "d_index",
}


_USERS, _SESSIONS = "count(DISTINCT user_name) AS unique_users", "count(DISTINCT conversation_id) AS chat_sessions"
_HOURS_SUM, _CALLS, _RESPONSES = "sum(hours) AS agent_hours", "count(api_action) AS api_calls", "count({}) AS feedback_responses"
# Each visual's drill path: table, measure, columns from the coarsest on.
_DRILLS = {
    "m03": ("d_chat", _USERS, "day feature user_name"),
    "m04": ("d_chat", _SESSIONS, "feature user_name"),
    "m05": ("d_chat", _SESSIONS, "user_name feature"),
    "m06": ("d_chat", _SESSIONS, "day feature user_name"),
    "m07": ("d_chat", _SESSIONS, "status user_name"),
    "m10": ("d_hours", _HOURS_SUM, "service resource_type user_name"),
    "m11": ("d_hours", _HOURS_SUM, "user_name service"),
    "m12": ("d_hours", _HOURS_SUM, "usage_group service user_name"),
    "m13": ("d_hours", _HOURS_SUM, "day service user_name"),
    "m15": ("d_feedback", _RESPONSES.format("feedback_type"), "feedback_type user_name"),
    "m16": ("d_feedback", _RESPONSES.format("reason"), "reason user_name"),
    "m18": ("d_audit", _CALLS, "api_feature api_action user_name"),
    "m19": ("d_audit", _CALLS, "user_type api_feature"),
}


def _drill(frame: str, measure: str, path: str) -> str:
    """All levels of a drill path as one union of plain group-bys."""
    names = path.split()
    values = [_DAY if c == "day" else c for c in names]
    parts = []
    for level in range(len(names) + 1):
        keys = [f"{v if i < level else 'NULL'} AS {n}" for i, (n, v) in enumerate(zip(names, values, strict=True))]
        grouping = f"GROUP BY {', '.join(values[:level])}" if level else ""
        parts.append(f"SELECT {', '.join(keys)}, {level} AS level, {measure} FROM {frame} {grouping}")
    return " UNION ALL ".join(parts)


_FAILED = _named("error_code")
_CATALOG_COUNTS = [
    ("chat-activity", "d_chat", 2, 13),
    ("feedback-analysis", "d_feedback", 0, 12),
    ("agent-hours-usage", "d_hours", 1, 9),
    ("api-audit-trail", "d_audit", 0, 19),
    ("index-usage", "d_index", 3, 6),
]


def _digits(text: str) -> str:
    return f"list_transform(string_split(regexp_replace({text}, '[^0-9]', '', 'g'), ''), lambda d: CAST(d AS INTEGER))"


def _weighted(values: str, weights: list[int]) -> str:
    return f"list_sum(list_transform(list_zip({values}[1:{len(weights)}], {weights}), lambda w: w[1] * w[2]))"


def _luhn(digits: str) -> str:
    odd = f"list_sum(list_transform(range(1, len({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN list_reverse({digits})[i] ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][list_reverse({digits})[i] + 1] END))"
    return f"list_sum({digits}) > 0 AND {odd} % 10 = 0"


def _eleven(values: str, weights: list[int]) -> str:
    rest = f"({_weighted(values, weights)} % 11)"
    return f"(CASE WHEN {rest} < 2 THEN 0 ELSE 11 - {rest} END)"


_V = _digits("m")
_SPANISH = "regexp_replace(m, '[ -]', '', 'g')"
_FRENCH = "replace(m, ' ', '')"
_TURNED = "(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4])"
_VIN = "list_transform(string_split(translate(m, 'ABCDEFGHJKLMNPRSTUVWXYZ', '12345678123457923456789'), ''), lambda d: CAST(d AS INTEGER))"
_VIN_REST = f"({_weighted(_VIN, [8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2])} % 11)"
# What a match m must fulfil.
_CHECKS = {
    "IBAN": f"""length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split({_TURNED}, ''),
  lambda c: CASE WHEN c <= '9' THEN CAST(ascii(c) - 48 AS BIGINT) ELSE ascii(c) - 55 END), lambda a, x: (a * (CASE WHEN x > 9 THEN 100 ELSE 10 END) + x) % 97) = 1""",
    "VEHICLE": f"len(list_distinct({_VIN})) > 1 AND (CASE WHEN {_VIN_REST} = 10 THEN 'X' ELSE CAST({_VIN_REST} AS VARCHAR) END) = m[9]",
    "CNPJ_BR": f"list_sum({_V}) > 0 AND ({_V})[13] = {_eleven(_V, [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])} AND ({_V})[14] = {_eleven(_V, [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2])}",
    "INSEE_FR": f"97 - CAST(replace(replace({_FRENCH}[1:13], '2A', '19'), '2B', '18') AS BIGINT) % 97 = CAST({_FRENCH}[14:15] AS BIGINT)",
    "CARD": _luhn(_V),
    "CPF_BR": f"len(list_distinct({_V})) > 1 AND ({_V})[10] = {_eleven(_V, [10, 9, 8, 7, 6, 5, 4, 3, 2])} AND ({_V})[11] = {_eleven(_V, [11, 10, 9, 8, 7, 6, 5, 4, 3, 2])}",
    "TAXID_DE": f"""({_V})[1] > 0 AND (11 - list_reduce(list_prepend(10, ({_V})[1:10]),
  lambda a, x: (2 * (CASE WHEN (a + x) % 10 = 0 THEN 10 ELSE (a + x) % 10 END)) % 11)) % 10 = ({_V})[11]""",
    "NHS_GB": f"list_sum({_V}) > 0 AND (11 - {_weighted(_V, [10, 9, 8, 7, 6, 5, 4, 3, 2])} % 11) % 11 = ({_V})[10]",
    "PROVIDER_US": _luhn(_digits("('80840' || m)")),
    "ROUTING_US": f"""list_sum({_V}) > 0 AND {_weighted(_V, [3, 7, 1, 3, 7, 1, 3, 7, 1])} % 10 = 0
  AND (CAST(m[1:2] AS INTEGER) BETWEEN 0 AND 12 OR CAST(m[1:2] AS INTEGER) BETWEEN 21 AND 32 OR CAST(m[1:2] AS INTEGER) BETWEEN 61 AND 72 OR m[1:2] = '80')""",
    "DEA_US": f"{_weighted(_digits('m[3:9]'), [1, 2, 1, 2, 1, 2])} % 10 = CAST(m[9] AS INTEGER)",
    "NIF_ES": f"'TRWAGMYFPDXBNJZSQVHLCKE'[CAST(translate({_SPANISH}[1:8], 'XYZ', '012') AS INTEGER) % 23 + 1] = {_SPANISH}[9]",
}
_CHECKS["NIE_ES"] = _CHECKS["NIF_ES"]


def _mask_sql(source: str, keys: str, patterns: dict[str, str]) -> str:
    """The texts of a table with every match replaced, one pattern after another."""
    for name, pattern in patterns.items():
        masked = f"regexp_replace(text, '{pattern}', '[{name}]', 'g')"
        if name in _CHECKS:
            check = re.sub(r"\bm\b", "z[2]", _CHECKS[name])
            parts = f"list_zip(string_split_regex(text, '{pattern}'), regexp_extract_all(text, '{pattern}'))"
            masked = f"array_to_string(list_transform({parts}, lambda z: z[1] || CASE WHEN z[2] IS NULL THEN '' WHEN {check} THEN '[{name}]' ELSE z[2] END), '')"
            masked = f"CASE WHEN regexp_matches(text, '{pattern}') THEN {masked} ELSE text END"
        source = f"(SELECT {keys}, {masked} AS text FROM {source})"
    return f"SELECT {keys}, text FROM {source}"


# The masking patterns in RE2 spelling, whose word boundary is an ASCII one.
_RE2 = {
    "PRIVATE_KEY": r"-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----(?s:.*?)(-----END [A-Z ]*PRIVATE KEY( BLOCK)?-----|\z)",
    "ACCESS_KEY": r"\b(AKIA|ASIA)[0-9A-Z]{16}\b",
    "SECRET_KEY": r"""\b(?i:aws_secret_access_key|secret_key|api_key)["']? *[=:] *["']?[A-Za-z0-9/+=_-]{16,}""",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b",
    "IBAN": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "VEHICLE": r"\b[A-HJ-NPR-Z0-9]{17}\b",
    "CNPJ_BR": r"\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b",
    "INSEE_FR": r"\b[12] ?\d{2} ?\d{2} ?(?:\d{2}|2[AB]) ?\d{3} ?\d{3} ?\d{2}\b",
    "CARD": r"\b(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?:[ -]?\d{1,3})?|\d{4}[ -]?\d{6}[ -]?\d{4,5}|\d{13,19})\b",
    "CPF_BR": r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b",
    "TAXID_DE": r"\b\d{2} ?\d{3} ?\d{3} ?\d{3}\b",
    "NHS_GB": r"\b\d{3} ?\d{3} ?\d{4}\b",
    "PROVIDER_US": r"\b[12]\d{9}\b",
    "ROUTING_US": r"\b\d{9}\b",
    "DEA_US": r"\b[ABFGMPRX][A-Z9]\d{7}\b",
    "NIF_ES": r"\b\d{8}[ -]?[A-Z]\b",
    "NIE_ES": r"\b[XYZ][ -]?\d{7}[ -]?[A-Z]\b",
    "SSN_US": r"\b\d{3}-\d{2}-\d{4}\b",
    "PHONE_US": r"(\+1[ .-]?)?(\(\d{3}\) ?|\b\d{3}[ .-])\d{3}[ .-]\d{4}\b",
    "IPV4": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}
_RE2 = {name: pattern.replace("'", "''") for name, pattern in _RE2.items()}
_MASKED = _RE2


def _hits(name: str, pattern: str) -> str:
    found = f"regexp_extract_all(text, '{pattern}')"
    if name in _CHECKS:
        found = f"list_filter({found}, lambda z: {re.sub(r'\bm\b', 'z', _CHECKS[name])})"
    return f"CAST(sum(len({found})) AS BIGINT) AS {name.lower()}"


_HITS = ", ".join(_hits(n, p) for n, p in _MASKED.items())

_NO_SPACES = "replace(replace(json_extract(object, '$.user_selected_resources')::VARCHAR, ' ', ''), chr(10), '')"
_RANGE = "make_date(year, month, day) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"


def _table_counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names)


_TABLES = list(derive.TABLES)
_FIELDS = {
    "i16_chat_fields": (
        "chat_logs",
        "user_arn, user_type, status_code, conversation_id, system_message_id, user_message_id, agent_id, flow_id, message_scope,"
        " user_selected_resources, action_connectors, cited_resource, file_attachment, resource_arn, event_timestamp, message_type AS logType,"
        " account_id AS accountId, namespace, latency, time_to_first_token, surface_type, web_search",
    ),
    "i16_feedback_fields": (
        "feedback_logs",
        "user_arn, user_type, status_code, conversation_id, system_message_id, user_message_id, research_id, feedback_type, feedback_reason,"
        " feedback_details, rating, resource_arn, event_timestamp, message_type AS logType, account_id AS accountId, namespace",
    ),
    "i16_agent_hours_fields": (
        "agent_hours_logs",
        "user_arn, subscription_type, reporting_service, usage_group, usage_hours, service_resource_arn, resource_arn, event_timestamp,"
        " message_type AS logType, account_id AS accountId",
    ),
    "i16_index_usage_fields": (
        "index_usage_logs",
        "resource_arn, event_timestamp, message_type AS log_type, account_id, user_arn, consumed_index_size, source_type, source_name,"
        " source_arn, consumed_source_size, consumed_source_doc_count",
    ),
}
_RANKED = "row_number() OVER (ORDER BY {value} {way} NULLS LAST, {ties})"


def _top(body: str, value: str, ties: str, n: int, way: str = "DESC") -> str:
    return f"SELECT * FROM ({body}) ORDER BY {value} {way} NULLS LAST, {ties} LIMIT {n}"


def _oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    # I
    o["i01_decode_envelopes"] = "SELECT 'b' || batch AS record_id, NOT (batch % 11 = 3 AND batch % 2 = 0) AS decoded FROM batches"
    o["i02_drop_control"] = "SELECT 'b' || batch AS record_id, kind FROM batches WHERE kind <> 'control'"
    o["i03_explode_events"] = "SELECT 'b' || batch AS record_id, '/g' AS log_group, 'stream-' || batch % 3 AS log_stream, envelope_ms, message FROM delivered"
    o["i04_parse_message"] = f"SELECT event_id, raw_message, {_member('conversation_id')} AS conversation_id FROM raw_events"
    o["i05_event_time"] = f"SELECT event_id, CASE WHEN NOT text_time THEN {_ISO_SECONDS} END AS timestamp, reason FROM raw_events"
    o["i06_conform_keys"] = f"""SELECT event_id, '/g' AS log_group, 's' AS log_stream, {_MESSAGE_TYPE} AS message_type, {_member('user_arn')} AS user_arn,
  coalesce({_member('accountId')}, {_member('account_id')}) AS account_id, TRY_CAST({_member('event_timestamp')} AS BIGINT) AS event_timestamp,
  {_member('latency')} AS latency, {_member('user_message')} AS user_message, raw_message FROM raw_events"""
    kept = (
        "record_id timestamp log_group log_stream message_type user_arn user_type agent_id flow_id conversation_id system_message_id"
        " user_message_id user_selected_resources status_code message_scope action_connectors cited_resource file_attachment resource_arn"
        " account_id event_timestamp namespace latency time_to_first_token surface_type web_search raw_message extra_fields"
    ).replace(" ", ",")
    o["i07_strip_sensitive"] = f"SELECT 'b' || batch AS record_id, '{kept}' AS columns_kept, {_member('conversation_id')} AS conversation_id FROM delivered WHERE reason IS NULL"
    o["i06_extra_fields"] = """SELECT event_id, CASE WHEN object IS NULL THEN NULL WHEN event_id % 6 = 1 THEN '{"trace":{"at":"edge","hop":' || event_id % 5 || '}}'
  WHEN event_id % 6 = 2 THEN '{"retry":' || event_id % 3 || '}' END AS extra_fields FROM raw_events"""
    o["i08_nested_json_text"] = f"SELECT event_id, {_NO_SPACES} AS user_selected_resources FROM raw_events"
    result = "CASE kind WHEN 'unreadable' THEN 'ProcessingFailed' WHEN 'passthrough' THEN 'Ok' WHEN 'control' THEN 'Dropped' ELSE if(empty OR NOT survived, 'Dropped', 'Ok') END"
    routed = f"SELECT batch, kind, {result} AS result FROM batches JOIN (SELECT batch, bool_or(reason IS NULL) AS survived FROM raw_events GROUP BY batch) USING (batch)"
    o["i09_route_records"] = f"SELECT 'b' || batch AS record_id, result FROM ({routed})"
    o["i09_rejected_events"] = "SELECT 'b' || batch AS record_id, reason, message AS rejected_message FROM delivered WHERE reason IS NOT NULL"
    o["i10_passthrough"] = "SELECT 'b' || batch AS record_id, if(batch % 10 = 7, '{\"note\":' || batch || '}', '[' || batch || ']') AS payload FROM batches WHERE kind = 'passthrough'"
    o["i11_flatten_audit"] = "SELECT * FROM flat_audit"
    o["i12_partition_keys"] = "SELECT year, month, day, count(*) AS row_count FROM flat_audit GROUP BY ALL"
    o["i13_resource_type"] = "SELECT event_id, resources, resource_type FROM flat_audit"
    o["i14_resource_arn"] = "SELECT event_id, resource_arn FROM flat_audit"
    o["i15_filter_audit_feed"] = f"SELECT 'r' || event_id AS record_id, '{derive.DUCKDB['audit_source']}' AS source FROM events WHERE event_id % 43 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0"
    for key, (table, fields) in _FIELDS.items():
        o[key] = f"SELECT {fields} FROM {table}"
    o["i17_read_raw"] = "SELECT * FROM chat_logs"
    o["i18_read_range"] = f"SELECT * FROM cloudtrail_events WHERE {_RANGE}"
    o["i19_skip_missing"] = _table_counts(["feedback_logs", "agent_hours_logs"])
    o["i20_partitions_from_path"] = "SELECT year, month, day, count(*) AS row_count FROM agent_hours_logs GROUP BY ALL"
    o["i21_ensure_columns"] = """SELECT timestamp, NULL AS log_group, NULL AS log_stream, NULL AS message_type, user_arn, NULL AS user_type, NULL AS conversation_id,
  NULL AS system_message_id, NULL AS user_message_id, NULL AS research_id, NULL AS feedback_type, NULL AS feedback_reason, NULL AS feedback_details,
  CAST(event_timestamp AS VARCHAR) AS rating, NULL AS status_code, NULL AS resource_arn, NULL AS account_id, CAST(NULL AS BIGINT) AS event_timestamp,
  NULL AS namespace, year, CAST(NULL AS INT) AS month, CAST(NULL AS INT) AS day FROM feedback_logs"""
    o["i22_create_table"] = "SELECT 'created' AS table_name, CAST(0 AS BIGINT) AS row_count UNION ALL SELECT 'filled', count(*) FROM feedback_logs"
    o["i23_overwrite_partitions"] = "SELECT * FROM feedback_logs"
    o["i24_land"] = "SELECT user_arn, usage_hours, 2024 AS year, 2 AS month, 1 AS day FROM agent_hours_logs"
    o["i25_curate_all"] = _table_counts(_TABLES)
    o["i24_shared_root"] = "SELECT * EXCLUDE (year, month, day) FROM feedback_logs"
    o["i25_broken_feed"] = f"SELECT table_name, if(table_name = 'feedback_logs', 0, row_count) AS row_count, table_name = 'feedback_logs' AS failed FROM ({_table_counts(_TABLES)})"
    o["i25_quarantine"] = """SELECT if(cut, NULL, user_arn) AS user_arn, if(cut, NULL, usage_hours) AS usage_hours, if(cut, NULL, event_timestamp) AS event_timestamp,
  year, month, day, if(cut, left('{"timestamp":"' || timestamp, 25), NULL) AS line FROM (SELECT *, event_timestamp % 10 = 3 AS cut FROM agent_hours_logs)"""
    o["i26_refresh_dataset"] = "SELECT * FROM d_chat"
    o["i26_snapshot_days"] = f"SELECT {_DAY} AS event_day, count(*) AS row_count, CAST(1 AS BIGINT) AS times FROM d_chat GROUP BY 1"
    o["i27_datasets_ready"] = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count, count(*) > 0 AS ready FROM {frame}" for name, frame in _FRAMES.items()
    )
    o["i28_table_counts"] = _table_counts(_TABLES)
    # W, D
    for i, view in enumerate(["chat_activity", "feedback_analysis", "agent_hours_usage", "api_audit_trail"], 1):
        o[f"w{i}_{view}"] = f"SELECT * FROM {view}"
    o["w5_querydatabase_events"] = f"""SELECT {_TIME} AS event_time, event_id, user_name, user_type, aws_region, error_code, {_SCALARS}, account_id, {_YMD}
FROM cloudtrail_events WHERE event_name = 'QueryDatabase' AND event_source = '{_QUERY_SOURCE}' AND timestamp IS NOT NULL"""
    o["w6_index_usage"] = "SELECT * FROM index_usage"
    for i, (name, frame) in enumerate(_FRAMES.items(), 1):
        number = {"chat-activity": 1, "feedback-analysis": 2, "agent-hours-usage": 3, "api-audit-trail": 4, "index-usage": 5}[name]
        o[f"d{number}_{name.replace('-', '_')}"] = f"SELECT * FROM {frame}"
    o["d6_projection"] = "SELECT * FROM d_hours"
    o["d7_by_database"] = "SELECT service, sum(hours) AS hours FROM d_hours GROUP BY service"
    # F
    o["f01_event_time"] = f"SELECT event_id, timestamp, {_TIME} AS event_time FROM cloudtrail_events"
    o["f02_short_name"] = f"SELECT user_arn, {_last_part('user_arn')} AS user_name FROM chat_logs"
    o["f03_chat_feature"] = f"""SELECT flow_id, agent_id, CASE WHEN {_named('flow_id')} THEN 'Flow' WHEN NOT ({_named('agent_id')}) THEN ''
  WHEN agent_id = 'SYSTEM' THEN 'System Chat Agent (My Assistant)' ELSE 'Custom Chat Agent' END AS feature FROM chat_logs"""
    o["f04_feedback_source"] = f"SELECT research_id, if({_named('research_id')}, 'Research', 'Chat') AS feedback_source FROM feedback_logs"
    o["f05_view_feature"] = f"SELECT event_name, {_VIEW_FEATURE} AS api_feature FROM cloudtrail_events"
    o["f06_dataset_feature"] = f"SELECT event_name, {_DATASET_FEATURE} AS api_feature FROM cloudtrail_events"
    o["f07_resource_label"] = "SELECT reporting_service, if(reporting_service = 'CHAT', 'CHAT', reporting_service[1] || lower(reporting_service[2:])) AS resource_type FROM agent_hours_logs"
    o["f08_read_or_write"] = "SELECT read_only, if(coalesce(read_only, false), 'Read', 'Write') AS read_or_write FROM cloudtrail_events"
    o["f09_text_to_double"] = "SELECT latency, time_to_first_token, TRY_CAST(latency AS DOUBLE) AS latency_ms, TRY_CAST(time_to_first_token AS DOUBLE) AS ttft_ms FROM chat_logs"
    o["f10_bytes_to_gb_mb"] = f"SELECT consumed_source_size, round(consumed_source_size / {_GB}, 4) AS gb, round(consumed_source_size / {_MB}, 2) AS mb FROM index_usage_logs"
    o["f11_json_scalars"] = f"SELECT event_id, {_SCALARS} FROM cloudtrail_events"
    o["f12_not_null_time"] = "SELECT timestamp, system_message_id FROM chat_logs WHERE timestamp IS NOT NULL"
    o["f13_name_and_source"] = f"SELECT event_id, event_name, event_source FROM cloudtrail_events WHERE event_name = 'QueryDatabase' AND event_source = '{_QUERY_SOURCE}'"
    o["f14_calendar_day"] = f"SELECT event_time, {_DAY} AS event_day FROM chat_activity"
    o["f15_percent"] = """SELECT user_name, count(*) FILTER (web_search = 'true') AS web, count(*) AS messages,
  round(100.0::DOUBLE * count(*) FILTER (web_search = 'true') / count(*), 1) AS percentage FROM chat_activity GROUP BY user_name"""
    # A, N
    o["a01_approx_distinct_count"] = "SELECT surface_type, count(DISTINCT conversation_id) AS sessions, true AS close FROM chat_activity GROUP BY surface_type"
    o["a01_distinct_count"] = "SELECT surface_type, count(DISTINCT user_name) AS users FROM chat_activity GROUP BY surface_type"
    o["a02_count"] = "SELECT satisfaction, count(reason) AS with_reason, count(*) AS row_count FROM feedback_analysis GROUP BY satisfaction"
    o["a03_sum"] = "SELECT resource_id, sum(hours) AS hours FROM agent_hours_usage GROUP BY resource_id"
    o["a04_max"] = f"SELECT source_type, max(consumed_source_size) AS largest, max({_last_part('user_arn')}) AS last_user FROM index_usage_logs GROUP BY source_type"
    o["a05_average"] = "SELECT feature, avg(latency_ms) AS latency_ms FROM chat_activity GROUP BY feature"
    o["a06_dedup_by_grouping"] = "SELECT source_name, day, count(*) AS row_count FROM index_usage GROUP BY ALL"
    o["a07_day_grain"] = f"SELECT {_DAY} AS day, count(*) AS row_count FROM agent_hours_usage GROUP BY 1"
    o["a08_second_dimension"] = f"SELECT {_DAY} AS day, usage_group, sum(hours) AS hours FROM agent_hours_usage GROUP BY 1, 2"
    o["a09_aggregated_table"] = "SELECT subscription_type, resource_type, sum(hours) AS hours, count(DISTINCT user_name) AS users FROM agent_hours_usage GROUP BY ALL"
    o["a10_measure_builder"] = """SELECT surface_type, count(latency_ms) AS latency_ms_count, count(DISTINCT latency_ms) AS latency_ms_distinct_count,
  sum(latency_ms) AS latency_ms_sum, avg(latency_ms) AS latency_ms_average, max(latency_ms) AS latency_ms_max, min(latency_ms) AS latency_ms_min
FROM chat_activity GROUP BY surface_type"""
    calls = "SELECT api_action, count(*) AS calls FROM api_audit_trail GROUP BY api_action"
    o["n1_share_of_total"] = f"SELECT *, round(100.0::DOUBLE * calls / sum(calls) OVER (), 1) AS percentage FROM ({calls})"
    o["n2_sort_by_measure"] = f"{calls} ORDER BY calls DESC, api_action"
    o["n3_sort_by_time"] = "SELECT event_time, event_id FROM api_audit_trail ORDER BY event_time DESC NULLS LAST, event_id"
    o["n4_top_n"] = _top("SELECT user_name, count(*) AS calls FROM api_audit_trail GROUP BY user_name", "calls", "user_name", 12)
    # V
    o["v1_time_range"] = "SELECT event_time, event_id FROM d_audit WHERE event_time IS NULL OR event_time BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-20 12:00:00'"
    o["v2_category_filter"] = "SELECT event_time, source_name, source_type FROM d_index WHERE source_type = 'KB'"
    o["v3_last_30_days"] = "SELECT event_time, conversation_id FROM d_chat WHERE event_time BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-02-09 12:00:00'"
    o["v1_snapshot_time_range"], o["v3_snapshot_last_30_days"] = o["v1_time_range"], o["v3_last_30_days"]
    o["v4_click_through"] = f"SELECT event_time, feature, conversation_id FROM d_chat WHERE {_DAY} = DATE '2024-01-09' AND feature = 'Flow'"
    busiest = _top("SELECT user_name, feature, count(*) AS n FROM d_chat GROUP BY ALL", "n", "user_name, feature", 20)
    o["v4_click_through_many"] = f"SELECT user_name, feature, conversation_id, event_time FROM d_chat SEMI JOIN ({busiest}) USING (user_name, feature)"
    for key, spec in _DRILLS.items():
        o[f"v5_drill_{key}"] = _drill(*spec)
    levels = (("NULL", "NULL", "NULL", ""), (_DAY, "NULL", "NULL", "GROUP BY 1"), (_DAY, "feature", "NULL", "GROUP BY 1, 2"), (_DAY, "feature", "surface_type", "GROUP BY 1, 2, 3"))
    o["v5_drill_average"] = " UNION ALL ".join(
        f"SELECT CAST({a} AS DATE) AS day, CAST({b} AS VARCHAR) AS feature, CAST({c} AS VARCHAR) AS surface_type, {i} AS level, avg(latency_ms) AS latency_ms FROM d_chat {g}"
        for i, (a, b, c, g) in enumerate(levels)
    )
    # M
    users, sessions = "count(DISTINCT user_name) AS unique_users", "count(DISTINCT conversation_id) AS chat_sessions"
    hours, api = "sum(hours) AS agent_hours", "count(api_action) AS api_calls"
    source_gb = f"{_gb('consumed_source_size_gb')} AS source_size_gb"
    index_gb = f"{_gb('consumed_index_size_gb')} AS index_size_gb"

    def by(frame: str, measure: str, *keys: str, where: str = "true") -> str:
        return f"SELECT {', '.join([*keys, measure])} FROM {frame} WHERE {where} GROUP BY ALL"

    day = f"{_DAY} AS day"
    o["m01_active_users"] = f"SELECT {users} FROM d_chat"
    o["m02_total_chat_sessions"] = f"SELECT {sessions} FROM d_chat"
    o["m03_user_adoption_trend"] = by("d_chat", users, day)
    o["m04_chat_sessions_by_feature"] = by("d_chat", sessions, "feature")
    o["m05_top_users_by_chat_sessions"] = by("d_chat", sessions, "user_name")
    o["m06_feature_adoption_over_time"] = by("d_chat", sessions, day, "feature")
    o["m07_sessions_by_status"] = by("d_chat", sessions, "status")
    o["m08_chat_session_details"] = "SELECT event_time, user_name, feature, status, conversation_id, latency_ms, surface_type FROM d_chat"
    o["m09_total_agent_hours"] = f"SELECT {hours} FROM d_hours"
    o["m10_agent_hours_by_service"] = by("d_hours", hours, "service")
    o["m11_top_users_by_agent_hours"] = by("d_hours", hours, "user_name")
    o["m12_included_vs_extra_hours"] = by("d_hours", hours, "usage_group")
    o["m13_agent_hours_trend_by_service"] = by("d_hours", hours, day, "service")
    o["m14_agent_hours_details"] = "SELECT event_time, user_name, service, hours, usage_group, resource_type, resource_id FROM d_hours"
    o["m15_satisfaction_distribution"] = by("d_feedback", "count(feedback_type) AS feedback_responses", "feedback_type")
    o["m16_top_feedback_reasons"] = by("d_feedback", "count(reason) AS feedback_responses", "reason")
    o["m17_feedback_details"] = "SELECT user_name, feedback_type, feedback_source, reason, details FROM d_feedback"
    o["m18_api_activity_by_feature"] = by("d_audit", api, "api_feature")
    o["m19_api_callers_by_identity_type"] = by("d_audit", api, "user_type")
    o["m20_recent_api_operations"] = "SELECT event_time, event_id, api_action, api_feature, user_name, user_type, read_or_write, resource_arn, error_code FROM d_audit"
    o["m21_total_index_size_gb"] = f"SELECT {index_gb} FROM d_index"
    o["m22_storage_by_source_type"] = by("d_index", source_gb, "source_type")
    o["m23_index_storage_trend"] = by("d_index", index_gb, day)
    o["m24_top_knowledge_bases_by_size"] = by("d_index", source_gb, "source_name", where="source_type = 'KB'")
    o["m25_top_spaces_by_size"] = by("d_index", source_gb, "source_name", where="source_type = 'SPACE'")
    o["m26_top_users_by_storage"] = by("d_index", source_gb, "user_name")
    o["m27_all_sources_detail"] = "SELECT event_time, source_name, source_type, source_arn, consumed_source_size_gb, consumed_source_doc_count, consumed_index_size_gb, user_name FROM d_index"
    # R
    o["r1_daily_adoption"] = f"SELECT {day}, count(DISTINCT user_name) AS active_users, count(DISTINCT conversation_id) AS sessions FROM chat_activity GROUP BY 1"
    o["r2_satisfaction"] = "SELECT satisfaction, count, round(100.0::DOUBLE * count / sum(count) OVER (), 1) AS percentage FROM (SELECT satisfaction, count(*) AS count FROM feedback_analysis GROUP BY 1)"
    o["r3_hours_by_service"] = "SELECT service, usage_group, sum(hours) AS total_hours, count(DISTINCT user_name) AS users FROM agent_hours_usage GROUP BY ALL"
    o["r4_api_activity"] = "SELECT api_feature, read_or_write, count(*) AS count FROM api_audit_trail GROUP BY ALL"
    o["r5_largest_sources"] = """SELECT source_name, source_type, max(consumed_index_size_gb) AS total_index_size_gb, max(consumed_source_size_gb) AS source_size_gb,
  max(consumed_source_doc_count) AS doc_count FROM index_usage GROUP BY ALL"""
    # T
    o["t1_catalog"] = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{role}' AS role, count(*) AS row_count, CAST({n} AS BIGINT) AS columns FROM {frame}"
        for name, frame, measures, dims in _CATALOG_COUNTS
        for role, n in (("MEASURE", measures), ("DIMENSION", dims))
        if n
    )
    filled = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, column_name, filled FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {frame}) ON COLUMNS(*) INTO NAME column_name VALUE filled)"
        for name, frame in _FRAMES.items()
    )
    o["t1_catalog_columns"] = f"SELECT * FROM (VALUES {catalog_sql.ROWS}) AS c({catalog_sql.COLUMNS}) JOIN ({filled}) USING (dataset, column_name)"
    o["t2_default_aggregation"] = """SELECT surface_type, count(DISTINCT conversation_id) AS conversation_id_distinct_count, avg(latency_ms) AS latency_ms_average,
  avg(time_to_first_token_ms) AS time_to_first_token_ms_average, count(status) AS status_count FROM d_chat GROUP BY surface_type"""
    o["t3_default_date"] = f"SELECT {day}, sum(hours) AS hours_sum FROM d_hours GROUP BY 1"
    o["t4_synonyms"] = f"""SELECT user_name, source_type, CAST(sum(consumed_source_doc_count) AS BIGINT) AS consumed_source_doc_count_sum,
  {_gb('consumed_source_size_gb')} AS consumed_source_size_gb_sum FROM d_index GROUP BY ALL"""
    o["t5_shown_columns"] = "SELECT * EXCLUDE (account_id) FROM d_feedback"
    domains = [
        ("d_chat", "feature", "('System Chat Agent (My Assistant)', 'Custom Chat Agent', 'Flow')"),
        ("d_chat", "status", "('success', 'request_blocked', 'no_answer_found')"),
        ("d_chat", "message_scope", "('no_resources', 'all_resources', 'specific_resource')"),
        ("d_feedback", "reason", "('Inaccurate', 'Incomplete', 'Too wordy', 'Too slow')"),
        ("d_hours", "service", "('RESEARCH', 'FLOW', 'AUTOMATION', 'CHAT')"),
        ("d_hours", "usage_group", "('Included', 'Extra')"),
        ("d_feedback", "feedback_type", "('Useful', 'Not Useful')"),
        ("d_index", "source_type", "('SPACE', 'KB')"),
        ("d_audit", "read_or_write", "('Read', 'Write')"),
    ]
    o["t6_label_domains"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS label, count(*) AS row_count, coalesce({c} IN {known}, false) AS known FROM {frame} GROUP BY {c}"
        for frame, c, known in domains
    )
    # X
    o["x01_top_users_by_hours"] = _top("SELECT user_name, sum(hours) AS hours FROM d_hours GROUP BY 1", "hours", "user_name", 10)
    o["x01_top_users_by_sessions"] = _top("SELECT user_name, count(DISTINCT conversation_id) AS sessions FROM d_chat GROUP BY 1", "sessions", "user_name", 10)
    o["x01_top_users_by_activity"] = _top("SELECT user_name, count(*) AS calls FROM d_audit GROUP BY 1", "calls", "user_name", 10)
    uses = "SELECT api_feature, count(*) AS uses FROM d_audit GROUP BY 1"
    o["x02_feature_extremes"] = " UNION ALL ".join(
        f"SELECT '{side}' AS side, * FROM ({_top(uses, 'uses', 'api_feature', 10, way)})" for side, way in (("most", "DESC"), ("least", "ASC"))
    )

    def change(body: str, period: str, value: str, step: str) -> str:
        return f"""WITH p AS ({body}) SELECT p.{period}, p.{value}, b.{value} AS previous, p.{value} - b.{value} AS change,
  round(100.0::DOUBLE * (p.{value} - b.{value}) / nullif(b.{value}, 0), 1) AS change_percent
FROM p LEFT JOIN p b ON b.{period} = p.{period} - INTERVAL {step}"""

    week = "SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, count(DISTINCT conversation_id) AS sessions FROM d_chat WHERE event_time IS NOT NULL GROUP BY 1"
    month = "SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, sum(hours) AS hours FROM d_hours WHERE event_time IS NOT NULL GROUP BY 1"
    o["x03_week_over_week"] = change(week, "week", "sessions", "7 DAY")
    o["x04_month_over_month"] = change(month, "month", "hours", "1 MONTH")
    o["x05_latency_percentiles"] = "SELECT feature, quantile_disc(latency_ms, 0.5) AS p50_latency_ms, quantile_disc(latency_ms, 0.95) AS p95_latency_ms FROM d_chat GROUP BY feature"
    o["x05_latency"] = """SELECT feature, avg(latency_ms) AS avg_latency_ms, avg(time_to_first_token_ms) AS avg_time_to_first_token_ms,
  count(latency_ms) AS measured FROM d_chat GROUP BY feature"""
    o["x06_overage"] = """SELECT service, sum(hours) AS total_hours, sum(if(usage_group = 'Extra', hours, 0.0::DOUBLE)) AS extra_hours,
  sum(if(usage_group = 'Extra', hours, 0.0::DOUBLE)) / sum(hours) AS overage_share FROM d_hours GROUP BY service"""
    o["x07_satisfaction_score"] = """SELECT feedback_source, count(feedback_type) AS responses, count(*) FILTER (feedback_type = 'Useful') AS useful,
  count(*) FILTER (feedback_type = 'Useful') / count(feedback_type) AS score FROM d_feedback GROUP BY 1"""
    o["x07_reason_themes"] = "SELECT reason, feedback_type, count(*) AS responses FROM d_feedback WHERE reason IS NOT NULL GROUP BY ALL"

    def errors(key: str) -> str:
        return f"SELECT {key}, count(*) AS calls, count(*) FILTER ({_FAILED}) AS errors, avg(CAST({_FAILED} AS INT)) AS error_rate FROM d_audit GROUP BY 1"

    o["x08_error_rate"] = errors("api_feature")
    o["x08_failure_patterns"] = _top(f"SELECT api_action, error_code, count(*) AS errors FROM d_audit WHERE {_FAILED} GROUP BY ALL", "errors", "api_action, error_code", 10)
    o["x09_storage_by_type"] = f"SELECT source_type, {_gb('source_size_gb')} AS size_gb, count(*) AS sources FROM latest_sources GROUP BY 1"
    o["x10_document_growth"] = """SELECT source_name, day, doc_count, lag(doc_count) OVER w AS previous_docs, doc_count - lag(doc_count) OVER w AS growth
FROM source_days WINDOW w AS (PARTITION BY source_arn, source_name, source_type ORDER BY day)"""
    o["x11_underused_features"] = f"SELECT * FROM (SELECT api_feature, uses, uses / sum(uses) OVER () AS share FROM ({uses})) WHERE share < 0.04"

    def drift(body: str, part: str, whole: str) -> str:
        return f"""SELECT *, ratio - trailing_ratio AS drift FROM (SELECT *, {part} / nullif({whole}, 0) AS ratio,
  sum({part}) OVER w / nullif(sum({whole}) OVER w, 0) AS trailing_ratio FROM ({body})
  WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))"""

    o["x12_latency_drift"] = drift(
        f"SELECT {day}, sum(latency_ms) AS latency_sum, count(latency_ms) AS measured FROM d_chat WHERE event_time IS NOT NULL GROUP BY 1", "latency_sum", "measured"
    )
    o["x12_error_drift"] = drift(
        f"SELECT {day}, count(*) AS calls, count(*) FILTER ({_FAILED}) AS errors FROM d_audit WHERE event_time IS NOT NULL GROUP BY 1", "errors", "calls"
    )
    o["x13_index_size_by_day"] = f"SELECT {day}, max(consumed_index_size_gb) AS index_size_gb FROM d_index GROUP BY 1"
    o["x13_current_index_size"] = f"SELECT {day}, max(consumed_index_size_gb) AS index_size_gb FROM d_index GROUP BY 1 ORDER BY 1 DESC LIMIT 1"
    o["x14_power_users"] = """SELECT * FROM (SELECT *, percent_rank() OVER (ORDER BY sessions) AS percent_rank
FROM (SELECT user_name, count(DISTINCT conversation_id) AS sessions FROM d_chat WHERE user_name IS NOT NULL GROUP BY 1)) WHERE percent_rank >= 0.9"""
    o["x15_near_limit"] = "SELECT source_name, source_type, source_size_gb, source_size_gb / 0.05::DOUBLE AS used_share FROM latest_sources WHERE source_size_gb / 0.05::DOUBLE >= 0.8"
    o["x16_idle_sources"] = f"""SELECT * FROM (SELECT source_name, doc_count, coalesce(n, 0) AS calls, coalesce(n, 0) / doc_count AS calls_per_doc FROM latest_sources
  LEFT JOIN (SELECT resource_arn AS source_arn, count(*) AS n FROM d_audit WHERE {_named('resource_arn')} GROUP BY 1) USING (source_arn) WHERE doc_count >= 5)
WHERE calls_per_doc <= 3.2"""
    o["x17_web_search_usage"] = """SELECT web_search, count(*) AS messages, count(DISTINCT conversation_id) AS sessions, count(DISTINCT user_name) AS users
FROM d_chat GROUP BY 1"""
    o["x18_regional_calls"] = errors("aws_region")
    # G, Q
    turn = "CAST(conv_id AS VARCHAR) AS conversation_id, CAST(turn AS VARCHAR) AS system_message_id"
    o["g1_restricted_view"] = f"SELECT {turn}, 28 AS n_columns FROM conversations"
    o["g2_mask_documents"] = _mask_sql("documents", "doc_id", _MASKED)
    o["g2_mask_all_patterns"] = _mask_sql("conversations", "conv_id, turn", _RE2)
    o["g2_pattern_hits"] = f"SELECT source, {_HITS} FROM documents GROUP BY source"
    o["g3_content_opt_in"] = f"SELECT {turn}, if(role = 'user', text, NULL) AS user_message, if(role = 'user', NULL, text) AS system_text_message FROM conversations"
    o["g4_use_curated"] = o["r3_hours_by_service"]
    o["q1_ingest_report"] = f"SELECT kind, result, count(*) AS records FROM ({routed}) GROUP BY ALL"
    o["q1_ingest_days"] = f"""SELECT DATE '2024-02-01' AS day, count(*) FILTER (result = 'Ok') AS ok, count(*) FILTER (result = 'Dropped') AS dropped,
  count(*) FILTER (result = 'ProcessingFailed') AS failed, (SELECT count(*) FROM delivered WHERE reason IS NOT NULL) AS unparseable,
  (SELECT count(*) FROM events WHERE event_id % 50 = 0) AS quarantined FROM ({routed})"""
    o["q1_audit_days"] = """SELECT DATE '2024-02-01' AS day, count(*) FILTER (valid AND watched) AS ok, count(*) FILTER (valid AND NOT watched) AS dropped,
  count(*) FILTER (NOT valid) AS failed, CAST(0 AS BIGINT) AS unparseable, CAST(0 AS BIGINT) AS quarantined
FROM (SELECT event_id % 43 <> 0 AND event_id % 41 <> 0 AS valid, event_id % 13 <> 0 AND event_id % 17 <> 0 AS watched FROM events)"""
    o["q1_unparseable"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS bad_rows FROM chat_logs"
        for c, t in (("timestamp", "TIMESTAMP"), ("latency", "DOUBLE"), ("time_to_first_token", "DOUBLE"))
    )
    o["q2_outside_domain"] = "SELECT resource_type, count(*) AS row_count FROM d_hours WHERE resource_type NOT IN ('RESEARCH', 'FLOW', 'AUTOMATION', 'CHAT') GROUP BY 1"
    # P
    o["p1_stream_chat_feed"] = f"""SELECT {_ISO_SECONDS} AS timestamp, {_MESSAGE_TYPE} AS message_type, {_member('user_arn')} AS user_arn, {_member('conversation_id')} AS conversation_id,
  coalesce({_member('accountId')}, {_member('account_id')}) AS account_id, TRY_CAST({_member('event_timestamp')} AS BIGINT) AS event_timestamp
FROM delivered WHERE reason IS NULL"""
    o["p1_stream_audit_feed"] = """SELECT event_id, timestamp, user_name, resource_type, 2024 AS year, 2 AS month, 1 AS day FROM flat_audit
WHERE CAST(event_id[5:] AS BIGINT) % 13 <> 0 AND CAST(event_id[5:] AS BIGINT) % 17 <> 0"""
    for key, table in (("feedback", "feedback_logs"), ("hours", "agent_hours_logs"), ("index", "index_usage_logs")):
        o[f"p1_stream_{key}_feed"] = f"SELECT * EXCLUDE (year, month, day) FROM {table}"
    o["p1_passthrough"] = o["i10_passthrough"]
    o["p2_arrival_days"] = "SELECT 2024 AS year, 2 AS month, 1 AS day, count(*) AS row_count FROM delivered WHERE reason IS NULL"
    o["p3_failure_stream"] = "SELECT 'b' || batch AS record_id, kind AS reason FROM batches WHERE kind = 'unreadable' UNION ALL SELECT 'b' || batch, reason FROM delivered WHERE reason IS NOT NULL"
    o["p4_scheduled_refresh"] = "SELECT * FROM feedback_logs"
    o["p5_deduplicate"] = "SELECT event_id, event_type FROM events"
    o["p6_daily_calls"] = """SELECT CAST(ts AS DATE) AS day, count(*) AS calls FROM events GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""
    o["p6_daily_active_users"] = """SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS active_users FROM events GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""
    return o


def oracle_sql() -> dict[str, str]:
    return {key: sql(body) for key, body in _oracle().items()}
