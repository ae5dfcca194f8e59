"""The semantic catalog as SQL rows: what `t1_catalog_columns` must give, stated apart from the library."""

COLUMNS = "dataset, column_name, label, description, role, aggregation, meaning, synonyms, data_type, shown"
ROWS = """
('chat-activity', 'event_time', 'Event Time', 'Timestamp of the chat message', 'DIMENSION', NULL, 'DATE', 'date, time, when, timestamp, message date', 'timestamp_ntz', true),
('chat-activity', 'user_name', 'User', 'Name of the user who sent the message', 'DIMENSION', NULL, 'PERSON', 'person, employee, who, sender', 'string', true),
('chat-activity', 'feature', 'Feature', 'Which feature was used: Chat Agent, Flow, Automation, or Direct Chat', 'DIMENSION', NULL, 'CATEGORY', 'product, capability, feature type, what feature', 'string', true),
('chat-activity', 'status', 'Status', 'Response status code (success, request_blocked, no_answer_found)', 'DIMENSION', NULL, 'CATEGORY', 'result, outcome, status code', 'string', true),
('chat-activity', 'conversation_id', 'Conversation', 'Unique conversation identifier', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'chat, session, thread', 'string', true),
('chat-activity', 'agent_id', 'Chat Agent', 'Chat agent that handled the message', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'bot, assistant, agent, q agent', 'string', true),
('chat-activity', 'flow_id', 'Flow', 'Flow identifier used in the conversation', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'workflow, flow', 'string', true),
('chat-activity', 'action_connectors', 'Action Connector', 'Automation action connector invoked during the conversation', 'DIMENSION', NULL, NULL, 'automation, connector, action', 'string', true),
('chat-activity', 'latency_ms', 'Latency (ms)', 'End-to-end response latency in milliseconds', 'MEASURE', 'AVERAGE', 'DURATION', 'response time, delay, speed, how long, duration', 'double', true),
('chat-activity', 'time_to_first_token_ms', 'Time to First Token (ms)', 'Time until the first response token in milliseconds', 'MEASURE', 'AVERAGE', 'DURATION', 'ttft, first token, initial response time', 'double', true),
('chat-activity', 'surface_type', 'Surface Type', 'Where the chat originated (console, IDE, etc.)', 'DIMENSION', NULL, 'CATEGORY', 'channel, interface, source, origin', 'string', true),
('chat-activity', 'web_search', 'Web Search Used', 'Whether web search was used for the response', 'DIMENSION', NULL, 'CATEGORY', 'internet, web, search', 'string', true),
('chat-activity', 'message_scope', 'Message Scope', 'Resource scope of the message: no_resources, all_resources, or specific_resource', 'DIMENSION', NULL, 'CATEGORY', 'scope, resource scope, context', 'string', true),
('chat-activity', 'namespace', 'Namespace', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('chat-activity', 'account_id', 'Account Id', NULL, 'DIMENSION', NULL, NULL, '', 'string', false),
('feedback-analysis', 'event_time', 'Event Time', 'When the feedback was submitted', 'DIMENSION', NULL, 'DATE', 'date, time, when, timestamp', 'timestamp_ntz', true),
('feedback-analysis', 'user_name', 'User', 'User who submitted feedback', 'DIMENSION', NULL, 'PERSON', 'person, employee, who, reviewer', 'string', true),
('feedback-analysis', 'feedback_source', 'Feedback Source', 'Whether feedback is for Research or Chat', 'DIMENSION', NULL, 'CATEGORY', 'source, from research, from chat', 'string', true),
('feedback-analysis', 'reason', 'Reason', 'Reason selected for the feedback', 'DIMENSION', NULL, 'CATEGORY', 'why, cause, feedback reason', 'string', true),
('feedback-analysis', 'details', 'Details', 'Free-text feedback details written by the user', 'DIMENSION', NULL, NULL, 'comment, note, text, written feedback', 'string', true),
('feedback-analysis', 'rating', 'Rating', 'Numeric rating if provided', 'DIMENSION', NULL, NULL, 'score, stars, numeric rating', 'string', true),
('feedback-analysis', 'status', 'Status', 'Response status code for the feedback event', 'DIMENSION', NULL, 'CATEGORY', 'result, outcome, status code', 'string', true),
('feedback-analysis', 'conversation_id', 'Conversation', 'Conversation the feedback relates to', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'chat, session, thread', 'string', true),
('feedback-analysis', 'research_id', 'Research ID', 'Research session the feedback relates to', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'research, research session', 'string', true),
('feedback-analysis', 'namespace', 'Namespace', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('feedback-analysis', 'account_id', 'Account Id', NULL, 'DIMENSION', NULL, NULL, '', 'string', false),
('feedback-analysis', 'feedback_type', 'Feedback Type', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('agent-hours-usage', 'event_time', 'Event Time', 'When the usage was recorded', 'DIMENSION', NULL, 'DATE', 'date, time, when, timestamp', 'timestamp_ntz', true),
('agent-hours-usage', 'user_name', 'User', 'User consuming agent hours', 'DIMENSION', NULL, 'PERSON', 'person, employee, who, consumer', 'string', true),
('agent-hours-usage', 'subscription_type', 'Subscription', 'Subscription tier (Pro, Reader, etc.)', 'DIMENSION', NULL, 'CATEGORY', 'plan, tier, license', 'string', true),
('agent-hours-usage', 'service', 'Service', 'Service consuming hours: Research, Chat, Automation, Flows, etc.', 'DIMENSION', NULL, 'CATEGORY', 'product, feature, reporting service, research, chat, automation, flows', 'string', true),
('agent-hours-usage', 'usage_group', 'Usage Group', 'Whether hours are included or extra', 'DIMENSION', NULL, 'CATEGORY', 'included, extra, overage, billing group', 'string', true),
('agent-hours-usage', 'hours', 'Hours', 'Number of agent hours consumed', 'MEASURE', 'SUM', NULL, 'usage, consumption, time used, agent hours, cost', 'double', true),
('agent-hours-usage', 'resource_type', 'Resource Type', 'Service consuming hours: Automation, Flow, Research', 'DIMENSION', NULL, 'CATEGORY', 'resource, asset, service type', 'string', true),
('agent-hours-usage', 'resource_id', 'Resource ID', 'Specific resource identifier consuming hours', 'DIMENSION', 'DISTINCT_COUNT', NULL, 'resource name, resource id', 'string', true),
('agent-hours-usage', 'service_resource_arn', 'Service Resource Arn', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('agent-hours-usage', 'account_id', 'Account Id', NULL, 'DIMENSION', NULL, NULL, '', 'string', false),
('api-audit-trail', 'event_time', 'Event Time', 'When the API call occurred', 'DIMENSION', NULL, 'DATE', 'date, time, when, timestamp', 'timestamp_ntz', true),
('api-audit-trail', 'event_id', 'Event ID', 'Unique event identifier of the audit trail, for cross-referencing', 'DIMENSION', NULL, NULL, 'event id, trail id, cloudtrail id', 'string', true),
('api-audit-trail', 'api_action', 'API Action', 'API operation called (CreateDashboard, DescribeDataSet, etc.)', 'DIMENSION', NULL, 'CATEGORY', 'operation, action, event, api call, method', 'string', true),
('api-audit-trail', 'event_source', 'Event Source', 'Service that generated the event', 'DIMENSION', NULL, 'CATEGORY', 'source service, aws service', 'string', true),
('api-audit-trail', 'user_name', 'Caller', 'IAM user or role that made the call', 'DIMENSION', NULL, 'PERSON', 'who, user, caller, identity, principal', 'string', true),
('api-audit-trail', 'source_ip', 'Source IP', 'IP address the call originated from', 'DIMENSION', NULL, 'IP_ADDRESS', 'ip, ip address, origin, client ip', 'string', true),
('api-audit-trail', 'aws_region', 'Region', 'AWS region where the API call was made', 'DIMENSION', NULL, 'CATEGORY', 'region, location', 'string', true),
('api-audit-trail', 'error_code', 'Error Code', 'Error code if the call failed', 'DIMENSION', NULL, 'CATEGORY', 'error, failure, exception', 'string', true),
('api-audit-trail', 'read_or_write', 'Read or Write', 'Whether the API call was read-only or a write operation', 'DIMENSION', NULL, 'CATEGORY', 'read, write, mutation', 'string', true),
('api-audit-trail', 'resource_type', 'Resource Type', 'Type of resource affected (dashboard, dataset, analysis, etc.)', 'DIMENSION', NULL, 'CATEGORY', 'resource, asset type', 'string', true),
('api-audit-trail', 'resource_arn', 'Resource ARN', 'ARN of the primary resource affected', 'DIMENSION', NULL, NULL, 'arn, resource', 'string', true),
('api-audit-trail', 'request_parameters', 'Request Parameters', 'JSON payload of the API call showing what was requested', 'DIMENSION', NULL, NULL, 'parameters, payload, request, what changed', 'string', true),
('api-audit-trail', 'recipient_account_id', 'Recipient Account', 'Account that received the event (for cross-account scenarios)', 'DIMENSION', NULL, NULL, 'recipient, target account, cross account', 'string', true),
('api-audit-trail', 'user_agent', 'User Agent', 'Client user agent string (SDK, console, CLI)', 'DIMENSION', NULL, NULL, 'client, sdk, tool', 'string', true),
('api-audit-trail', 'error_message', 'Error Message', 'Detailed error message if the API call failed', 'DIMENSION', NULL, NULL, 'error detail, failure message, what went wrong', 'string', true),
('api-audit-trail', 'api_feature', 'API Feature', 'Feature category of the API call: Dashboard, Space, Knowledge Base, Dataset, Topic, etc.', 'DIMENSION', NULL, 'CATEGORY', 'feature, category, what feature, space, knowledge base, dashboard', 'string', true),
('api-audit-trail', 'user_type', 'User Type', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('api-audit-trail', 'event_type', 'Event Type', NULL, 'DIMENSION', NULL, NULL, '', 'string', true),
('api-audit-trail', 'account_id', 'Account Id', NULL, 'DIMENSION', NULL, NULL, '', 'string', false),
('index-usage', 'event_time', 'Event Time', 'Timestamp of the index usage measurement', 'DIMENSION', NULL, 'DATE', 'date, time, when, timestamp, measurement date', 'timestamp_ntz', true),
('index-usage', 'consumed_index_size_gb', 'Index Size (GB)', 'Total consumed index size in gigabytes', 'MEASURE', 'SUM', NULL, 'index size, total size, index gb, storage size, index storage', 'double', true),
('index-usage', 'consumed_source_size_gb', 'Source Size (GB)', 'Size consumed by this source in gigabytes', 'MEASURE', 'SUM', NULL, 'source size, source gb, kb size, space size, data size', 'double', true),
('index-usage', 'consumed_source_doc_count', 'Document Count', 'Number of documents from this source', 'MEASURE', 'SUM', NULL, 'docs, documents, doc count, number of documents, file count', 'bigint', true),
('index-usage', 'source_type', 'Source Type', 'Type of source: KB (Knowledge Base) or SPACE', 'DIMENSION', NULL, 'CATEGORY', 'type, kb or space, knowledge base, space, source category', 'string', true),
('index-usage', 'source_name', 'Source Name', 'Human-readable name of the knowledge base or Space', 'DIMENSION', NULL, NULL, 'name, kb name, space name, source, resource name', 'string', true),
('index-usage', 'source_arn', 'Source ARN', 'Full ARN of the source resource', 'DIMENSION', NULL, NULL, 'arn, resource arn, source resource', 'string', true),
('index-usage', 'user_name', 'User', 'User associated with the index usage event', 'DIMENSION', NULL, 'PERSON', 'person, employee, who, owner', 'string', true),
('index-usage', 'account_id', 'Account Id', NULL, 'DIMENSION', NULL, NULL, '', 'string', false)
"""
