"""Checks of the ingest round trips: what the log itself says."""

_MS = "coalesce(turn_around_time_ms + transfer_time_ms, 0) / 1000.0"
_EXT = "user_id % 3 = 0"

SQL = {
    "cdn_lines_parsed": """SELECT CAST(req_id AS VARCHAR) AS req_id, date_trunc('second', request_timestamp) AS request_timestamp, cli_ip, status_code, req_path,
        user_agent, bytes, CAST(turn_around_time_ms AS BIGINT) AS turn_around_time_ms, country, error_code, nullif(ew_execution_info, '') AS ew_execution_info
        FROM access_logs WHERE req_id % 50 <> 0""",
    "cdn_lines_split": "SELECT if(req_id % 50 = 0, 'quarantine', 'good') AS part, count(*) AS lines FROM access_logs GROUP BY 1",
    "cdn_schema_from_spec": """SELECT status_code AS "statusCode", cache_status AS "cacheStatus", count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes,
        count(DISTINCT req_id) AS ids FROM access_logs GROUP BY 1, 2""",
    "queue_json_decoded": """SELECT req_path AS endpoint, req_method AS method, status_code AS status, count(*) AS messages,
        round(sum(ttfb_ms) / 1000.0, 3) AS response_time, date_trunc('second', max(request_timestamp)) AS newest
        FROM access_logs WHERE req_id % 70 <> 0 GROUP BY 1, 2, 3""",
    "queue_json_split": "SELECT if(req_id % 70 = 0, 'rejected', 'decoded') AS part, count(*) AS messages FROM access_logs GROUP BY 1",
    "bundle_logs": """SELECT user_id, if(user_id % 2 = 1, '{"req_id":' || req_id || ',"req_path":"' || req_path || '"}', req_id || ' ' || req_path) AS log,
        if(user_id % 2 = 1, 'json', 'text') AS format FROM access_logs""",
    "combined_lines_parsed": f"""SELECT req_id, cli_ip AS ip, req_method AS method, req_path AS endpoint, status_code AS status, CAST(bytes AS INT) AS size,
        {_MS} AS response_time, if({_EXT}, country, NULL) AS region, if({_EXT}, CAST(user_id AS VARCHAR), NULL) AS user_id,
        if({_EXT}, session_id, NULL) AS session_id, if({_EXT}, 'p' || user_id % 4, NULL) AS plan, CAST(if({_EXT}, 1, 0) AS INT) AS custom,
        CAST(if({_EXT}, 2, 1) AS INT) AS schema_version, date_trunc('second', request_timestamp) AS event_timestamp FROM access_logs WHERE req_id % 60 <> 0""",
    "combined_lines_rejected": "SELECT req_id, 'garbage in the log' AS line, 'Invalid log format' AS error FROM access_logs WHERE req_id % 60 = 0",
    "line_versions": f"""SELECT CAST(CASE WHEN req_id % 60 = 0 THEN 0 WHEN {_EXT} THEN 2 ELSE 1 END AS INT) AS version, req_id % 60 <> 0 AS valid, count(*) AS lines
        FROM access_logs GROUP BY 1, 2""",
    "missing_fields": """SELECT CASE WHEN req_id % 11 = 0 THEN 'ip is required' WHEN req_id % 13 = 0 THEN 'timestamp is required'
        WHEN req_id % 17 = 0 THEN 'endpoint is required' ELSE 'none' END AS error, count(*) AS rows FROM access_logs GROUP BY 1""",
    "retyped_fields": "SELECT req_id, status_code AS status, country FROM access_logs",
    "parse_failure_rate": """SELECT count(*) FILTER (WHERE req_id % 60 <> 0) AS parsed, count(*) FILTER (WHERE req_id % 60 = 0) AS failed,
        count(*) FILTER (WHERE req_id % 60 = 0) > 0.01 * count(*) FILTER (WHERE req_id % 60 <> 0) AS too_many FROM access_logs""",
    "schema_version_mix": f"SELECT if({_EXT}, 'v2', 'v1') AS schema_version, count(*) AS records FROM access_logs WHERE req_id % 60 <> 0 GROUP BY 1",
}
