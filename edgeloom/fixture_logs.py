"""Derivation of the canonical access log from the ``events`` table.

The text is valid in Spark SQL and in DuckDB, so query and check read the same rows.
Integer arithmetic throughout, apart from one rounding of ``value``.
"""

ACCESS_LOGS_SELECT = """
SELECT
  event_id                                           AS req_id,
  ts                                                 AS request_timestamp,
  user_id                                            AS user_id,
  concat('s', user_id, '-', CAST(ts AS DATE))        AS session_id,
  concat('203.0.', user_id % 5, '.', user_id % 251)  AS cli_ip,
  CASE user_id % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'BR' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' WHEN 4 THEN 'GB'
       WHEN 5 THEN 'IN' WHEN 6 THEN 'JP' WHEN 7 THEN 'AU' WHEN 8 THEN 'CA' ELSE 'ZA' END AS country,
  concat('city-', user_id % 30)                      AS city,
  CASE WHEN event_type IN ('signup','purchase') THEN 'POST' ELSE 'GET' END AS req_method,
  CASE WHEN event_id % 4 = 0 THEN 'api.example.com' ELSE 'www.example.com' END AS req_host,
  CASE event_type
    WHEN 'view' THEN CASE event_id % 6 WHEN 0 THEN '/' WHEN 1 THEN '/static/images/hero.jpg' WHEN 2 THEN '/video/stream.m3u8'
                     WHEN 3 THEN '/static/css/style.css' WHEN 4 THEN '/product/42.html' ELSE '/search' END
    WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN '/cart' WHEN 1 THEN '/static/js/app.js' ELSE '/api/products/7' END
    WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN '/signup' WHEN 1 THEN '/signup/verify-email' WHEN 2 THEN '/signup/payment' ELSE '/signup/complete' END
    WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN '/checkout' WHEN 1 THEN '/payment' ELSE '/confirmation' END
    ELSE CASE event_id % 4 WHEN 0 THEN '/api/checkout' WHEN 1 THEN '/api/search' WHEN 2 THEN '/static/missing.png' ELSE '/health' END
  END AS req_path,
  concat('q=user%20', user_id, '%2Fitem%26n%3D', event_id % 50) AS query_str,
  CAST(CASE WHEN event_type = 'error' THEN CASE event_id % 6 WHEN 0 THEN 400 WHEN 1 THEN 401 WHEN 2 THEN 403 WHEN 3 THEN 404 WHEN 4 THEN 429 ELSE 503 END
       WHEN event_id % 10 = 0 THEN 304 WHEN event_id % 10 = 1 THEN 206 ELSE 200 END AS INT) AS status_code,
  CASE WHEN event_type = 'error' THEN CASE event_id % 2 WHEN 0 THEN 'ERR_ACCESS_DENIED' ELSE 'ERR_READ_TIMEOUT' END END AS error_code,
  CAST(round(value * 1000) AS BIGINT)                AS bytes,
  CAST((event_id * 3571) % 500000 AS BIGINT)         AS obj_size,
  CAST(CASE WHEN event_id % 97 <> 0 THEN (event_id * 7919) % 1500 END AS INT) AS turn_around_time_ms,
  CAST((event_id * 104729) % 800 AS INT)             AS transfer_time_ms,
  CAST((event_id * 1299709) % 3000 AS BIGINT)        AS ttfb_ms,
  CAST((event_id * 611953) % 4000 AS BIGINT)         AS download_time_ms,
  CAST((event_id * 15485863) % 60000000 AS BIGINT)   AS throughput_bps,
  CAST(CASE WHEN (event_id * 31) % 10 < 7 THEN 1 ELSE 0 END AS INT) AS cache_status,
  CAST(CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 3600 WHEN 2 THEN 86400 ELSE 604800 END AS INT) AS max_age_sec,
  CASE user_id % 7 WHEN 0 THEN 'Mozilla/5.0 (iPhone) Mobile Safari' WHEN 1 THEN 'Mozilla/5.0 (Linux; Android) Mobile Chrome'
       WHEN 2 THEN 'Mozilla/5.0 (Windows) Chrome Safari' WHEN 3 THEN 'Mozilla/5.0 (X11) Firefox' WHEN 4 THEN 'Mozilla/5.0 (iPad) Tablet Safari'
       WHEN 5 THEN 'Googlebot/2.1 crawler bot' ELSE 'Mozilla/5.0 (5G) Mobile Chrome' END AS user_agent,
  CASE WHEN event_id % 25 = 0 THEN 'HTTP' ELSE 'HTTPS' END AS proto,
  CASE event_id % 10 WHEN 0 THEN 'TLSv1.0' WHEN 1 THEN 'TLSv1.2' WHEN 2 THEN 'TLSv1.2' ELSE 'TLSv1.3' END AS tls_version,
  CASE event_id % 40 WHEN 0 THEN 'ULnR_1|39:SQL-INJECTION|' WHEN 7 THEN 'ULnR_1|39:XSS|' WHEN 13 THEN 'ULnR_2|39:BOT-ANOMALY-HEADER|'
       WHEN 21 THEN 'ULnR_2|39:RATE|' ELSE '' END     AS security_rules,
  CASE WHEN event_id % 15 = 0 THEN concat('ew', user_id % 3, ':1:2:3:4:5:', event_id % 90, '|', CASE WHEN event_id % 45 = 0 THEN '500' ELSE '200' END) ELSE '' END AS ew_execution_info,
  CASE event_id % 4 WHEN 0 THEN 'application/json' WHEN 1 THEN 'video/mp4' WHEN 2 THEN 'image/jpeg' ELSE 'text/html' END AS rsp_content_type,
  CASE WHEN value < 5 THEN '0-5KB' WHEN value < 50 THEN '5-50KB' ELSE '50KB+' END AS file_size_bucket,
  CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS download_initiated,
  CAST(CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN 1 ELSE 0 END AS INT) AS downloads_completed,
  concat('c', user_id)                               AS cookie,
  concat('198.51.100.', user_id % 250)               AS x_forwarded_for
"""

# Pipeline-metric tables, derived from the same events. Text for Spark SQL and DuckDB;
# the caller completes each with "FROM <events>" and, where present, its GROUP BY.
_JOB_GROUP = " GROUP BY date_trunc('hour', ts), user_id % 4"

PIPELINE_TABLES: dict[str, tuple[str, str]] = {
    "ingestion_requests": (
        """SELECT ts AS timestamp, concat('r', event_id) AS request_id,
  CAST(CASE WHEN event_type = 'error' THEN 400 ELSE 201 END AS INT) AS http_status""", ""),
    "bundle_processing": (
        """SELECT ts AS timestamp, concat('r', event_id) AS request_id,
  CAST((event_id * 37) % 900 AS BIGINT) AS total_processing_time_ms, CAST((event_id * 17) % 90 AS BIGINT) AS decompression_time_ms,
  CAST((event_id * 29) % 400 AS BIGINT) AS kafka_write_time_ms, CAST(900 + event_id % 100 AS BIGINT) AS valid_lines,
  CAST(CASE WHEN event_type = 'error' THEN event_id % 50 ELSE 0 END AS BIGINT) AS invalid_lines""", ""),
    "kafka_production_metrics": (
        """SELECT ts AS timestamp, CAST(900 + event_id % 100 AS BIGINT) AS records_successful,
  CAST(CASE WHEN event_type = 'error' THEN event_id % 7 ELSE 0 END AS BIGINT) AS records_failed""", ""),
    "failed_bundles": (
        """SELECT ts AS timestamp, concat('r', event_id) AS request_id,
  CASE event_id % 3 WHEN 0 THEN 'decompress' WHEN 1 THEN 'parse' ELSE 'publish' END AS failure_stage,
  CASE event_id % 2 WHEN 0 THEN 'CorruptBundle' ELSE 'Timeout' END AS error_type,
  concat('bundle r', event_id, ' from user ', user_id, ' failed: ', repeat('detail ', CAST(1 + event_id % 40 AS INT))) AS error_message""",
        " WHERE event_type = 'error'"),
    "kafka_consumer_lag": (
        """SELECT ts AS timestamp, concat('group-', user_id % 2) AS consumer_group,
  CASE event_id % 2 WHEN 0 THEN 'access-logs' ELSE 'access-metrics' END AS topic,
  CAST(event_id % 3 AS INT) AS partition_id, CAST((event_id * 37) % 2500 AS BIGINT) AS lag_count""", ""),
    "kafka_topic_metrics": (
        """SELECT ts AS timestamp, CASE event_id % 2 WHEN 0 THEN 'access-logs' ELSE 'access-metrics' END AS topic,
  CAST(3 + 3 * (event_id % 2) AS INT) AS partition_count, CAST(2 AS INT) AS replication_factor""", ""),
    "ingestion_realtime_metrics": (
        "SELECT concat(event_type, '_total') AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value",
        " GROUP BY event_type"),
    "processing_metrics": (
        """SELECT concat('job-', CAST(max(user_id % 4) AS STRING), '-', CAST(CAST(max(ts) AS DATE) AS STRING), '-', CAST(hour(max(ts)) AS STRING)) AS job_id,
  max(ts) AS timestamp, 'processing' AS stage, count(*) AS lines_read,
  count(*) FILTER (WHERE event_type <> 'error' AND event_id % 331 <> 0) AS lines_processed,
  count(*) FILTER (WHERE event_type <> 'error' AND event_id % 331 <> 0) AS lines_stored,
  count(*) FILTER (WHERE event_type = 'error') AS lines_failed,
  CAST(round(100.0 * count(*) FILTER (WHERE event_type <> 'error' AND event_id % 331 <> 0) / count(*), 2) AS DECIMAL(5,2)) AS success_rate,
  CAST(count(*) * 211 AS BIGINT) AS throughput_lines_per_sec,
  CAST(sum((event_id * 7907) % 47000) AS BIGINT) AS processing_duration_ms,
  CAST(max(ts) AS DATE) AS partition_date,
  CASE WHEN count(*) FILTER (WHERE event_id % 113 = 0) > 0 THEN 'write timeout' END AS error_message,
  CAST(count(*) FILTER (WHERE event_id % 113 = 0) AS INT) AS error_count""", _JOB_GROUP),
    "spark_processing_metrics": (
        """SELECT max(ts) AS timestamp, concat('job-', CAST(max(user_id % 4) AS STRING), '-', CAST(CAST(max(ts) AS DATE) AS STRING), '-', CAST(hour(max(ts)) AS STRING)) AS job_id,
  'batch' AS processing_mode, count(*) AS records_read,
  count(*) FILTER (WHERE event_type <> 'error') AS records_processed, count(*) FILTER (WHERE event_id % 41 = 0) AS records_skipped,
  count(*) FILTER (WHERE event_type = 'error') AS records_failed, CAST(sum((event_id * 7907) % 47000) AS BIGINT) AS processing_time_ms""",
        _JOB_GROUP),
    "spark_failed_records": (
        """SELECT ts AS timestamp, concat('job-', user_id % 4, '-', event_id) AS job_id, 'parse' AS failure_stage,
  CASE event_id % 2 WHEN 0 THEN 'BadTimestamp' ELSE 'BadStatus' END AS error_type,
  concat('line ', event_id, ': ', repeat('unexpected token ', CAST(1 + event_id % 15 AS INT))) AS error_message""",
        " WHERE event_type = 'error'"),
    "ingestion_metrics": (
        """SELECT ts AS timestamp, concat('i-', user_id % 3) AS instance_id,
  CASE event_id % 3 WHEN 0 THEN 'queue_depth' WHEN 1 THEN 'disk_usage_pct' ELSE 'health_check' END AS metric_name,
  CAST(CASE event_id % 3 WHEN 0 THEN (event_id * 13) % 1000 WHEN 1 THEN (event_id * 7) % 100 ELSE 1 END AS DOUBLE) AS metric_value""", ""),
    "kafka_metrics": (
        """SELECT ts AS timestamp, concat('k-', user_id % 3) AS instance_id, 'consumer_lag' AS metric_name,
  CAST((event_id * 7919) % 130000 AS DOUBLE) AS metric_value""", ""),
}

# The access log with the defects the quality checks look for. ``seen_at`` is the time a
# row was read, ``job_id`` the processing job that read it.
DIRTY_LOGS_SELECT = """
SELECT req_id, req_path, request_timestamp AS seen_at,
  concat('job-', user_id % 4, '-', CAST(request_timestamp AS DATE), '-', hour(request_timestamp)) AS job_id,
  CAST(request_timestamp AS DATE) AS partition_date,
  CASE WHEN req_id % 53 <> 0 THEN cli_ip END AS cli_ip,
  CASE WHEN req_id % 59 = 0 THEN 999 WHEN req_id % 61 <> 0 THEN status_code END AS status_code,
  CASE WHEN req_id % 67 = 0 THEN -1 - bytes ELSE bytes END AS bytes,
  CASE WHEN req_id % 71 = 0 THEN request_timestamp + INTERVAL 400 DAY ELSE request_timestamp END AS request_timestamp,
  CASE WHEN req_id % 73 <> 0 THEN country END AS country
"""

# Retried requests: every fiftieth row arrives a second time, an hour later.
REPLAYED_LOGS_SELECT = """
SELECT *, request_timestamp AS created_at FROM {logs}
UNION ALL
SELECT *, request_timestamp + INTERVAL 1 HOUR AS created_at FROM {logs} WHERE req_id % 50 = 0
"""
