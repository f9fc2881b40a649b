"""Shared CTEs of the checks, in dependency order."""

from edgeloom.fixture_logs import ACCESS_LOGS_SELECT, DIRTY_LOGS_SELECT, PIPELINE_TABLES, REPLAYED_LOGS_SELECT

CTES: dict[str, str] = {}

CTES["access_logs"] = ACCESS_LOGS_SELECT + " FROM events"

CTES["clock"] = "SELECT max(request_timestamp) AS as_of FROM access_logs"

CTES["enriched"] = """
SELECT *, date_trunc('hour', request_timestamp) AS hour, CAST(request_timestamp AS DATE) AS date,
       CASE WHEN status_code >= 400 THEN 1 ELSE 0 END AS is_error,
       CASE WHEN cache_status = 1 THEN 1 ELSE 0 END AS is_cache_hit,
       turn_around_time_ms + transfer_time_ms AS response_time_ms,
       CASE WHEN user_agent LIKE '%Mobile%' THEN 1 ELSE 0 END AS is_mobile
FROM access_logs"""

CTES["hourly_metrics"] = """
SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, country, status_code, cache_status,
       count(*) AS request_count, CAST(sum(bytes) AS BIGINT) AS total_bytes,
       avg(response_time_ms) AS avg_response_time,
       CAST(sum(response_time_ms) AS BIGINT) AS response_time_sum, count(response_time_ms) AS response_time_cnt,
       quantile_disc(response_time_ms, 0.5) AS p50_response_time,
       quantile_disc(response_time_ms, 0.95) AS p95_response_time,
       quantile_disc(response_time_ms, 0.99) AS p99_response_time,
       CAST(sum(is_error) AS BIGINT) AS error_count, CAST(sum(is_cache_hit) AS BIGINT) AS cache_hits,
       sum(is_cache_hit) / count(*) AS cache_hit_rate,
       count(DISTINCT cli_ip) AS unique_ips
FROM enriched GROUP BY hour, country, status_code, cache_status"""

CTES["endpoint_metrics"] = """
SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, req_host, req_path, req_method,
       count(*) AS request_count, avg(response_time_ms) AS avg_response_time,
       quantile_disc(response_time_ms, 0.95) AS p95_response_time,
       quantile_disc(response_time_ms, 0.99) AS p99_response_time,
       CAST(sum(is_error) AS BIGINT) AS error_count, CAST(sum(bytes) AS BIGINT) AS total_bytes
FROM enriched GROUP BY hour, req_host, req_path, req_method"""

CTES["performance_metrics"] = """
SELECT hour, req_path, count(*) AS request_count, avg(response_time_ms) AS avg_response_time_ms,
       quantile_disc(response_time_ms, 0.95) AS p95_response_time_ms, avg(is_cache_hit) AS cache_hit_rate
FROM enriched GROUP BY hour, req_path"""

CTES["business_metrics"] = """
SELECT hour,
       CASE WHEN user_agent LIKE '%Mobile%' THEN 'Mobile' WHEN user_agent LIKE '%Tablet%' THEN 'Tablet' ELSE 'Desktop' END AS device_type,
       CASE WHEN user_agent LIKE '%Chrome%' THEN 'Chrome' WHEN user_agent LIKE '%Safari%' THEN 'Safari'
            WHEN user_agent LIKE '%Firefox%' THEN 'Firefox' ELSE 'Other' END AS browser,
       count(*) AS request_count
FROM enriched GROUP BY 1, 2, 3"""

CTES["daily_metrics"] = """
SELECT date, count(*) AS total_requests, count(DISTINCT cli_ip) AS unique_visitors,
       CAST(sum(bytes) AS BIGINT) AS total_bytes, avg(is_cache_hit) AS cache_hit_rate
FROM enriched GROUP BY date"""

CTES["hourly_country"] = """
SELECT hour, country, count(*) AS request_count, CAST(sum(bytes) AS BIGINT) AS total_bytes,
       avg(ttfb_ms) AS avg_ttfb, avg(throughput_bps) AS avg_throughput,
       CAST(sum(is_error) AS BIGINT) AS error_count, CAST(sum(is_cache_hit) AS BIGINT) AS cache_hits
FROM enriched GROUP BY hour, country"""

CTES["web"] = """
SELECT request_timestamp, time_bucket(INTERVAL '30 seconds', request_timestamp) AS window_start,
       cli_ip AS ip, req_method AS method, req_path AS endpoint, status_code AS status,
       (turn_around_time_ms + transfer_time_ms) / 1000.0 AS response_time
FROM access_logs"""

CTES["endpoint_summary"] = """
SELECT window_start, endpoint, method, count(*) AS request_count, avg(response_time) AS avg_response_time,
       min(response_time) AS min_response_time, max(response_time) AS max_response_time,
       quantile_disc(response_time, 0.95) AS p95_response_time, quantile_disc(response_time, 0.99) AS p99_response_time,
       count(*) FILTER (WHERE status >= 400) AS error_count, count(DISTINCT ip) AS unique_ips
FROM web GROUP BY window_start, endpoint, method"""

CTES["status_summary"] = """
SELECT window_start, status, count(*) AS request_count, avg(response_time) AS avg_response_time,
       min(response_time) AS min_response_time, max(response_time) AS max_response_time,
       quantile_disc(response_time, 0.95) AS p95_response_time, quantile_disc(response_time, 0.99) AS p99_response_time,
       count(*) FILTER (WHERE status >= 400) AS error_count, count(DISTINCT ip) AS unique_ips
FROM web GROUP BY window_start, status"""

CTES["user_summary"] = """
SELECT window_start, ip, count(*) AS request_count, count(DISTINCT endpoint) AS endpoints_accessed,
       max(request_timestamp) AS last_seen
FROM web GROUP BY window_start, ip"""

# Session numbers per user for a pause of more than six hours.
CTES["sessions_6h"] = """
SELECT user_id, ts, v, c, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, req_id) AS no FROM (
  SELECT user_id, req_id, request_timestamp AS ts, contains(req_path, '/products/')::INT AS v, contains(req_path, '/cart')::INT AS c,
         CASE WHEN request_timestamp - lag(request_timestamp) OVER (PARTITION BY user_id ORDER BY request_timestamp, req_id) <= INTERVAL 6 HOUR
              THEN 0 ELSE 1 END AS opens FROM access_logs)"""

for _name, (_select, _tail) in PIPELINE_TABLES.items():
    CTES[_name] = f"{_select} FROM events{_tail}"

CTES["dirty_logs"] = DIRTY_LOGS_SELECT + " FROM access_logs"

CTES["replayed_logs"] = REPLAYED_LOGS_SELECT.format(logs="access_logs")

CTES["flagged"] = """
SELECT *, 100 - 20 * (missing_ip + invalid_status + negative_bytes + future_timestamp + invalid_geo) AS quality_score FROM (
  SELECT *, (cli_ip IS NULL)::INT AS missing_ip, CASE WHEN status_code NOT BETWEEN 100 AND 599 THEN 1 ELSE 0 END AS invalid_status,
         CASE WHEN bytes < 0 THEN 1 ELSE 0 END AS negative_bytes, CASE WHEN request_timestamp > @asof THEN 1 ELSE 0 END AS future_timestamp,
         (country IS NULL AND cli_ip IS NOT NULL)::INT AS invalid_geo FROM dirty_logs)"""

CTES["checks"] = """
SELECT job_id, partition_date, seen_at, req_id, req_path, 'missing_ip' AS metric_name, missing_ip AS bad FROM flagged
UNION ALL SELECT job_id, partition_date, seen_at, req_id, req_path, 'invalid_status', invalid_status FROM flagged
UNION ALL SELECT job_id, partition_date, seen_at, req_id, req_path, 'negative_bytes', negative_bytes FROM flagged
UNION ALL SELECT job_id, partition_date, seen_at, req_id, req_path, 'future_timestamp', future_timestamp FROM flagged
UNION ALL SELECT job_id, partition_date, seen_at, req_id, req_path, 'invalid_geo', invalid_geo FROM flagged"""

CTES["data_quality_metrics"] = """
SELECT job_id, partition_date, max(seen_at) AS timestamp, metric_name, CAST(sum(bad) AS BIGINT) AS failed_count, count(*) AS total_count,
       round(sum(bad) * 100.0 / count(*), 2) AS failure_rate,
       coalesce('[' || string_agg('{"req_id":' || req_id || ',"req_path":"' || req_path || '"}', ',' ORDER BY req_id)
                FILTER (WHERE bad = 1 AND rn <= 3) || ']', '[]') AS sample_failed_records
FROM (SELECT *, row_number() OVER (PARTITION BY job_id, partition_date, metric_name, bad ORDER BY req_id) AS rn FROM checks)
GROUP BY job_id, partition_date, metric_name
UNION ALL
SELECT job_id, partition_date, max(seen_at), 'quality_score', count(*) FILTER (WHERE quality_score < 100), count(*),
       round(100 - avg(quality_score), 2), '[]'
FROM flagged GROUP BY job_id, partition_date"""
