"""Checks of the dashboard panels."""


def within(table: str, span: str, ts: str) -> str:
    return f"(SELECT * FROM {table} WHERE {ts} >= @asof - INTERVAL {span})"


HOURS = within("hourly_metrics", "24 HOUR", "window_start")
BIZ = within("business_metrics", "7 DAY", "hour")
DAYS = "(SELECT * FROM daily_metrics WHERE date >= CAST(@asof AS DATE) - 30)"
STATUS = within("status_summary", "1 HOUR", "window_start")
ENDPOINT = within("endpoint_summary", "1 HOUR", "window_start")


def metrics(table: str) -> str:
    return within(table, "1 HOUR", "timestamp")


MIN = "date_trunc('minute', timestamp) AS time"
ERR = "round(sum(error_count) * 100.0 / sum(request_count), 6)"
N = "CAST(sum(request_count) AS BIGINT)"

SQL = {
    "biz_total_requests": f"SELECT {N} AS total FROM {HOURS}",
    "biz_cache_hit_rate": f"SELECT round(avg(cache_hit_rate) * 100, 6) AS cache_hit_rate FROM {HOURS}",
    "biz_average_response_time": f"SELECT round(avg(avg_response_time), 6) AS avg_response FROM {HOURS}",
    "biz_error_rate": f"SELECT {ERR} AS error_rate FROM {HOURS}",
    "biz_requests_over_time": f'SELECT window_start AS time, {N} AS "Requests" FROM {HOURS} GROUP BY 1',
    "biz_cache_hit_rate_trend": f'SELECT window_start AS time, round(avg(cache_hit_rate) * 100, 6) AS "Cache Hit Rate (%)" FROM {HOURS} GROUP BY 1',
    "biz_response_time_distribution": f'SELECT window_start AS time, round(avg(p50_response_time), 6) AS "P50 (Median)" FROM {HOURS} GROUP BY 1',
    "biz_response_time_distribution_2": f'SELECT window_start AS time, round(avg(p95_response_time), 6) AS "P95" FROM {HOURS} GROUP BY 1',
    "biz_response_time_distribution_3": f'SELECT window_start AS time, round(avg(p99_response_time), 6) AS "P99" FROM {HOURS} GROUP BY 1',
    "biz_traffic_by_country": f"SELECT country AS metric, {N} AS value FROM {HOURS} GROUP BY 1 ORDER BY value DESC, metric LIMIT 10",
    "biz_top_10_slowest_urls": f"""SELECT req_path AS "URL", request_count AS "Requests", round(avg_response_time_ms, 0) AS "Avg Response (ms)",
        round(CAST(p95_response_time_ms AS DOUBLE), 0) AS "P95 (ms)", round(cache_hit_rate * 100, 1) AS "Cache Hit (%)"
        FROM {within('performance_metrics', '24 HOUR', 'hour')} ORDER BY avg_response_time_ms DESC NULLS LAST, hour, req_path LIMIT 10""",
    "biz_traffic_by_device_type": f"SELECT device_type AS metric, {N} AS value FROM {BIZ} GROUP BY 1",
    "biz_traffic_by_browser": f"SELECT browser AS metric, {N} AS value FROM {BIZ} GROUP BY 1 ORDER BY value DESC, metric LIMIT 10",
    "biz_security_events": f"""SELECT request_timestamp AS time, CASE WHEN contains(security_rules, 'SQL') THEN 'SQL Injection' WHEN contains(security_rules, 'XSS') THEN 'XSS Attempts'
        WHEN contains(security_rules, 'BOT') THEN 'Bot Attacks' WHEN contains(security_rules, 'RATE') THEN 'Rate Limit Exceeded' ELSE 'Other' END AS event_type,
        cli_ip AS "Client IP", country, req_path AS "Path", status_code FROM {within('access_logs', '24 HOUR', 'request_timestamp')}
        WHERE status_code >= 400 ORDER BY request_timestamp DESC, req_id LIMIT 100""",
    "biz_daily_traffic_trend": f'SELECT date AS time, total_requests AS "Total Requests" FROM {DAYS}',
    "biz_daily_traffic_trend_2": f'SELECT date AS time, unique_visitors AS "Unique Visitors" FROM {DAYS}',
    "biz_estimated_cdn_cost_savings": f"SELECT round(sum(total_bytes) / 1073741824.0 * avg(cache_hit_rate) * 0.085::DOUBLE, 6) AS cost_savings FROM {DAYS}",
    "biz_performance_score": f"""SELECT round((avg(cache_hit_rate) * 50 + (1 - avg(avg_response_time) / 2000) * 30
        + (1 - sum(error_count) / sum(request_count)) * 20) * 100, 6) AS score FROM {HOURS}""",
    "biz_data_freshness": "SELECT round((epoch_us(@asof) - epoch_us(max(window_start))) / 60000000.0, 6) AS minutes_since_last_update FROM hourly_metrics",
    "cust_total_requests": f"SELECT {N} AS value FROM {STATUS}",
    "cust_error_rate_pct": f"SELECT {ERR} AS value FROM {STATUS}",
    "cust_avg_response_time": f"SELECT round(avg(avg_response_time), 6) AS value FROM {STATUS}",
    "cust_unique_ips": f"SELECT CAST(sum(unique_ips) AS BIGINT) AS value FROM {STATUS}",
    "cust_requests_per_minute": f"SELECT window_start AS time, {N} AS value FROM {STATUS} GROUP BY 1",
    "cust_error_rate_pct_over_time": f"SELECT window_start AS time, {ERR} AS value FROM {STATUS} GROUP BY 1",
    "cust_status_code_distribution": f"SELECT status AS metric, {N} AS value FROM {STATUS} GROUP BY 1",
    "cust_requests_by_status_code": f"SELECT window_start AS time, status, {N} AS value FROM {STATUS} GROUP BY 1, 2",
    "cust_response_time_statistics": f"""SELECT window_start AS time, round(avg(avg_response_time), 6) AS "Average",
        round(avg(max_response_time), 6) AS "Max", round(avg(min_response_time), 6) AS "Min" FROM {STATUS} GROUP BY 1""",
    "cust_top_10_slowest_endpoints": f"""SELECT endpoint, method, round(avg(avg_response_time), 3) AS avg_time, round(avg(p95_response_time), 3) AS p95_time,
        round(avg(p99_response_time), 3) AS p99_time, {N} AS requests FROM {ENDPOINT} GROUP BY 1, 2 ORDER BY avg_time DESC NULLS LAST, endpoint, method LIMIT 10""",
    "cust_top_10_most_requested_endpoints": f"SELECT method || ' ' || endpoint AS metric, {N} AS value FROM {ENDPOINT} GROUP BY 1 ORDER BY value DESC, metric LIMIT 10",
    "cust_endpoints_with_most_errors": f"""SELECT endpoint, method, CAST(sum(error_count) AS BIGINT) AS total_errors, {N} AS total_requests,
        round(sum(error_count) * 100.0 / sum(request_count), 2) AS error_rate FROM {ENDPOINT} WHERE error_count > 0 GROUP BY 1, 2
        ORDER BY total_errors DESC, endpoint, method LIMIT 10""",
    "cust_endpoint_performance_over_time": f"""SELECT window_start AS time, endpoint, round(avg(avg_response_time), 6) AS value FROM {ENDPOINT}
        GROUP BY 1, 2 ORDER BY time, endpoint LIMIT 500""",
    "cust_error_details": f"""SELECT window_start, endpoint, method, CAST(sum(error_count) AS BIGINT) AS errors, round(avg(avg_response_time), 3) AS avg_time
        FROM {ENDPOINT} WHERE error_count > 0 GROUP BY 1, 2, 3 ORDER BY errors DESC, window_start DESC, endpoint, method LIMIT 50""",
    "ops_ingestion_requests_per_minute": f"SELECT {MIN}, count(*) AS value FROM {metrics('ingestion_requests')} GROUP BY 1",
    "ops_ingestion_success_vs_failed": f"SELECT if(http_status = 201, 'Success', 'Failed') AS metric, count(*) AS value FROM {metrics('ingestion_requests')} GROUP BY 1",
    "ops_ingestion_processing_time": f"""SELECT {MIN}, round(avg(total_processing_time_ms), 6) AS avg_time, max(total_processing_time_ms) AS max_time
        FROM {metrics('bundle_processing')} GROUP BY 1""",
    "ops_kafka_records_written": f"SELECT CAST(sum(records_successful) AS BIGINT) AS value FROM {metrics('kafka_production_metrics')}",
    "ops_kafka_records_failed": f"SELECT CAST(sum(records_failed) AS BIGINT) AS value FROM {metrics('kafka_production_metrics')}",
    "ops_failed_bundles": f"""SELECT timestamp, request_id, failure_stage, error_type, left(error_message, 100) AS error
        FROM {metrics('failed_bundles')} ORDER BY timestamp DESC, request_id LIMIT 10""",
    "ops_kafka_consumer_lag_by_topic": f"SELECT {MIN}, topic, CAST(sum(lag_count) AS BIGINT) AS value FROM {metrics('kafka_consumer_lag')} GROUP BY 1, 2",
    "ops_kafka_topic_metrics": f"""SELECT topic, partition_count, replication_factor, max(timestamp) AS last_updated
        FROM {metrics('kafka_topic_metrics')} GROUP BY 1, 2, 3""",
    "ops_real_time_ingestion_metrics": "SELECT * FROM ingestion_realtime_metrics",
    "ops_bundle_processing_breakdown": f"""SELECT {MIN}, round(avg(decompression_time_ms), 6) AS decompression, round(avg(kafka_write_time_ms), 6) AS kafka_write
        FROM {metrics('bundle_processing')} GROUP BY 1""",
    "ops_lines_processed_valid_vs_invalid": f"""SELECT {MIN}, CAST(sum(valid_lines) AS BIGINT) AS valid, CAST(sum(invalid_lines) AS BIGINT) AS invalid
        FROM {metrics('bundle_processing')} GROUP BY 1""",
    "ops_spark_processing_metrics": f"""SELECT timestamp, job_id, processing_mode, records_read, records_processed, records_skipped, records_failed, processing_time_ms
        FROM {metrics('spark_processing_metrics')} ORDER BY timestamp DESC, job_id LIMIT 20""",
    "ops_spark_failed_records": f"""SELECT timestamp, job_id, failure_stage, error_type, left(error_message, 150) AS error
        FROM {metrics('spark_failed_records')} ORDER BY timestamp DESC, job_id LIMIT 15""",
}
