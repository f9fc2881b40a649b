"""Checks of data quality, processing jobs and alerts."""


def recent(span: str, table: str = "processing_metrics") -> str:
    return f"(SELECT * FROM {table} WHERE timestamp >= @asof - INTERVAL {span})"


JOB_QUALITY = """(SELECT job_id, max(timestamp) AS timestamp, 100 - sum(failed_count) * 100.0 / sum(total_count) AS quality_score
    FROM data_quality_metrics GROUP BY job_id)"""


STRETCH = 288


def rule(name, severity, minutes, threshold, measure, op, table, ts="timestamp", where="true", hold=1, silence=False) -> str:
    """One alert: the measure over each of the latest ``hold`` windows."""
    minutes *= STRETCH
    parts = [
        f"""SELECT {measure} AS v FROM {table} WHERE ({where}) AND {ts} > @asof - INTERVAL {minutes * (k + 1)} MINUTE
            AND {ts} <= @asof - INTERVAL {minutes * k} MINUTE HAVING count(*) > 0"""
        for k in range(hold)
    ]
    latest = f"({parts[0]})"
    breached = " AND ".join(f"coalesce(({p}) {op} {threshold}, false)" for p in parts)
    if silence:
        breached = f"({breached}) OR {latest} IS NULL"
    return f"""SELECT '{name}' AS rule, '{severity}' AS severity, {minutes} AS window_minutes, round(CAST({latest} AS DOUBLE), 6) AS value,
        CAST({threshold} AS DOUBLE) AS threshold, {breached} AS firing"""


AGE = "(epoch_us(@asof) - epoch_us(max({}))) / 60000000.0"
ERRORS = "sum(error_count) * 100.0 / sum(request_count)"

ALERTS = lambda: [
    rule("IngestionServiceDown", "P1", 60, 5, AGE.format("timestamp"), ">", "ingestion_metrics", where="metric_name = 'health_check'", silence=True),
    rule("HighErrorRate", "P1", 10, 10, ERRORS, ">", "endpoint_summary", "window_start"),
    rule("KafkaLagCritical", "P1", 5, 100000, "max(metric_value)", ">", "kafka_metrics"),
    rule("QueueBacklogGrowing", "P2", 15, 500, "avg(metric_value)", ">", "ingestion_metrics", where="metric_name = 'queue_depth'"),
    rule("SlowResponseTimes", "P2", 10, 1000, "avg(p95_response_time) * 1000", ">", "endpoint_summary", "window_start"),
    rule("DiskUsageHigh", "P2", 5, 85, "max(metric_value)", ">", "ingestion_metrics", where="metric_name = 'disk_usage_pct'"),
    rule("DataLossDetected", "critical", 5, 0, "count(*) FILTER (WHERE lines_read - lines_processed > lines_failed)", ">", "processing_metrics"),
    rule("ProcessingFailure", "critical", 5, 0, "count(*) FILTER (WHERE error_count > 0)", ">", "processing_metrics"),
    rule("SuccessRateDrop", "critical", 15, 90, "avg(success_rate::DOUBLE)", "<", "processing_metrics"),
    rule("SlowProcessing", "warning", 15, 120000, "avg(processing_duration_ms)", ">", "processing_metrics"),
    rule("HighFailureRate", "warning", 30, 1, "avg(lines_failed * 100.0 / lines_read)", ">", "processing_metrics"),
    rule("QualityScoreDrop", "warning", 60, 95, "avg(quality_score)", "<", JOB_QUALITY),
    rule("CacheHitRateLow", "warning", 60, 70, "avg(cache_hit_rate) * 100", "<", "hourly_metrics", "window_start"),
    rule("EdgeErrorRate", "critical", 5, 5, "count(*) FILTER (WHERE status_code >= 400) * 100.0 / count(*)", ">", "access_logs", "request_timestamp"),
    rule("JobFailureRate", "warning", 60, 5, "count(*) FILTER (WHERE error_count > 0) * 100.0 / count(*)", ">", "processing_metrics"),
    rule("DataStale", "warning", 60, 15, AGE.format("request_timestamp"), ">", "access_logs", "request_timestamp", silence=True),
    rule("IngestionErrors", "critical", 5, 1, "count(*) FILTER (WHERE http_status <> 201) * 100.0 / count(*)", ">", "ingestion_requests"),
    rule("QueueBacklog", "warning", 5, 5000, "max(metric_value)", ">", "ingestion_metrics", where="metric_name = 'queue_depth'"),
    rule("DiskFull", "critical", 5, 90, "max(metric_value)", ">", "ingestion_metrics", where="metric_name = 'disk_usage_pct'"),
]

STATUS = "CASE WHEN error_count > 0 THEN 'Errors' WHEN success_rate < 95 THEN 'Warning' ELSE 'OK' END AS status"

SQL = {
    "quality_flags": """SELECT req_id, missing_ip, invalid_status, negative_bytes, future_timestamp, invalid_geo, quality_score FROM flagged""",
    "quality_metrics": "SELECT * REPLACE (CAST(failure_rate AS DOUBLE) AS failure_rate) FROM data_quality_metrics",
    "quality_trends": """SELECT CAST(timestamp AS DATE) AS date, round(avg(100 - failure_rate) FILTER (WHERE metric_name = 'quality_score'), 6) AS avg_quality_score,
        CAST(sum(failed_count) AS BIGINT) AS total_failures FROM data_quality_metrics GROUP BY 1""",
    "quality_by_check": """SELECT metric_name, count(*) AS occurrences, CAST(sum(failed_count) AS BIGINT) AS total_failed,
        round(avg(failure_rate::DOUBLE), 6) AS avg_failure_rate, max(failure_rate::DOUBLE) AS max_failure_rate FROM data_quality_metrics GROUP BY 1""",
    "quality_by_hour": """SELECT date_trunc('hour', timestamp) AS hour, metric_name, round(avg(failure_rate::DOUBLE), 6) AS avg_failure_rate
        FROM data_quality_metrics WHERE metric_name IN ('missing_ip', 'invalid_status', 'negative_bytes') GROUP BY 1, 2""",
    "quality_by_job": f"SELECT job_id, round(quality_score, 6) AS quality_score FROM {JOB_QUALITY}",
    "quality_mean": f"SELECT round(avg(quality_score), 6) AS avg_quality_score FROM {JOB_QUALITY}",
    "null_required": """SELECT count(*) - count(cli_ip) AS null_ips, count(*) - count(request_timestamp) AS null_timestamps,
        count(*) - count(req_path) AS null_endpoints FROM dirty_logs""",
    "job_status": f"""SELECT job_id, timestamp, lines_read, lines_processed, lines_stored, lines_failed, success_rate::DOUBLE AS success_rate,
        processing_duration_ms, {STATUS} FROM {recent('24 HOUR')} ORDER BY timestamp DESC, job_id LIMIT 10""",
    "job_summaries": f"""SELECT date_trunc('hour', timestamp) AS hour, count(*) AS job_count, CAST(sum(lines_read) AS BIGINT) AS total_lines_read,
        CAST(sum(lines_processed) AS BIGINT) AS total_lines_processed, CAST(sum(lines_stored) AS BIGINT) AS total_lines_stored,
        CAST(sum(lines_failed) AS BIGINT) AS total_lines_failed, round(avg(success_rate::DOUBLE), 6) AS avg_success_rate,
        round(avg(processing_duration_ms), 6) AS avg_duration_ms, CAST(sum(error_count) AS BIGINT) AS total_errors FROM {recent('24 HOUR')} GROUP BY 1""",
    "job_daily_performance": f"""SELECT CAST(timestamp AS DATE) AS date, count(*) AS total_jobs, CAST(sum(lines_processed) AS BIGINT) AS total_lines,
        round(avg(throughput_lines_per_sec), 6) AS avg_throughput, round(avg(processing_duration_ms), 6) AS avg_duration_ms,
        round(quantile_cont(processing_duration_ms, 0.95), 6) AS p95_duration_ms FROM {recent('30 DAY')} GROUP BY 1""",
    "job_daily_failures": f"""SELECT partition_date AS date, count(*) AS jobs_with_failures, CAST(sum(lines_failed) AS BIGINT) AS total_failed_lines,
        round(avg(lines_failed), 6) AS avg_failed_per_job, max(lines_failed) AS max_failed_single_job FROM {recent('7 DAY')} WHERE lines_failed > 0 GROUP BY 1""",
    "line_reconciliation": f"""SELECT job_id, timestamp, lines_read, lines_processed, lines_failed, lines_read - lines_processed - lines_failed AS missing_lines,
        if(lines_read - lines_processed - lines_failed > 0, 'DATA LOSS', 'OK') AS status FROM {recent('7 DAY')}
        WHERE lines_read <> lines_processed + lines_failed""",
    "job_series": f"""SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS time, CAST(sum(lines_processed) AS BIGINT) AS lines,
        CAST(sum(lines_failed) AS BIGINT) AS failed, round(avg(processing_duration_ms) / 1000, 6) AS avg_duration_sec FROM {recent('24 HOUR')} GROUP BY 1""",
    "job_totals": f"""SELECT CAST(sum(lines_processed) FILTER (WHERE timestamp > CAST(@asof AS DATE)) AS BIGINT) AS lines_today,
        round(avg(success_rate::DOUBLE), 6) AS success_rate FROM {recent('24 HOUR')}""",
    "lag_and_slow_jobs": "SELECT consumer_group, topic, partition_id, lag_count, timestamp FROM kafka_consumer_lag WHERE lag_count > 1000",
    "slow_jobs": "SELECT job_id, processing_duration_ms FROM processing_metrics WHERE processing_duration_ms > 120000 ORDER BY timestamp DESC, job_id LIMIT 5",
    "failed_jobs": """SELECT * REPLACE (success_rate::DOUBLE AS success_rate) FROM processing_metrics WHERE error_count > 0
        ORDER BY timestamp DESC, job_id LIMIT 5""",
    "jobs_yesterday": """SELECT CAST(timestamp AS DATE) AS date, CAST(sum(lines_read) AS BIGINT) AS total_read, CAST(sum(lines_processed) AS BIGINT) AS total_processed,
        CAST(sum(lines_stored) AS BIGINT) AS total_stored, CAST(sum(lines_failed) AS BIGINT) AS total_failed,
        round(avg(success_rate::DOUBLE), 6) AS avg_success_rate, count(*) AS total_jobs FROM processing_metrics
        WHERE CAST(timestamp AS DATE) = CAST(@asof AS DATE) - 1 GROUP BY 1""",
    "job_failures_with_quality": """SELECT p.job_id, p.timestamp, error_message, error_count, metric_name, failed_count, failure_rate::DOUBLE AS failure_rate
        FROM processing_metrics p LEFT JOIN (SELECT * FROM data_quality_metrics WHERE failed_count > 0) q ON p.job_id = q.job_id WHERE error_count > 0""",
    "eav_pivot": """SELECT date_trunc('hour', timestamp) AS hour, max(metric_value) FILTER (WHERE metric_name = 'queue_depth') AS queue_depth,
        max(metric_value) FILTER (WHERE metric_name = 'disk_usage_pct') AS disk_usage_pct,
        max(metric_value) FILTER (WHERE metric_name = 'health_check') AS health_check FROM ingestion_metrics GROUP BY 1""",
    "eav_series": f"SELECT timestamp AS time, metric_value AS lag_messages FROM {recent('24 HOUR', 'kafka_metrics')}",
    "evaluate_alerts": "\nUNION ALL\n".join(ALERTS()),
}

STRETCH = 1
SQL["evaluate_alerts_dense"] = "--compressed\n" + "\nUNION ALL\n".join(ALERTS())
