"""Dashboard panels, each over the time range its dashboard shows."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.operators import rollups
from edgeloom.plans import dashboards as D


def _hourly(t):
    return t.recent(rollups.hourly_metrics, "24 hours").withColumnRenamed("window_start", "hour")


def _business(t):
    return t.recent(rollups.business_metrics, "7 days", start="hour")


def _daily(t):
    return t.daily(30)


def _status(t):
    return t.recent(rollups.status_summary, "1 hour")


def _endpoint(t):
    return t.recent(rollups.endpoint_summary, "1 hour")


def _metrics(name):
    return lambda t: t.recent_metrics(name, "1 hour")


def over(source, panel, *args, **options):
    """Measures are given as functions: a column needs a session, the list of names does not."""
    return lambda t: panel(source(t), *map(_made, args), **{k: _made(v) for k, v in options.items()})


def _made(value):
    if isinstance(value, dict):
        return {k: _made(v) for k, v in value.items()}
    return value() if callable(value) else value


def requests():
    return F.sum("request_count")


# --- fixed values: panels with their labels, measures, ranges and limits ----------------
QUERIES = {
    # business insight
    "biz_total_requests": over(_hourly, D.figure, total=requests),
    "biz_cache_hit_rate": over(_hourly, D.figure, cache_hit_rate=lambda: F.avg("cache_hit_rate") * 100),
    "biz_average_response_time": over(_hourly, D.figure, avg_response=lambda: F.avg("avg_response_time")),
    "biz_error_rate": over(_hourly, D.figure, error_rate=D.error_pct),
    "biz_requests_over_time": over(_hourly, D.series, "hour", {"Requests": requests}),
    "biz_cache_hit_rate_trend": over(_hourly, D.series, "hour", {"Cache Hit Rate (%)": lambda: F.avg("cache_hit_rate") * 100}),
    "biz_response_time_distribution": over(_hourly, D.series, "hour", {"P50 (Median)": lambda: F.avg("p50_response_time")}),
    "biz_response_time_distribution_2": over(_hourly, D.series, "hour", {"P95": lambda: F.avg("p95_response_time")}),
    "biz_response_time_distribution_3": over(_hourly, D.series, "hour", {"P99": lambda: F.avg("p99_response_time")}),
    "biz_traffic_by_country": over(_hourly, D.breakdown, "country", requests, 10),
    "biz_top_10_slowest_urls": over(
        lambda t: t.recent(rollups.performance_metrics, "24 hours", start="hour"), D.slowest_urls
    ),
    "biz_traffic_by_device_type": over(_business, D.breakdown, "device_type", requests),
    "biz_traffic_by_browser": over(_business, D.breakdown, "browser", requests, 10),
    "biz_security_events": over(lambda t: t.errors("24 hours"), D.latest_security_events),
    "biz_daily_traffic_trend": over(_daily, D.series, "date", {"Total Requests": lambda: F.sum("total_requests")}),
    "biz_daily_traffic_trend_2": over(_daily, D.series, "date", {"Unique Visitors": lambda: F.sum("unique_visitors")}),
    "biz_estimated_cdn_cost_savings": over(_daily, D.cost_savings),
    "biz_performance_score": over(_hourly, D.performance_score),
    "biz_data_freshness": lambda t: D.minutes_since_update(t.arrivals(), t.as_of),
    # customer analytics
    "cust_total_requests": over(_status, D.figure, value=requests),
    "cust_error_rate_pct": over(_status, D.figure, value=D.error_pct),
    "cust_avg_response_time": over(_status, D.figure, value=lambda: F.avg("avg_response_time")),
    "cust_unique_ips": over(_status, D.figure, value=lambda: F.sum("unique_ips")),
    "cust_requests_per_minute": over(_status, D.series, "window_start", {"value": requests}),
    "cust_error_rate_pct_over_time": over(_status, D.series, "window_start", {"value": D.error_pct}),
    "cust_status_code_distribution": over(_status, D.breakdown, "status", requests),
    "cust_requests_by_status_code": over(_status, D.series, "window_start", {"value": requests}, "status"),
    "cust_response_time_statistics": over(
        _status, D.series, "window_start",
        {
            "Average": lambda: F.avg("avg_response_time"),
            "Max": lambda: F.avg("max_response_time"),
            "Min": lambda: F.avg("min_response_time"),
        },
    ),
    "cust_top_10_slowest_endpoints": over(_endpoint, D.slowest_endpoints),
    "cust_top_10_most_requested_endpoints": over(_endpoint, D.most_requested),
    "cust_endpoints_with_most_errors": over(_endpoint, D.endpoints_with_errors),
    "cust_endpoint_performance_over_time": over(_endpoint, D.endpoint_over_time),
    "cust_error_details": over(_endpoint, D.error_details),
    # pipeline operations
    "ops_ingestion_requests_per_minute": over(
        _metrics("ingestion_requests"), D.series, D.minute, {"value": lambda: F.count(F.lit(1))}
    ),
    "ops_ingestion_success_vs_failed": over(_metrics("ingestion_requests"), D.success_vs_failed),
    "ops_ingestion_processing_time": over(
        _metrics("bundle_processing"), D.series, D.minute,
        {"avg_time": lambda: F.avg("total_processing_time_ms"), "max_time": lambda: F.max("total_processing_time_ms")},
    ),
    "ops_kafka_records_written": over(_metrics("kafka_production_metrics"), D.figure, value=lambda: F.sum("records_successful")),
    "ops_kafka_records_failed": over(_metrics("kafka_production_metrics"), D.figure, value=lambda: F.sum("records_failed")),
    "ops_failed_bundles": over(_metrics("failed_bundles"), D.latest_failures, "request_id", 100, 10),
    "ops_kafka_consumer_lag_by_topic": over(
        _metrics("kafka_consumer_lag"), D.series, D.minute, {"value": lambda: F.sum("lag_count")}, "topic"
    ),
    "ops_kafka_topic_metrics": over(_metrics("kafka_topic_metrics"), D.topic_metrics),
    "ops_real_time_ingestion_metrics": lambda t: t.pipeline("ingestion_realtime_metrics"),
    "ops_bundle_processing_breakdown": over(
        _metrics("bundle_processing"), D.series, D.minute,
        {"decompression": lambda: F.avg("decompression_time_ms"), "kafka_write": lambda: F.avg("kafka_write_time_ms")},
    ),
    "ops_lines_processed_valid_vs_invalid": over(
        _metrics("bundle_processing"), D.series, D.minute,
        {"valid": lambda: F.sum("valid_lines"), "invalid": lambda: F.sum("invalid_lines")},
    ),
    "ops_spark_processing_metrics": over(_metrics("spark_processing_metrics"), D.latest_jobs),
    "ops_spark_failed_records": over(_metrics("spark_failed_records"), D.latest_failures, "job_id", 150, 15),
}
# --------------------------------------------------------------------------------------
