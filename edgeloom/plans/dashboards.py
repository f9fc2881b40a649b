"""Dashboard panels: small queries over roll-ups and pipeline-metric tables.

Inputs are already cut to the panel's time range. Most panels have one of four shapes
(a single figure, a series over time, a breakdown by label, a top list), built by the
helpers below. Output names are the panel's own labels. Lists that are cut always end
their ordering with the row's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.classify import threat_class
from edgeloom.functions.exprs import TS, epoch_seconds, instant, pct


def figure(df: DataFrame, **measures: Column) -> DataFrame:
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def series(df: DataFrame, time: str | Column, measures: dict[str, Column], *keys: str) -> DataFrame:
    time = F.col(time) if isinstance(time, str) else time
    return (
        df.groupBy(time.alias("time"), *keys)
        .agg(*[m.alias(name) for name, m in measures.items()])
        .orderBy("time", *keys)
    )


def breakdown(df: DataFrame, label: str | Column, measure: Column, limit: int | None = None) -> DataFrame:
    label = F.col(label) if isinstance(label, str) else label
    out = (
        df.groupBy(label.alias("metric"))
        .agg(measure.alias("value"))
        .orderBy(F.desc("value"), "metric")
    )
    return out if limit is None else out.limit(limit)


def latest(df: DataFrame, columns: list, limit: int, ts: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(ts), *ties).limit(limit).select(*columns)


def minute(ts: str = "timestamp") -> Column:
    return F.date_trunc("minute", ts)


def error_pct() -> Column:
    return pct(F.sum("error_count"), F.sum("request_count"))


# -- business panels ---------------------------------------------------------------------


def slowest_urls(performance_metrics: DataFrame, limit: int = 10) -> DataFrame:
    return (
        performance_metrics.orderBy(F.desc("avg_response_time_ms"), "hour", "req_path")
        .limit(limit)
        .select(
            F.col("req_path").alias("URL"),
            F.col("request_count").alias("Requests"),
            F.round("avg_response_time_ms", 0).alias("Avg Response (ms)"),
            F.round(F.col("p95_response_time_ms").cast("double"), 0).alias("P95 (ms)"),
            F.round(F.col("cache_hit_rate") * 100, 1).alias("Cache Hit (%)"),
        )
    )


def security_event_log(logs: DataFrame) -> DataFrame:
    """Error requests, one row each, with their threat type."""
    return logs.filter(F.col("status_code") >= 400).withColumn("event_type", threat_class())


def latest_security_events(logs: DataFrame, limit: int = 100) -> DataFrame:
    return latest(
        security_event_log(logs),
        [
            F.col(TS).alias("time"), "event_type", F.col("cli_ip").alias("Client IP"),
            "country", F.col("req_path").alias("Path"), "status_code",
        ],
        limit, TS, "req_id",
    )


def cost_savings(daily_metrics: DataFrame, usd_per_gib: float = 0.085) -> DataFrame:
    saved = F.sum("total_bytes") / F.lit(float(1024**3)) * F.avg("cache_hit_rate") * F.lit(usd_per_gib)
    return figure(daily_metrics, cost_savings=saved)


def performance_score(hourly_metrics: DataFrame) -> DataFrame:
    """Weighted score: hits 50, latency against two seconds 30, success 20."""
    hits = F.avg("cache_hit_rate") * 50
    latency = (1 - F.avg("avg_response_time") / F.lit(2000.0)) * 30
    success = (1 - F.sum("error_count") / F.nullif(F.sum("request_count"), F.lit(0))) * 20
    return figure(hourly_metrics, score=(hits + latency + success) * 100)


def minutes_since_update(logs: DataFrame, as_of) -> DataFrame:
    """Age of the newest hourly roll-up row, whose hour is that of the newest request."""
    newest = F.date_trunc("hour", F.max(TS))
    return logs.agg(
        ((epoch_seconds(instant(as_of)) - epoch_seconds(newest)) / F.lit(60.0)).alias("minutes_since_last_update")
    )


# -- customer panels ---------------------------------------------------------------------


def slowest_endpoints(endpoint_summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        endpoint_summary.groupBy("endpoint", "method")
        .agg(
            F.round(F.avg("avg_response_time"), 3).alias("avg_time"),
            F.round(F.avg("p95_response_time"), 3).alias("p95_time"),
            F.round(F.avg("p99_response_time"), 3).alias("p99_time"),
            F.sum("request_count").alias("requests"),
        )
        .orderBy(F.desc("avg_time"), "endpoint", "method")
        .limit(limit)
    )


def most_requested(endpoint_summary: DataFrame, limit: int = 10) -> DataFrame:
    return breakdown(endpoint_summary, F.concat_ws(" ", "method", "endpoint"), F.sum("request_count"), limit)


def endpoints_with_errors(endpoint_summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        endpoint_summary.filter(F.col("error_count") > 0)
        .groupBy("endpoint", "method")
        .agg(
            F.sum("error_count").alias("total_errors"),
            F.sum("request_count").alias("total_requests"),
            F.round(error_pct(), 2).alias("error_rate"),
        )
        .orderBy(F.desc("total_errors"), "endpoint", "method")
        .limit(limit)
    )


def endpoint_over_time(endpoint_summary: DataFrame, limit: int = 500) -> DataFrame:
    return series(endpoint_summary, "window_start", {"value": F.avg("avg_response_time")}, "endpoint").limit(limit)


def error_details(endpoint_summary: DataFrame, limit: int = 50) -> DataFrame:
    return (
        endpoint_summary.filter(F.col("error_count") > 0)
        .groupBy("window_start", "endpoint", "method")
        .agg(F.sum("error_count").alias("errors"), F.round(F.avg("avg_response_time"), 3).alias("avg_time"))
        .orderBy(F.desc("errors"), F.desc("window_start"), "endpoint", "method")
        .limit(limit)
    )


# -- pipeline panels ---------------------------------------------------------------------


def success_vs_failed(ingestion_requests: DataFrame) -> DataFrame:
    return breakdown(
        ingestion_requests,
        F.when(F.col("http_status") == 201, "Success").otherwise("Failed"),
        F.count(F.lit(1)),
    )


def latest_failures(failures: DataFrame, id_column: str, chars: int, limit: int) -> DataFrame:
    return latest(
        failures,
        ["timestamp", id_column, "failure_stage", "error_type", F.left("error_message", F.lit(chars)).alias("error")],
        limit, "timestamp", id_column,
    )


def topic_metrics(kafka_topic_metrics: DataFrame) -> DataFrame:
    return (
        kafka_topic_metrics.groupBy("topic", "partition_count", "replication_factor")
        .agg(F.max("timestamp").alias("last_updated"))
        .orderBy("topic", "partition_count", "replication_factor")
    )


def latest_jobs(spark_processing_metrics: DataFrame, limit: int = 20) -> DataFrame:
    return latest(
        spark_processing_metrics,
        [
            "timestamp", "job_id", "processing_mode", "records_read", "records_processed",
            "records_skipped", "records_failed", "processing_time_ms",
        ],
        limit, "timestamp", "job_id",
    )
