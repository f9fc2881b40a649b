"""Series and rankings over stored roll-ups.

Averages of averages and sums of distinct counts are kept in the literal form the
reports define; ``rollups.merge_rollup`` holds the forms that re-aggregate correctly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import pct


def requests_per_second(endpoint_summary: DataFrame, seconds: float = 30.0) -> DataFrame:
    return (
        endpoint_summary.groupBy(F.col("window_start").alias("time"))
        .agg((F.sum("request_count") / F.lit(seconds)).alias("requests_per_second"))
        .orderBy("time")
    )


def error_rate_series(endpoint_summary: DataFrame) -> DataFrame:
    return (
        endpoint_summary.groupBy(F.col("window_start").alias("time"))
        .agg(pct(F.sum("error_count"), F.sum("request_count")).alias("error_rate_pct"))
        .orderBy("time")
    )


def p95_series(endpoint_summary: DataFrame) -> DataFrame:
    return (
        endpoint_summary.groupBy(F.col("window_start").alias("time"))
        .agg(F.avg("p95_response_time").alias("p95_latency"))
        .orderBy("time")
    )


def top_endpoints(endpoint_summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        endpoint_summary.groupBy("endpoint")
        .agg(F.sum("request_count").alias("total_requests"), F.avg("avg_response_time").alias("avg_latency"))
        .orderBy(F.desc("total_requests"), "endpoint")
        .limit(limit)
    )


def busiest_windows(endpoint_summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        endpoint_summary.select(
            "window_start", "endpoint", "method", "request_count", "avg_response_time",
            pct(F.col("error_count"), F.col("request_count")).alias("error_rate_pct"),
        )
        .orderBy(F.desc("request_count"), "window_start", "endpoint", "method")
        .limit(limit)
    )


def slow_endpoints(endpoint_summary: DataFrame, min_windows: int = 100, limit: int = 20) -> DataFrame:
    return (
        endpoint_summary.groupBy("endpoint", "method")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("avg_response_time").alias("avg_latency"),
            F.avg("p95_response_time").alias("p95_latency"),
            F.avg("p99_response_time").alias("p99_latency"),
            pct(F.sum("error_count"), F.sum("request_count")).alias("error_rate"),
        )
        .filter(F.col("request_count") > min_windows)
        .orderBy(F.desc(F.round("p95_latency", 6)), "endpoint", "method")
        .limit(limit)
    )


def error_rate_spike(endpoint_summary: DataFrame, min_pct: float = 1.0, ignore: str = "%/health%") -> DataFrame:
    return (
        endpoint_summary.filter(~F.col("endpoint").like(ignore))
        .groupBy("endpoint")
        .agg(
            pct(F.sum("error_count"), F.sum("request_count")).alias("error_rate_pct"),
            F.sum("error_count").alias("total_errors"),
        )
        .filter(F.col("error_rate_pct") > min_pct)
        .orderBy(F.desc("error_rate_pct"), "endpoint")
    )


def hourly_series(hourly_metrics: DataFrame) -> DataFrame:
    return (
        hourly_metrics.groupBy(F.col("window_start").alias("time"))
        .agg(
            F.sum("request_count").alias("requests"),
            F.avg("avg_response_time").alias("response_time"),
            F.sum("error_count").alias("errors"),
        )
        .orderBy("time")
    )


def regrouped_series(hourly_metrics: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    return (
        hourly_metrics.groupBy(F.window("window_start", bucket).alias("w"))
        .agg(
            F.avg("cache_hit_rate").alias("cache_hit_rate"),
            F.avg("avg_response_time").alias("avg_response_time"),
        )
        .select(F.col("w.start").alias("time"), "cache_hit_rate", "avg_response_time")
        .orderBy("time")
    )


def hourly_error_rate(hourly_metrics: DataFrame) -> DataFrame:
    return (
        hourly_metrics.groupBy(F.col("window_start").alias("hour"))
        .agg(pct(F.sum("error_count"), F.sum("request_count")).alias("error_rate"))
        .orderBy("hour")
    )
