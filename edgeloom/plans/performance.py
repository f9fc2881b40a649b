"""Latency, downloads and errors by path, place, device and network.

Exact percentiles here run over whole milliseconds: the per-key state is a histogram of
distinct values that merges map-side, whatever the number of requests behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions import classify as C
from edgeloom.functions.exprs import gib, n_where, pct, share, since, since_day


def _count() -> Column:
    return F.count(F.lit(1))


def _errors() -> Column:
    return F.col("status_code") >= 400


def slowest_paths(logs: DataFrame, as_of, window="24 hours", min_requests=1000, limit=20) -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter(F.col("status_code") == 200)
        .groupBy("req_path", "req_host")
        .agg(
            _count().alias("request_count"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            F.percentile("ttfb_ms", 0.95).alias("p95_ttfb_ms"),
            F.avg("throughput_bps").alias("avg_throughput_bps"),
        )
        .filter(F.col("request_count") > min_requests)
        .orderBy(F.desc("avg_ttfb_ms"), "req_path", "req_host")
        .limit(limit)
    )


def geo_performance(logs: DataFrame, as_of, window="7 days", min_requests=10000) -> DataFrame:
    return (
        since(logs, as_of, window)
        .groupBy("country", "city")
        .agg(
            _count().alias("requests"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            F.avg("download_time_ms").alias("avg_download_ms"),
            share(_errors()).alias("error_rate_pct"),
        )
        .filter(F.col("requests") > min_requests)
        .orderBy(F.desc("avg_ttfb_ms"), "country", "city")
    )


def download_completion(logs: DataFrame, as_of, window="7 days", min_initiated=100) -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter(F.col("download_initiated") == 1)
        .groupBy("rsp_content_type", "file_size_bucket", "country")
        .agg(
            _count().alias("total_downloads"),
            F.sum("download_initiated").alias("initiated"),
            F.sum("downloads_completed").alias("completed"),
            pct(F.sum("downloads_completed"), F.sum("download_initiated")).alias("completion_rate_pct"),
            F.avg("download_time_ms").alias("avg_download_ms"),
        )
        .filter(F.col("initiated") > min_initiated)
        .orderBy("completion_rate_pct", "rsp_content_type", "file_size_bucket", "country")
    )


def errors_by_device(logs: DataFrame, as_of, window="24 hours") -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter(_errors())
        .groupBy(C.device_class().alias("device_type"), "status_code", "error_code")
        .agg(
            _count().alias("error_count"),
            F.countDistinct("cli_ip").alias("affected_users"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
        )
        .orderBy(F.desc("error_count"), "device_type", "status_code", "error_code")
    )


def perf_by_device_network(logs: DataFrame, as_of, window="7 days") -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter((F.col("status_code") == 200) & (F.col("download_initiated") == 1))
        .groupBy(C.device_class().alias("device"), C.network_speed().alias("network_speed"))
        .agg(
            _count().alias("request_count"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            F.avg("download_time_ms").alias("avg_download_ms"),
            F.percentile("download_time_ms", 0.95).alias("p95_download_ms"),
        )
        .orderBy("device", "network_speed")
    )


def perf_by_region(logs: DataFrame, as_of, window="24 hours") -> DataFrame:
    return (
        since(logs, as_of, window, inclusive=True)
        .groupBy(C.region_of().alias("region"))
        .agg(
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            gib(F.sum("bytes")).alias("traffic_gb"),
            F.countDistinct("cli_ip").alias("unique_users"),
        )
        .orderBy(F.desc("traffic_gb"), "region")
    )


def _load_seconds() -> Column:
    return F.avg(F.col("ttfb_ms") + F.col("download_time_ms")) / F.lit(1000.0)


def ux_summary(logs: DataFrame, as_of, window="24 hours", slow_ms=3000) -> DataFrame:
    load = F.col("ttfb_ms") + F.col("download_time_ms")
    return since(logs, as_of, window, inclusive=True).agg(
        _load_seconds().alias("avg_page_load_sec"),
        n_where(C.is_handheld()).alias("mobile_requests"),
        n_where(~C.is_handheld()).alias("desktop_requests"),
        n_where(C.is_chrome()).alias("chrome_users"),
        n_where(C.is_safari()).alias("safari_users"),
        n_where(C.is_firefox()).alias("firefox_users"),
        share(_errors()).alias("error_rate"),
        share(load > slow_ms).alias("slow_request_rate"),
        (F.lit(5.0) - _load_seconds() * 0.5 - share(_errors()) * 10).alias("satisfaction_score"),
    )


def ux_daily(logs: DataFrame, as_of, days=90) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.to_date("request_timestamp").alias("date"))
        .agg(
            _load_seconds().alias("avg_page_load_sec"),
            share(F.col("user_agent").like("%Mobile%")).alias("mobile_pct"),
            share(_errors()).alias("error_rate"),
        )
    )


def perf_by_device_share(logs: DataFrame, as_of, window="7 days") -> DataFrame:
    """The share is a window over the four device rows, never over requests."""
    return (
        since(logs, as_of, window, inclusive=True)
        .groupBy(C.device_network_class().alias("device_type"))
        .agg(
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            (F.avg("download_time_ms") / F.lit(1000.0)).alias("avg_download_sec"),
            _load_seconds().alias("avg_total_sec"),
            _count().alias("n"),
        )
        .withColumn("pct_of_traffic", pct(F.col("n"), F.sum("n").over(Window.partitionBy())))
        .drop("n")
        .orderBy(F.desc("pct_of_traffic"), "device_type")
    )


def journey_steps(logs: DataFrame, as_of, days=7, give_up_ms=5000) -> DataFrame:
    load = F.col("ttfb_ms") + F.col("download_time_ms")
    return (
        since_day(logs, as_of, days)
        .groupBy(C.journey_step().alias("journey_step"))
        .agg(
            _load_seconds().alias("avg_time_sec"),
            share(_errors() | (load > give_up_ms)).alias("abandon_rate"),
        )
        .orderBy("journey_step")
    )


def endpoint_health(logs: DataFrame, as_of, path="/signup/payment", window="1 hour") -> DataFrame:
    seconds = (F.col("turn_around_time_ms") + F.col("transfer_time_ms")) / F.lit(1000.0)
    return (
        since(logs, as_of, window, inclusive=True)
        .filter(F.col("req_path") == path)
        .agg(
            F.avg(seconds).alias("avg_latency"),
            F.max(seconds).alias("max_latency"),
            share(_errors()).alias("error_rate"),
        )
    )


def top_errors(logs: DataFrame, as_of, window="5 minutes", limit=10) -> DataFrame:
    """Most frequent (path, status) errors with their share of all errors.

    The total comes from a scalar subquery: paths are unbounded, so a window over the
    grouped rows would pull them into one task.
    """
    errors = since(logs, as_of, window, inclusive=True).filter(_errors())
    total = errors.agg(_count().alias("n")).scalar()
    return (
        errors.groupBy("req_path", "status_code")
        .agg(_count().alias("error_count"))
        .orderBy(F.desc("error_count"), "req_path", "status_code")
        .limit(limit)
        .select(
            "req_path", "status_code", "error_count",
            pct(F.col("error_count"), total).alias("pct_of_errors"),
            C.impact_class().alias("impact"),
        )
    )


def slowest_by_first_byte(logs: DataFrame, as_of, days=30, limit=10) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.col("req_path").alias("endpoint"))
        .agg(F.avg("ttfb_ms").alias("avg_ttfb"))
        .orderBy(F.desc("avg_ttfb"), "endpoint")
        .limit(limit)
    )
