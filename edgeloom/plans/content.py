"""What is served: popularity, staleness, mix, edge code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import classify as C
from edgeloom.functions.exprs import TS, epoch_seconds, gib, instant, kib, mib, pct, share, since, since_day
from edgeloom.functions.privacy import edgeworker_duration, edgeworker_id


def popular_content(logs: DataFrame, as_of, window="30 days", min_views=100, limit=100) -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter((F.col("status_code") == 200) & F.col("rsp_content_type").like("%video%"))
        .groupBy("req_path", "req_host")
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.countDistinct("cli_ip").alias("unique_viewers"),
            mib(F.sum("bytes")).alias("total_mb_served"),
            F.avg("download_time_ms").alias("avg_view_duration_ms"),
            pct(F.sum("downloads_completed"), F.sum("download_initiated")).alias("completion_rate_pct"),
        )
        .filter(F.col("views") > min_views)
        .orderBy(F.desc("views"), "req_path", "req_host")
        .limit(limit)
    )


def stale_content(logs: DataFrame, as_of, window="30 days", min_ttl_seconds=86400) -> DataFrame:
    last = F.max(TS)
    return (
        since(logs, as_of, window)
        .filter(F.col("cache_status") == 1)
        .groupBy("req_path")
        .agg(
            F.max("max_age_sec").alias("cache_ttl_seconds"),
            (F.max("max_age_sec") / F.lit(3600.0)).alias("cache_ttl_hours"),
            F.count(F.lit(1)).alias("request_count"),
            last.alias("last_requested"),
        )
        .filter(F.col("cache_ttl_seconds") > min_ttl_seconds)
        .withColumn(
            "hours_since_last_request",
            (epoch_seconds(instant(as_of)) - epoch_seconds(F.col("last_requested"))) / F.lit(3600.0),
        )
        .orderBy(F.desc("cache_ttl_hours"), "req_path")
    )


def content_mix(logs: DataFrame, as_of, days=7) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(C.content_class().alias("content_type"))
        .agg(
            gib(F.sum("bytes")).alias("traffic_gb"),
            F.count(F.lit(1)).alias("requests"),
            kib(F.avg("obj_size")).alias("avg_size_kb"),
        )
        .orderBy(F.desc("traffic_gb"), "content_type")
    )


def edgeworker_usage(logs: DataFrame, as_of, window="7 days") -> DataFrame:
    info = F.col("ew_execution_info")
    return (
        since(logs, as_of, window)
        .filter(info.isNotNull() & (info != ""))
        .groupBy(edgeworker_id().alias("edgeworker_id"))
        .agg(
            F.count(F.lit(1)).alias("execution_count"),
            F.avg(edgeworker_duration()).alias("avg_duration_ms"),
            share(info.like("%200%")).alias("success_rate_pct"),
            mib(F.sum("bytes")).alias("total_mb_processed"),
        )
        .orderBy(F.desc("execution_count"), "edgeworker_id")
    )


def hot_products(logs: DataFrame, as_of, window="5 minutes", pattern="/api/v1/products/%", limit=10) -> DataFrame:
    seconds = (F.col("turn_around_time_ms") + F.col("transfer_time_ms")) / F.lit(1000.0)
    return (
        since(logs, as_of, window, inclusive=True)
        .filter(F.col("req_path").like(pattern))
        .groupBy(F.col("req_path").alias("endpoint"))
        .agg(F.count(F.lit(1)).alias("views"), F.avg(seconds).alias("avg_latency"))
        .orderBy(F.desc("views"), "endpoint")
        .limit(limit)
    )
