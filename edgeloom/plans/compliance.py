"""Service level, privacy and headline reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.exprs import (
    TS, gib, hour_floor, instant, mib, n_where, pct, share, since_day, span,
)

# --- fixed values: countries of the privacy report -------------------------------------
EU_COUNTRIES = ["DE", "FR", "GB", "IT", "ES"]
# --------------------------------------------------------------------------------------


def gdpr_report(logs: DataFrame, as_of, purge_days=90) -> DataFrame:
    return (
        logs.filter(F.col("country").isin(EU_COUNTRIES))
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.countDistinct("cli_ip").alias("unique_users"),
            gib(F.sum("bytes")).alias("data_transferred_gb"),
            n_where(F.col(TS) < instant(as_of) - span(f"{purge_days} days")).alias("records_to_purge"),
        )
    )


def sla_report(logs: DataFrame, as_of, target_pct=99.0) -> DataFrame:
    """Availability of the running month, hour by hour against the target."""
    hourly = (
        logs.filter(F.col(TS) >= F.date_trunc("month", instant(as_of)).cast("timestamp_ntz"))
        .groupBy(hour_floor(TS).alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"), n_where(F.col("status_code") < 500).alias("good"))
    )
    below = n_where(pct(F.col("good"), F.col("n")) < target_pct)
    hours = F.count(F.lit(1))
    return hourly.agg(
        hours.alias("total_hours"),
        F.sum("n").alias("total_requests"),
        pct(F.sum("good"), F.sum("n")).alias("success_rate_pct"),
        below.alias("hours_below_sla"),
        pct(hours - below, hours).alias("uptime_pct"),
    )


def compliance_status(logs: DataFrame, as_of, days=30, target_pct=100.0, near_pct=1.0) -> DataFrame:
    """Encryption coverage against target, one row per metric."""
    current = F.col("current_pct")
    return (
        since_day(logs, as_of, days)
        .agg(
            share(F.col("proto") == "HTTPS").alias("https"),
            share(F.col("tls_version").isin("TLSv1.2", "TLSv1.3")).alias("tls"),
        )
        .select(F.expr("stack(2, 'HTTPS Coverage', https, 'TLS 1.2+ Usage', tls) AS (metric, current_pct)"))
        .withColumn("target_pct", F.lit(float(target_pct)))
        .withColumn(
            "status",
            F.when(current >= target_pct, "Pass").when(current >= target_pct - near_pct, "Near").otherwise("Fail"),
        )
    )


def _headline():
    error = F.col("status_code") >= 400
    return [
        gib(F.sum("bytes")).alias("traffic_gb"),
        F.count(F.lit(1)).alias("total_requests"),
        F.avg("ttfb_ms").alias("avg_ttfb_ms"),
        share(error).alias("error_rate_pct"),
        share(F.col("cache_status") == 1).alias("cache_hit_rate_pct"),
    ]


def exec_kpis(logs: DataFrame, as_of, days=7) -> DataFrame:
    status = F.col("status_code")
    return since_day(logs, as_of, days).agg(
        *_headline(), share((status >= 200) & (status < 400)).alias("availability_pct")
    )


def exec_kpis_daily(logs: DataFrame, as_of, days=90) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.to_date(TS).alias("date"))
        .agg(*_headline(), F.countDistinct("cli_ip").alias("unique_users"))
    )


def log_totals(logs: DataFrame) -> DataFrame:
    return logs.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.countDistinct("country").alias("countries"),
        F.avg("ttfb_ms").alias("avg_ttfb_ms"),
        mib(F.sum("bytes")).alias("total_mb"),
    )


def requests_by_country(logs: DataFrame, limit=10) -> DataFrame:
    return (
        logs.groupBy("country")
        .agg(F.count(F.lit(1)).alias("requests"), F.avg("ttfb_ms").alias("avg_ttfb_ms"))
        .orderBy(F.desc("requests"), "country")
        .limit(limit)
    )


def status_percentages(logs: DataFrame) -> DataFrame:
    """Share of each status; the window runs over one row per status code."""
    return (
        logs.groupBy("status_code")
        .agg(F.count(F.lit(1)).alias("requests"))
        .withColumn("percentage", pct(F.col("requests"), F.sum("requests").over(Window.partitionBy())))
        .orderBy("status_code")
    )


def cache_ratio(logs: DataFrame) -> DataFrame:
    state = F.col("cache_status")
    return logs.agg(
        share(state == 1).alias("cache_hit_ratio_pct"),
        mib(F.sum(F.when(state == 1, F.col("bytes")).otherwise(0))).alias("cached_mb"),
        mib(F.sum(F.when(state == 0, F.col("bytes")).otherwise(0))).alias("origin_mb"),
    )


def traffic_by_country(logs: DataFrame, as_of, days=7) -> DataFrame:
    return since_day(logs, as_of, days).groupBy("country").agg(F.sum("bytes").alias("traffic"))
