"""Attack, bot, rule and fraud reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import classify as C
from edgeloom.functions.exprs import TS, mib, n_where, pct, share, since, since_day


def _has_rule():
    return F.col("security_rules") != ""


def attack_sources(logs: DataFrame, as_of, window="5 minutes", min_requests=1000) -> DataFrame:
    return (
        since(logs, as_of, window)
        .groupBy("cli_ip", "country")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.countDistinct("req_path").alias("unique_paths"),
            n_where(F.col("status_code") == 429).alias("rate_limited"),
            F.max(TS).alias("last_seen"),
        )
        .filter(F.col("request_count") > min_requests)
        .orderBy(F.desc("request_count"), "cli_ip", "country")
    )


def bot_traffic(logs: DataFrame, as_of, window="24 hours", min_requests=100) -> DataFrame:
    return (
        since(logs, as_of, window)
        .groupBy("user_agent")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.countDistinct("cli_ip").alias("unique_ips"),
            F.countDistinct("req_path").alias("paths"),
            F.avg("throughput_bps").alias("avg_throughput"),
            mib(F.sum("bytes")).alias("total_mb"),
        )
        .filter(F.col("request_count") > min_requests)
        .withColumn(
            "traffic_type",
            C.traffic_type(F.col("user_agent"), F.col("request_count"), F.col("paths"), F.col("avg_throughput")),
        )
        .drop("paths")
        .orderBy(F.desc("request_count"), "user_agent")
    )


def waf_rule_effectiveness(logs: DataFrame, as_of, window="7 days") -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter(F.col("security_rules").isNotNull() & _has_rule())
        .groupBy("security_rules")
        .agg(
            F.count(F.lit(1)).alias("trigger_count"),
            F.countDistinct("cli_ip").alias("unique_ips"),
            F.countDistinct("country").alias("countries"),
            share(F.col("status_code") == 403).alias("block_rate_pct"),
        )
        .orderBy(F.desc("trigger_count"), "security_rules")
    )


def security_overview(logs: DataFrame, as_of, window="24 hours") -> DataFrame:
    https = F.col("proto") == "HTTPS"
    tls = F.col("tls_version")
    return since(logs, as_of, window, inclusive=True).agg(
        F.count(F.lit(1)).alias("total_requests"),
        n_where(_has_rule()).alias("security_threats"),
        share(_has_rule()).alias("threat_rate"),
        n_where(C.is_bot()).alias("bot_requests"),
        share(C.is_bot()).alias("bot_rate"),
        n_where(https).alias("https_requests"),
        share(https).alias("https_coverage"),
        n_where(tls == "TLSv1.3").alias("tls13_requests"),
        n_where(tls == "TLSv1.2").alias("tls12_requests"),
        n_where(~tls.isin("TLSv1.2", "TLSv1.3")).alias("old_tls_requests"),
    )


def security_daily(logs: DataFrame, as_of, days=90) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.to_date(TS).alias("date"))
        .agg(
            n_where(_has_rule()).alias("threats"),
            share(F.col("proto") == "HTTPS").alias("https_coverage"),
            share(F.col("user_agent").like("%bot%")).alias("bot_rate"),
        )
    )


def threats_by_type(logs: DataFrame, as_of, days=7) -> DataFrame:
    """The country list is a set of country codes, which is small for any traffic."""
    return (
        since_day(logs, as_of, days)
        .filter(_has_rule())
        .groupBy(C.threat_class().alias("threat_type"))
        .agg(
            F.count(F.lit(1)).alias("threat_count"),
            share(F.col("status_code").isin(403, 429)).alias("blocked_rate"),
            F.array_join(F.array_sort(F.collect_set("country")), ", ").alias("top_countries"),
        )
        .orderBy(F.desc("threat_count"), "threat_type")
    )


def geo_risk(logs: DataFrame, as_of, days=7) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy("country")
        .agg(
            n_where(_has_rule()).alias("threats"),
            F.count(F.lit(1)).alias("total_requests"),
            share(_has_rule()).alias("threat_rate"),
        )
        .withColumn("risk_level", C.risk_level(F.col("threats")))
        .orderBy(F.desc("threats"), "country")
    )


def fraud_risk(
    logs: DataFrame, as_of, window="1 hour", min_score=30,
    many_payments=5, many_fast=50, many_ips=3, fast_ms=100,
) -> DataFrame:
    """Risk score per user. Grouping by user alone lets the address-change part count."""
    response_ms = F.col("turn_around_time_ms") + F.col("transfer_time_ms")
    signals = (
        since(logs, as_of, window, inclusive=True)
        .groupBy("user_id")
        .agg(
            F.countDistinct("session_id").alias("sessions"),
            F.count(F.lit(1)).alias("total_requests"),
            F.countDistinct("req_path").alias("unique_endpoints"),
            n_where(F.col("status_code") == 401).alias("failed_auth_attempts"),
            n_where(F.col("req_path").like("%/payment%")).alias("payment_attempts"),
            n_where(response_ms < fast_ms).alias("automated_requests"),
            F.countDistinct("cli_ip").alias("ip_changes"),
        )
    )
    # Points per signal: fixed values.
    score = (
        F.col("failed_auth_attempts") * 10
        + F.when(F.col("payment_attempts") > many_payments, 20).otherwise(0)
        + F.when(F.col("automated_requests") > many_fast, 30).otherwise(0)
        + F.when(F.col("ip_changes") > many_ips, 25).otherwise(0)
    )
    risk = F.col("fraud_risk_score")
    tier = F.when(risk > 70, "High").when(risk > 50, "Medium").when(risk > 30, "Low").otherwise("None")
    return (
        signals.withColumn("fraud_risk_score", score)
        .filter(risk > min_score)
        .withColumn("risk_tier", tier)
        .orderBy(F.desc("fraud_risk_score"), "user_id")
    )


def ddos_sources(logs: DataFrame, as_of, window="1 minute", flood=1000, focused=100, few_paths=3) -> DataFrame:
    response_ms = F.col("turn_around_time_ms") + F.col("transfer_time_ms")
    n = F.col("requests_per_minute")
    return (
        since(logs, as_of, window, inclusive=True)
        .groupBy(F.col("cli_ip").alias("ip"))
        .agg(
            F.count(F.lit(1)).alias("requests_per_minute"),
            F.countDistinct("req_path").alias("unique_endpoints"),
            (F.avg(response_ms) / F.lit(1000.0)).alias("avg_response_time"),
        )
        .filter((n > flood) | ((n > focused) & (F.col("unique_endpoints") < few_paths)))
        .orderBy(F.desc("requests_per_minute"), "ip")
    )
