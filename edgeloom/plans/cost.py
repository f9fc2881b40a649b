"""Caching, transfer cost and savings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import classify as C
from edgeloom.functions.exprs import (
    TS, gib, hour_floor, n_where, pct, share, since, since_day, sum_where,
)

# --- fixed values: US dollars ----------------------------------------------------------
ORIGIN_USD_PER_GIB = 0.10
CDN_USD_PER_GIB = 0.085
SAVED_USD_PER_GIB = 0.15
USD_PER_ERROR = 0.01
REACHABLE_HIT_RATE = 0.95
# --------------------------------------------------------------------------------------


def _hit():
    return F.col("cache_status") == 1


def cache_by_content_type(logs: DataFrame, as_of, window="24 hours") -> DataFrame:
    return (
        since(logs, as_of, window)
        .filter(F.col("status_code") == 200)
        .groupBy("rsp_content_type")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            n_where(_hit()).alias("cache_hits"),
            share(_hit()).alias("hit_rate_pct"),
            gib(F.sum("bytes")).alias("total_gb_served"),
            gib(F.sum(F.when(_hit(), F.col("bytes")).otherwise(0))).alias("cached_gb"),
        )
        .orderBy(F.desc("total_requests"), "rsp_content_type")
    )


def origin_offload(logs: DataFrame, as_of, window="30 days") -> DataFrame:
    hourly = (
        since(logs, as_of, window)
        .groupBy(hour_floor(TS).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            n_where(_hit()).alias("hits"),
            F.sum("bytes").alias("bytes"),
            F.sum(F.when(_hit(), F.col("bytes")).otherwise(0)).alias("cached"),
        )
    )
    cached = gib(F.sum("cached"))
    origin = gib(F.sum(F.col("bytes") - F.col("cached")))
    return hourly.agg(
        F.avg(pct(F.col("hits"), F.col("n"))).alias("avg_hit_rate_pct"),
        cached.alias("total_cached_gb"),
        origin.alias("origin_served_gb"),
        (origin * ORIGIN_USD_PER_GIB).alias("origin_cost_usd"),
        (cached * ORIGIN_USD_PER_GIB).alias("cost_if_not_cached"),
    )


def expensive_traffic(logs: DataFrame, as_of, window="30 days", limit=50) -> DataFrame:
    return (
        since(logs, as_of, window)
        .groupBy("country", "rsp_content_type", "file_size_bucket")
        .agg(F.count(F.lit(1)).alias("request_count"), gib(F.sum("bytes")).alias("total_gb"))
        .withColumn("estimated_cost_usd", F.col("total_gb") * C.price_per_gib())
        .orderBy(F.desc("estimated_cost_usd"), "country", "rsp_content_type", "file_size_bucket")
        .limit(limit)
    )


def daily_cdn_cost(logs: DataFrame, as_of, days=7) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.to_date(TS).alias("date"))
        .agg(
            gib(F.sum("bytes")).alias("traffic_gb"),
            (gib(F.sum("bytes")) * CDN_USD_PER_GIB).alias("cdn_cost_usd"),
            share(_hit()).alias("cache_hit_rate"),
            (gib(sum_where("bytes", _hit())) * SAVED_USD_PER_GIB).alias("bandwidth_saved_usd"),
            (n_where(F.col("status_code") >= 400) * USD_PER_ERROR).alias("error_cost_usd"),
        )
        .orderBy("date")
    )


def business_daily(logs: DataFrame, as_of, days=90) -> DataFrame:
    return daily_cdn_cost(logs, as_of, days).drop("error_cost_usd")


def hourly_cost_pattern(logs: DataFrame, as_of, window="7 days") -> DataFrame:
    """Mean traffic of a whole hour, by hour of day: requests are summed per hour first."""
    hours = since(logs, as_of, window, inclusive=True).groupBy(F.date_trunc("hour", TS).alias("hour")).agg(F.sum("bytes").alias("bytes"))
    return (
        hours.groupBy(F.hour("hour").alias("hour_of_day"))
        .agg(
            gib(F.avg("bytes")).alias("avg_traffic_gb"),
            (gib(F.avg("bytes")) * CDN_USD_PER_GIB).alias("avg_cost_usd"),
        )
        .orderBy("hour_of_day")
    )


def cache_opportunity(logs: DataFrame, as_of, days=30, min_requests=10000) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(C.endpoint_pattern().alias("endpoint_pattern"))
        .agg(
            share(_hit()).alias("cache_hit_rate"),
            (gib(sum_where("bytes", F.col("cache_status") != 1)) * SAVED_USD_PER_GIB * REACHABLE_HIT_RATE).alias(
                "potential_savings_usd"
            ),
            gib(F.sum("bytes")).alias("traffic_gb"),
            F.count(F.lit(1)).alias("requests"),
        )
        .filter(F.col("requests") > min_requests)
        .orderBy(F.desc("potential_savings_usd"), "endpoint_pattern")
    )
