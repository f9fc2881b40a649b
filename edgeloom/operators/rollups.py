"""Materialised roll-ups of the access log.

Each takes the log and returns one row per key. All are a single ``groupBy``: partial
aggregation runs before the shuffle, so a hot key arrives as one partial per map task.
Quantiles come from one sketch per key (an array of probabilities, split afterwards).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.classify import browser_class, device_class
from edgeloom.functions.exprs import TS, distinct_next_to_sketch, gib
from edgeloom.operators.enrich import enrich

QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _quantile_sketch(col: str) -> Column:
    return F.percentile_approx(col, list(QUANTILES.values())).alias("_q")


def _split_quantiles(df: DataFrame, suffix: str) -> DataFrame:
    cols = {f"{p}_{suffix}": F.get("_q", F.lit(i)) for i, p in enumerate(QUANTILES)}
    return df.withColumns(cols).drop("_q")


def _window_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "window_start": F.col("hour"),
            "window_end": F.col("hour") + F.expr("INTERVAL 1 HOUR"),
            "processing_timestamp": F.current_timestamp(),
        }
    ).drop("hour")


def hourly_metrics(logs: DataFrame) -> DataFrame:
    """(hour, country, status, cache state) -> volume, latency, errors, hits, visitors."""
    out = (
        enrich(logs)
        .groupBy("hour", "country", "status_code", "cache_status")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.sum("bytes").alias("total_bytes"),
            F.avg("response_time_ms").alias("avg_response_time"),
            F.sum("response_time_ms").alias("response_time_sum"),
            F.count("response_time_ms").alias("response_time_cnt"),
            _quantile_sketch("response_time_ms"),
            F.sum("is_error").alias("error_count"),
            F.sum("is_cache_hit").alias("cache_hits"),
            distinct_next_to_sketch("cli_ip").alias("unique_ips"),
        )
    )
    out = _split_quantiles(out, "response_time")
    hit_rate = F.col("cache_hits") / F.col("request_count")
    return _window_bounds(out.withColumn("cache_hit_rate", hit_rate))


def endpoint_metrics(logs: DataFrame) -> DataFrame:
    """(hour, host, path, method) -> volume, latency, errors, bytes."""
    out = (
        enrich(logs)
        .groupBy("hour", "req_host", "req_path", "req_method")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("response_time_ms").alias("avg_response_time"),
            _quantile_sketch("response_time_ms"),
            F.sum("is_error").alias("error_count"),
            F.sum("bytes").alias("total_bytes"),
        )
    )
    return _window_bounds(_split_quantiles(out, "response_time").drop("p50_response_time"))


def security_events(logs: DataFrame, max_ips: int = 100) -> DataFrame:
    """Errors per (hour, country, status, error code): count, distinct addresses, and up
    to ``max_ips`` source addresses (the first ones in address order).

    The list is a report column that is cut by definition; the counts cover every row.
    Errors are first reduced to (key, address). ``row_number <= max_ips`` is cut inside
    each map task before its shuffle, so neither branch gathers a key's addresses. The
    branches meet in a union, where NULL key parts group like any other value.
    """
    keys = ["hour", "country", "status_code", "error_code"]
    per_ip = (
        enrich(logs)
        .filter(F.col("is_error") == 1)
        .groupBy(*keys, "cli_ip")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Rows without an address go after the ranking, and the count stays in use: else the two
    # branches would differ, and the log would be read and shuffled twice.
    first_ips = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("cli_ip"))
    listed = (
        per_ip.withColumn("rn", F.row_number().over(first_ips))
        .filter((F.col("rn") <= max_ips) & F.col("cli_ip").isNotNull())
        .select(*keys, F.least("n", F.lit(0)).alias("n"), F.lit(0).alias("is_ip"), "cli_ip")
    )
    counted = per_ip.select(
        *keys, "n", F.when(F.col("cli_ip").isNotNull(), 1).otherwise(0).alias("is_ip"),
        F.lit(None).cast("string").alias("cli_ip"),
    )
    out = (
        counted.unionByName(listed)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("event_count"),
            F.sum("is_ip").alias("unique_ips"),
            F.array_join(F.array_sort(F.collect_list("cli_ip")), ",").alias("source_ips"),
        )
    )
    return _window_bounds(out)


def device_metrics(logs: DataFrame) -> DataFrame:
    """(hour, mobile or desktop) -> volume, latency, errors."""
    out = (
        enrich(logs)
        .groupBy("hour", "is_mobile")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("response_time_ms").alias("avg_response_time"),
            F.sum("is_error").alias("error_count"),
        )
        .withColumn("device_type", F.when(F.col("is_mobile") == 1, "Mobile").otherwise("Desktop"))
        .drop("is_mobile")
    )
    return _window_bounds(out)


def performance_metrics(logs: DataFrame) -> DataFrame:
    """(hour, path) -> volume, latency, cache hit rate."""
    out = (
        enrich(logs)
        .groupBy("hour", "req_path")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("response_time_ms").alias("avg_response_time_ms"),
            F.percentile_approx("response_time_ms", 0.95).alias("p95_response_time_ms"),
            F.avg("is_cache_hit").alias("cache_hit_rate"),
        )
    )
    return out


def business_metrics(logs: DataFrame) -> DataFrame:
    """(hour, device, browser) -> volume."""
    return (
        enrich(logs)
        .groupBy("hour", device_class().alias("device_type"), browser_class().alias("browser"))
        .agg(F.count(F.lit(1)).alias("request_count"))
    )


def daily_metrics(logs: DataFrame) -> DataFrame:
    """Date -> volume, visitors, bytes, cache hit rate."""
    return (
        enrich(logs)
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            distinct_next_to_sketch("cli_ip").alias("unique_visitors"),
            F.sum("bytes").alias("total_bytes"),
            F.avg("is_cache_hit").alias("cache_hit_rate"),
        )
    )


def hourly_country(logs: DataFrame) -> DataFrame:
    """(hour, country) -> volume, bytes, first-byte time, throughput, errors, hits."""
    return (
        enrich(logs)
        .groupBy("hour", "country")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.sum("bytes").alias("total_bytes"),
            F.avg("ttfb_ms").alias("avg_ttfb"),
            F.avg("throughput_bps").alias("avg_throughput"),
            F.sum("is_error").alias("error_count"),
            F.sum("is_cache_hit").alias("cache_hits"),
        )
    )


# -- partials that re-aggregate correctly ----------------------------------------------

_HLL_LG_K = 14
_KLL_K = 400


def mergeable_rollup(logs: DataFrame) -> DataFrame:
    """Hourly partials whose measures all merge: sums with counts instead of averages, an
    HLL sketch instead of a distinct count, a KLL sketch instead of percentiles."""
    return (
        enrich(logs)
        .groupBy("hour", "country")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.sum("bytes").alias("total_bytes"),
            F.sum("is_error").alias("error_count"),
            F.sum("is_cache_hit").alias("cache_hits"),
            F.sum("response_time_ms").alias("response_time_sum"),
            F.count("response_time_ms").alias("response_time_cnt"),
            F.hll_sketch_agg("cli_ip", _HLL_LG_K).alias("ip_sketch"),
            F.expr(f"kll_sketch_agg_bigint(CAST(response_time_ms AS BIGINT), {_KLL_K})").alias("rt_sketch"),
        )
    )


def merge_rollup(partials: DataFrame, grain: str = "day", keys: tuple[str, ...] = ()) -> DataFrame:
    """Re-aggregate ``mergeable_rollup`` rows to a coarser grain."""
    out = partials.groupBy(F.date_trunc(grain, "hour").alias("window_start"), *keys).agg(
        F.sum("request_count").alias("request_count"),
        F.sum("total_bytes").alias("total_bytes"),
        F.sum("error_count").alias("error_count"),
        F.sum("cache_hits").alias("cache_hits"),
        (F.sum("response_time_sum") / F.nullif(F.sum("response_time_cnt"), F.lit(0))).alias("avg_response_time"),
        F.hll_sketch_estimate(F.hll_union_agg("ip_sketch")).alias("unique_ips"),
        F.expr("kll_merge_agg_bigint(rt_sketch)").alias("_rt"),
    )
    return out.withColumn(
        "p95_response_time", F.expr("kll_sketch_get_quantile_bigint(_rt, 0.95D)")
    ).drop("_rt")


# -- summaries of the stream generation, batch form ------------------------------------


def weblog_view(logs: DataFrame) -> DataFrame:
    """The columns of the web-log stream, response time in seconds."""
    rt = (F.col("turn_around_time_ms") + F.col("transfer_time_ms")) / F.lit(1000.0)
    return logs.select(
        F.col(TS), F.col("cli_ip").alias("ip"), F.col("req_method").alias("method"),
        F.col("req_path").alias("endpoint"), F.col("status_code").alias("status"),
        rt.alias("response_time"), F.col("user_agent"),
    )


def _latency_and_errors(web: DataFrame, window: str, keys: list[str]) -> DataFrame:
    out = (
        web.groupBy(F.window(TS, window).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("response_time").alias("avg_response_time"),
            F.min("response_time").alias("min_response_time"),
            F.max("response_time").alias("max_response_time"),
            _quantile_sketch("response_time"),
            F.count_if(F.col("status") >= 400).alias("error_count"),
            distinct_next_to_sketch("ip").alias("unique_ips"),
        )
    )
    out = _split_quantiles(out, "response_time").drop("p50_response_time")
    return out.select(F.col("w.start").alias("window_start"), *[c for c in out.columns if c != "w"])


def endpoint_summary(logs: DataFrame, window: str = "30 seconds") -> DataFrame:
    return _latency_and_errors(weblog_view(logs), window, ["endpoint", "method"])


def status_summary(logs: DataFrame, window: str = "30 seconds") -> DataFrame:
    return _latency_and_errors(weblog_view(logs), window, ["status"])


def user_summary(logs: DataFrame, window: str = "30 seconds") -> DataFrame:
    return (
        weblog_view(logs)
        .groupBy(F.window(TS, window).alias("w"), "ip")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.countDistinct("endpoint").alias("endpoints_accessed"),
            F.max(TS).alias("last_seen"),
        )
        .select(F.col("w.start").alias("window_start"), "ip", "request_count", "endpoints_accessed", "last_seen")
    )


def daily_traffic_gib(logs: DataFrame) -> DataFrame:
    return (
        enrich(logs).groupBy("date").agg(gib(F.sum("bytes")).alias("traffic_gb"))
    )
