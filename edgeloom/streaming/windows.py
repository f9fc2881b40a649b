"""Event-time windows, sessions and deduplication for batch and streaming frames alike.

A streaming frame needs a watermark, which a batch frame ignores: ``timed`` sets it, and
every function here calls it. State is bounded by the watermark's delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS
from edgeloom.operators.enrich import enrich
from edgeloom.operators.rollups import weblog_view

# --- fixed values: event-time settings --------------------------------------------------
WINDOW, DELAY, SESSION_GAP = "30 seconds", "2 minutes", "30 minutes"
WINDOW_SIZES = ("30 seconds", "1 minute", "5 minutes", "1 hour")
# --------------------------------------------------------------------------------------
SKETCH_LOG2 = 12


def timed(rows: DataFrame, ts: str = TS, delay: str = DELAY) -> DataFrame:
    """``rows`` with ``ts`` as an instant (watermarks refuse zone-free times) and a watermark."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _distinct(col: str) -> Column:
    """Distinct count by a sketch: exact distinct aggregates are not allowed on streams."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(col, F.lit(SKETCH_LOG2)))


def _by_window(rows: DataFrame, window: str, keys: list[str], *aggs: Column) -> DataFrame:
    out = rows.groupBy(F.window(TS, window).alias("w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c not in ("w", *keys)]
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *names)


def _latency() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("request_count"),
        F.avg("response_time").alias("avg_response_time"),
        F.percentile_approx("response_time", 0.95, 10_000).alias("p95_response_time"),
        F.count_if(F.col("status") >= 400).alias("error_count"),
        _distinct("ip").alias("unique_ips"),
    ]


def endpoint_window(logs: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    return _by_window(weblog_view(timed(logs, delay=delay)), window, ["endpoint", "method"], *_latency())


def status_window(logs: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    return _by_window(weblog_view(timed(logs, delay=delay)), window, ["status"], *_latency())


def user_window(logs: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    return _by_window(
        weblog_view(timed(logs, delay=delay)), window, ["ip"],
        F.count(F.lit(1)).alias("request_count"), _distinct("endpoint").alias("endpoints_accessed"), F.max(TS).alias("last_seen"),
    )


def hourly_country_window(logs: DataFrame, delay: str = DELAY) -> DataFrame:
    """The continuous hourly aggregate per country."""
    return _by_window(
        enrich(timed(logs, delay=delay)), "1 hour", ["country"],
        F.count(F.lit(1)).alias("request_count"), F.sum("bytes").alias("total_bytes"), F.avg("ttfb_ms").alias("avg_ttfb"),
        F.sum("is_error").alias("error_count"), F.sum("is_cache_hit").alias("cache_hits"),
    )


def sessions(logs: DataFrame, by: str = "user_id", gap: str = SESSION_GAP, delay: str = DELAY) -> DataFrame:
    """Sessions closed by a pause of more than ``gap``; on a stream a session comes out once
    the watermark has passed its end."""
    out = timed(logs, delay=delay).groupBy(by, F.session_window(TS, gap).alias("w")).agg(F.count(F.lit(1)).alias("requests"), F.max(TS).alias("session_end"))
    return out.select(by, F.col("w.start").alias("session_start"), "session_end", "requests")


def first_arrivals(rows: DataFrame, keys: list[str], delay: str = DELAY, ts: str = TS) -> DataFrame:
    """One row per key: on a stream the first to arrive, with state kept for the delay only."""
    rows = timed(rows, ts, delay)
    return rows.dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def window_alerts(windows: DataFrame, max_error_pct: float = 5.0, min_requests: int = 1) -> DataFrame:
    """Windows with too large a share of errors, as alert rows."""
    pct = F.col("error_count") * 100.0 / F.col("request_count")
    return windows.filter((F.col("request_count") >= min_requests) & (pct > max_error_pct)).select(
        F.lit("error_rate").alias("alert"), "window_start", "endpoint", "method", "request_count", pct.alias("value"), F.lit(max_error_pct).alias("threshold")
    )


def sustained_alerts(
    logs: DataFrame, keys: list[str], window: str = "1 hour", periods: int = 2, max_error_pct: float = 10.0, delay: str = DELAY
) -> DataFrame:
    """Runs of at least ``periods`` windows next to each other with too large a share of errors, as ``sustained_breaches``
    finds them, on a stream as well: breached windows go on to sessions that a window without a breach, or without data, ends. A stream needs
    append mode; a run comes out once the watermark is past the window that could have prolonged it."""
    counted = enrich(timed(logs, delay=delay)).groupBy(F.window(TS, window).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("is_error").alias("error_count")
    )
    pct = F.col("error_count") * 100.0 / F.col("request_count")
    breached = counted.filter(pct > max_error_pct).select(*keys, F.window_time("w").alias("at"), F.col("w.start").alias("start"), pct.alias("pct"))
    runs = breached.groupBy(*keys, F.session_window("at", window).alias("run")).agg(
        F.min("start").alias("breach_start"), F.max("start").alias("breach_end"), F.count(F.lit(1)).alias("periods"), F.max("pct").alias("worst_pct")
    )
    return runs.filter(F.col("periods") >= periods).drop("run")


def above_baseline(windows: DataFrame, baseline: DataFrame, keys: list[str], value: str = "request_count", factor: float = 10.0) -> DataFrame:
    """Windows whose ``value`` is more than ``factor`` times their key's ``baseline``. A key without one is new and has no alert."""
    return windows.join(baseline, keys).filter(F.col(value) > F.col("baseline") * factor)
