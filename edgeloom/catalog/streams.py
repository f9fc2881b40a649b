"""Batch forms of the streaming jobs; the tests run the same functions as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.functions import weblog
from edgeloom.functions.exprs import TS
from edgeloom.streaming import windows


def _sized(size):
    return lambda t: windows.endpoint_window(t.logs, size)


def deduplicated(t):
    return windows.first_arrivals(t.replayed_logs.select("req_id", TS), ["req_id", TS])


def routed(t):
    """Lines per schema version, as the version sink files them."""
    parsed, rejected = weblog.parse_access_log(t.logs.select("req_id", weblog.combined_line().alias("line")))
    versions = parsed.groupBy(F.when(F.col("schema_version") >= 2, "v2").otherwise("v1").alias("route"))
    counted = [d.agg(F.count(F.lit(1)).alias("lines")) for d in (versions, rejected.groupBy(F.lit("rejected").alias("route")))]
    return counted[0].unionByName(counted[1])


QUERIES = {
    "stream_endpoint_window": _sized(windows.WINDOW),
    "stream_status_window": lambda t: windows.status_window(t.logs),
    "stream_user_window": lambda t: windows.user_window(t.logs),
    "stream_window_1_minute": _sized("1 minute"),
    "stream_window_5_minutes": _sized("5 minutes"),
    "stream_window_1_hour": _sized("1 hour"),
    "stream_hourly_country": lambda t: windows.hourly_country_window(t.logs),
    "stream_sessions": lambda t: windows.sessions(t.logs, gap="6 hours"),
    "stream_dedup": deduplicated,
    "stream_version_routes": routed,
    "stream_sustained_alerts": lambda t: windows.sustained_alerts(t.logs, ["country"]),
    "stream_alerts": lambda t: windows.window_alerts(windows.endpoint_window(t.logs, "1 hour")),
}
