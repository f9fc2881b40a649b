"""Row enrichment of the access log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS, hour_floor, utc_seconds


def flag(cond):
    """1 where ``cond`` holds, else 0, NULL input included."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def enrich(logs: DataFrame, ts: str = TS) -> DataFrame:
    """Add the derived columns every roll-up reads.

    ``response_time_ms`` is NULL when either part is NULL: averages and percentiles skip
    such rows, counts do not. Columns a query does not use are pruned from its plan.
    """
    return logs.withColumns(
        {
            "hour": hour_floor(ts),
            "date": F.to_date(ts),
            "is_error": flag(F.col("status_code") >= 400),
            "is_cache_hit": flag(F.col("cache_status") == 1),
            "response_time_ms": F.col("turn_around_time_ms") + F.col("transfer_time_ms"),
            "is_mobile": flag(F.col("user_agent").like("%Mobile%")),
            "processing_timestamp": F.current_timestamp(),
        }
    )


def from_cdn_layout(raw: DataFrame, *others: str) -> DataFrame:
    """Rename the delivery-log layout to the canonical names; epoch seconds become UTC wall
    clock, whatever the session's zone. Absent columns are simply not mapped; ``others`` are carried along."""
    renames = {
        "reqId": "req_id", "cliIP": "cli_ip", "statusCode": "status_code", "proto": "proto",
        "reqHost": "req_host", "reqMethod": "req_method", "reqPath": "req_path", "UA": "user_agent",
        "queryStr": "query_str", "bytes": "bytes", "objSize": "obj_size",
        "turnAroundTimeMSec": "turn_around_time_ms", "transferTimeMSec": "transfer_time_ms",
        "timeToFirstByte": "ttfb_ms", "downloadTime": "download_time_ms",
        "throughput": "throughput_bps", "cacheStatus": "cache_status", "maxAgeSec": "max_age_sec",
        "country": "country", "city": "city", "errorCode": "error_code", "tlsVersion": "tls_version",
        "securityRules": "security_rules", "ewExecutionInfo": "ew_execution_info",
        "rspContentType": "rsp_content_type", "fileSizeBucket": "file_size_bucket",
        "downloadInitiated": "download_initiated", "downloadsCompleted": "downloads_completed",
        "cookie": "cookie", "xForwardedFor": "x_forwarded_for",
    }
    cols = [F.col(old).alias(new) for old, new in renames.items() if old in raw.columns]
    return raw.select(utc_seconds(F.col("reqTimeSec")).alias(TS), *cols, *others)
