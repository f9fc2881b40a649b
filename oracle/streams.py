"""Checks of the streaming jobs' batch forms."""


def _window(size: str, keys: str, cte: str = "web") -> str:
    return f"""SELECT time_bucket(INTERVAL '{size}', request_timestamp) AS window_start,
        time_bucket(INTERVAL '{size}', request_timestamp) + INTERVAL '{size}' AS window_end, {keys}, count(*) AS request_count,
        round(avg(response_time), 6) AS avg_response_time, quantile_disc(response_time, 0.95) AS p95_response_time,
        count(*) FILTER (WHERE status >= 400) AS error_count, count(DISTINCT ip) AS unique_ips FROM {cte} GROUP BY ALL"""


_ENDPOINT = "endpoint, method"

SQL = {
    "stream_endpoint_window": _window("30 seconds", _ENDPOINT),
    "stream_status_window": _window("30 seconds", "status"),
    "stream_window_1_minute": _window("1 minute", _ENDPOINT),
    "stream_window_5_minutes": _window("5 minutes", _ENDPOINT),
    "stream_window_1_hour": _window("1 hour", _ENDPOINT),
    "stream_user_window": """SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, ip, count(*) AS request_count,
        count(DISTINCT endpoint) AS endpoints_accessed, max(request_timestamp) AS last_seen FROM web GROUP BY ALL""",
    "stream_hourly_country": """SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, country, count(*) AS request_count,
        CAST(sum(bytes) AS BIGINT) AS total_bytes, round(avg(ttfb_ms), 6) AS avg_ttfb, CAST(sum(is_error) AS BIGINT) AS error_count,
        CAST(sum(is_cache_hit) AS BIGINT) AS cache_hits FROM enriched GROUP BY ALL""",
    "stream_sessions": """SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS requests
        FROM sessions_6h GROUP BY user_id, no""",
    "stream_dedup": "SELECT DISTINCT req_id, request_timestamp FROM replayed_logs",
    "stream_version_routes": """SELECT if(user_id % 3 = 0, 'v2', 'v1') AS route, count(*) AS lines FROM access_logs GROUP BY 1""",
    "stream_sustained_alerts": """WITH b AS (SELECT country, hour, sum(is_error) * 100.0 / count(*) AS pct FROM enriched GROUP BY ALL HAVING pct > 10),
        g AS (SELECT *, CASE WHEN hour - lag(hour) OVER w = INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM b WINDOW w AS (PARTITION BY country ORDER BY hour)),
        r AS (SELECT *, sum(opens) OVER (PARTITION BY country ORDER BY hour) AS run FROM g)
        SELECT country, min(hour) AS breach_start, max(hour) AS breach_end, count(*) AS periods, round(max(pct), 6) AS worst_pct
        FROM r GROUP BY country, run HAVING count(*) >= 2""",
    "stream_alerts": f"""SELECT 'error_rate' AS alert, window_start, endpoint, method, request_count,
        round(error_count * 100.0 / request_count, 6) AS value, 5.0::DOUBLE AS threshold
        FROM ({_window('1 hour', _ENDPOINT)}) WHERE error_count * 100.0 / request_count > 5""",
}
