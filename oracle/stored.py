"""Checks of what stored roll-ups give: the same as the log gives."""

from oracle import analytics, dashboards

PANELS = [name for name in dashboards.SQL if name.startswith(("biz_", "cust_"))]
SERIES = [
    "requests_per_second", "error_rate_series", "p95_series", "top_endpoints", "busiest_windows", "slow_endpoints", "error_rate_spike",
    "hourly_series", "regrouped_series", "hourly_error_rate", "peak_pattern", "log_totals", "requests_by_country", "status_percentages",
    "cache_ratio", "traffic_7d_by_country",
]
_NOW = "date_trunc('hour', @asof)"
LIVE = f"""WITH usual AS (SELECT country, count(*) / 720.0 AS baseline FROM enriched
    WHERE hour >= {_NOW} - INTERVAL 744 HOUR AND hour < {_NOW} - INTERVAL 24 HOUR GROUP BY country),
    now AS (SELECT hour AS window_start, country, count(*) AS request_count FROM enriched WHERE hour >= {_NOW} - INTERVAL 24 HOUR GROUP BY ALL)
    SELECT window_start, country, request_count, round(baseline, 6) AS baseline FROM now JOIN usual USING (country) WHERE request_count > baseline * 1.2"""
SQL = {"live_baseline": LIVE} | {f"stored_{name}": dashboards.SQL[name] for name in PANELS} | {f"stored_{name}": analytics.SQL[name] for name in SERIES}
