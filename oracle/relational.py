"""Checks of filters, joins, windows, set operations and retention."""

HOURLY_COUNTRY = """(SELECT date_trunc('hour', request_timestamp) AS hour, country, count(*) AS requests,
    100.0 * count(*) FILTER (WHERE status_code >= 400) / count(*) AS error_pct FROM access_logs GROUP BY 1, 2)"""
IP = """(split_part(cli_ip, '.', 1)::BIGINT * 16777216 + split_part(cli_ip, '.', 2)::BIGINT * 65536
    + split_part(cli_ip, '.', 3)::BIGINT * 256 + split_part(cli_ip, '.', 4)::BIGINT)"""
NET = "(203::BIGINT * 16777216)"

SQL = {
    "filter_relative_window": "SELECT req_id, request_timestamp FROM access_logs WHERE request_timestamp > @asof - INTERVAL 24 HOUR",
    "filter_bounded_range": """SELECT req_id, request_timestamp FROM access_logs
        WHERE CAST(request_timestamp AS DATE) = CAST(@asof AS DATE) - 1""",
    "filter_predicates": """SELECT req_id, country, ttfb_ms, req_path FROM access_logs WHERE req_method = 'GET' AND country IN ('US', 'DE', 'FR')
        AND tls_version <> 'TLSv1.0' AND ttfb_ms >= 100 AND ttfb_ms <= 2500 AND starts_with(req_path, '/') AND NOT contains(req_path, '/health')
        AND user_agent LIKE '%Mozilla%' AND turn_around_time_ms IS NOT NULL AND security_rules IS NOT NULL AND length(rsp_content_type) > 0""",
    "filter_having": """SELECT city, count(*) AS n, round(avg(ttfb_ms), 6) AS avg_ttfb FROM access_logs GROUP BY city
        HAVING count(*) > 10 AND avg(ttfb_ms) > 1400""",
    "filter_errors": "SELECT req_id, status_code, error_code FROM access_logs WHERE status_code >= 400",
    "point_lookup": """SELECT req_id, request_timestamp, req_path, status_code FROM access_logs
        WHERE cli_ip = '203.0.0.10' AND request_timestamp >= @asof - INTERVAL 7 DAY""",
    "retention_split": """SELECT CAST(request_timestamp AS DATE) AS date, count(*) AS rows,
        if(request_timestamp < @asof - INTERVAL 15 DAY, 'archive', 'keep') AS placed FROM access_logs GROUP BY 1, 3""",
    "tier_assignment": """WITH a AS (SELECT CAST(date_diff('day', CAST(request_timestamp AS DATE), CAST(@asof AS DATE)) AS INT) AS age_days FROM access_logs)
        SELECT CASE WHEN age_days <= 7 THEN 'hot' WHEN age_days <= 90 THEN 'warm' ELSE 'cold' END AS tier, age_days, count(*) AS rows FROM a GROUP BY 1, 2""",
    "geo_enrichment": """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "ip_range_lookup": f"""SELECT req_id, cli_ip, CASE WHEN split_part(cli_ip, '.', 3) = '2' THEN 'around'
        WHEN split_part(cli_ip, '.', 4)::INT <= 127 THEN 'low-' || regexp_replace(cli_ip, '\\.\\d+$', '')
        ELSE 'high-' || regexp_replace(cli_ip, '\\.\\d+$', '') END AS geo FROM access_logs""",
    "logs_vs_hourly": """SELECT l.country, count(*) AS requests, count(*) FILTER (WHERE ttfb_ms > avg_ttfb) AS slower, max(request_count) AS busiest_hour
        FROM access_logs l JOIN hourly_country h ON h.hour = date_trunc('hour', request_timestamp) AND h.country = l.country GROUP BY 1""",
    "only_new_rows": """WITH sent AS (SELECT req_id, request_timestamp AS created_at FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 1 DAY
        UNION ALL SELECT req_id, request_timestamp + INTERVAL 9 DAY FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 10 DAY)
        SELECT req_id, min(created_at) AS created_at FROM sent WHERE req_id NOT IN
        (SELECT req_id FROM access_logs WHERE request_timestamp < @asof - INTERVAL 1 DAY) GROUP BY req_id""",
    "rate_vs_baseline": """WITH r AS (SELECT city, count(*) FILTER (WHERE request_timestamp >= @asof - INTERVAL 24 HOUR) / 24.0 AS c,
        count(*) FILTER (WHERE request_timestamp < @asof - INTERVAL 24 HOUR) / 696.0 AS b
        FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 30 DAY GROUP BY city)
        SELECT city, round(c, 6) AS current_rate, round(b, 6) AS baseline_rate FROM r WHERE c > b * 1.2""",
    "latency_vs_baseline": """WITH l AS (SELECT city, turn_around_time_ms + transfer_time_ms AS ms, request_timestamp >= @asof - INTERVAL 24 HOUR AS cur
        FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 30 DAY),
        r AS (SELECT city, avg(ms) FILTER (WHERE cur) AS c, avg(ms) FILTER (WHERE NOT cur) AS b FROM l GROUP BY city)
        SELECT city, round(c, 6) AS current_ms, round(b, 6) AS baseline_ms FROM r WHERE c > b * 1.02""",
    "dedup_latest": """SELECT req_id, request_timestamp, created_at, cli_ip, error_code FROM (SELECT *, row_number() OVER
        (PARTITION BY req_id, request_timestamp ORDER BY created_at DESC) AS rn FROM replayed_logs) WHERE rn = 1""",
    "rate_limit_violations": """WITH s AS (SELECT cli_ip, date_trunc('second', request_timestamp) AS second FROM access_logs),
        w AS (SELECT *, count(*) OVER (PARTITION BY cli_ip ORDER BY second RANGE BETWEEN INTERVAL 21599 SECOND PRECEDING AND CURRENT ROW) AS n FROM s)
        SELECT cli_ip, second, count(*) AS requests, max(n) AS requests_in_window, least(count(*), max(n) - 3) AS refused FROM w WHERE n > 3 GROUP BY 1, 2""",
    "admitted_requests": """WITH RECURSIVE counts AS (SELECT cli_ip, date_trunc('second', request_timestamp) AS second, count(*) AS n FROM access_logs GROUP BY ALL),
        ordered AS (SELECT *, epoch(second)::BIGINT AS s, row_number() OVER (PARTITION BY cli_ip ORDER BY second) AS i FROM counts),
        fold AS (SELECT cli_ip, second, i, n, least(n, 3) AS a, [{'s': s, 'a': least(n, 3)}] AS kept FROM ordered WHERE i = 1
        UNION ALL SELECT cli_ip, second, i, n, a, list_append(inside, {'s': s, 'a': a}) FROM (
            SELECT *, greatest(0, least(n, 3 - coalesce(list_sum([x.a FOR x IN inside]), 0)))::BIGINT AS a FROM (
                SELECT o.cli_ip, o.second, o.i, o.n, o.s, list_filter(f.kept, lambda x: x.s > o.s - 21600) AS inside
                FROM fold f JOIN ordered o ON o.cli_ip = f.cli_ip AND o.i = f.i + 1)))
        SELECT cli_ip, second, n AS requests, a AS admitted, n - a AS refused FROM fold""",
    "sustained_breaches": f"""WITH b AS (SELECT * FROM {HOURLY_COUNTRY} WHERE error_pct > 10),
        g AS (SELECT *, CASE WHEN hour - lag(hour) OVER w = INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM b WINDOW w AS (PARTITION BY country ORDER BY hour)),
        r AS (SELECT *, sum(opens) OVER (PARTITION BY country ORDER BY hour) AS run FROM g)
        SELECT country, min(hour) AS breach_start, max(hour) AS breach_end, count(*) AS periods FROM r GROUP BY country, run HAVING count(*) >= 2""",
    "trailing_baseline": f"""WITH b AS (SELECT country, hour, requests, avg(requests) OVER
        (PARTITION BY country ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS baseline FROM {HOURLY_COUNTRY})
        SELECT country, hour, requests, round(baseline, 6) AS baseline, coalesce(requests > baseline * 2, false) AS is_spike FROM b""",
    "latency_trend_anomalies": """WITH s AS (SELECT hour, req_path, avg(response_time_ms) AS latency,
        (epoch_us(hour) - epoch_us(@asof)) / 1e6 / 3600 AS x FROM enriched GROUP BY hour, req_path),
        f AS (SELECT req_path, regr_slope(latency, x) AS m, regr_intercept(latency, x) AS c FROM s WHERE hour < @asof - INTERVAL 24 HOUR GROUP BY 1)
        SELECT req_path, hour, round(latency, 6) AS actual, round(c + m * x, 6) AS predicted,
        coalesce(latency > (c + m * x) * 1.2, false) AS is_anomaly FROM s JOIN f USING (req_path) WHERE hour >= @asof - INTERVAL 24 HOUR""",
    "share_of_total": "SELECT req_path, count(*) AS requests, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM access_logs GROUP BY 1",
    "previous_period": """WITH h AS (SELECT date_trunc('hour', request_timestamp) AS hour, count(*) AS requests FROM access_logs GROUP BY 1)
        SELECT hour, requests, lag(requests) OVER w AS previous, round((requests - lag(requests) OVER w) * 100.0 / lag(requests) OVER w, 6) AS change_pct
        FROM h WINDOW w AS (ORDER BY hour)""",
    "top_k_per_group": """SELECT country, cli_ip, requests, CAST(rank AS INT) AS rank FROM (SELECT country, cli_ip, count(*) AS requests,
        row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, cli_ip) AS rank FROM access_logs GROUP BY 1, 2) WHERE rank <= 3""",
    "union_files": "SELECT req_host, count(*) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes FROM access_logs GROUP BY 1",
    "union_versions": """SELECT req_id, cli_ip AS ip, req_path AS endpoint, if(user_id % 2 = 1, country, NULL) AS region,
        if(user_id % 2 = 1, user_id, NULL) AS user_id, CAST(1 + user_id % 2 AS INT) AS schema_version FROM access_logs""",
    "backfill_versions": """SELECT req_id, cli_ip AS ip, req_path AS endpoint, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS BIGINT) AS user_id
        FROM access_logs WHERE user_id % 2 = 0""",
    "table_counts": """SELECT 'endpoint_summary' AS table_name, count(*) AS count FROM endpoint_summary WHERE window_start >= @asof - INTERVAL 24 HOUR
        UNION ALL SELECT 'status_summary', count(*) FROM status_summary WHERE window_start >= @asof - INTERVAL 24 HOUR
        UNION ALL SELECT 'user_summary', count(*) FROM user_summary WHERE window_start >= @asof - INTERVAL 24 HOUR""",
    "duplicate_ids": "SELECT req_id, count(*) AS count FROM replayed_logs GROUP BY 1 HAVING count(*) > 1",
    "daily_duplicates": """SELECT CAST(created_at AS DATE) AS date, count(*) AS total_records, count(DISTINCT req_id) AS unique_records,
        count(*) - count(DISTINCT req_id) AS duplicates FROM replayed_logs GROUP BY 1""",
}
