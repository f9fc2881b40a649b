"""Checks of enrichment, classifiers and roll-ups."""

DEVICE = "CASE WHEN user_agent LIKE '%Mobile%' THEN 'Mobile' WHEN user_agent LIKE '%Tablet%' THEN 'Tablet' ELSE 'Desktop' END"
DEVICE4 = """CASE WHEN contains(user_agent, '5G') THEN 'Mobile (5G)'
    WHEN regexp_matches(user_agent, 'Mobile|Android|iPhone') THEN 'Mobile (4G)'
    WHEN regexp_matches(user_agent, 'Tablet|iPad') THEN 'Tablet' ELSE 'Desktop' END"""
BROWSER = """CASE WHEN contains(user_agent, 'Chrome') THEN 'Chrome' WHEN contains(user_agent, 'Safari') THEN 'Safari'
    WHEN contains(user_agent, 'Firefox') THEN 'Firefox' ELSE 'Other' END"""
SPEED = """CASE WHEN throughput_bps > 10000000 THEN 'Fast (>10Mbps)' WHEN throughput_bps > 5000000 THEN 'Medium (5-10Mbps)'
    WHEN throughput_bps > 1000000 THEN 'Slow (1-5Mbps)' ELSE 'Very Slow (<1Mbps)' END"""
CONTENT = """CASE WHEN regexp_matches(req_path, '\\.(mp4|m3u8)$') THEN 'Video' WHEN regexp_matches(req_path, '\\.(jpg|png|gif)$') THEN 'Images'
    WHEN regexp_matches(req_path, '\\.js$') THEN 'JavaScript' WHEN regexp_matches(req_path, '\\.css$') THEN 'CSS'
    WHEN regexp_matches(req_path, '\\.html?$') THEN 'HTML' ELSE 'Other' END"""
PATTERN = """CASE WHEN starts_with(req_path, '/static/images/') THEN '/static/images/*' WHEN starts_with(req_path, '/api/products/') THEN '/api/products/*'
    WHEN starts_with(req_path, '/api/user/') THEN '/api/user/*' WHEN starts_with(req_path, '/static/css/') THEN '/static/css/*'
    WHEN starts_with(req_path, '/api/search') THEN '/api/search' ELSE 'Other' END"""
JOURNEY = """CASE WHEN req_path = '/' THEN '1. Homepage' WHEN starts_with(req_path, '/search') THEN '2. Search'
    WHEN starts_with(req_path, '/product/') THEN '3. Product Detail' WHEN starts_with(req_path, '/cart') THEN '4. Cart'
    WHEN starts_with(req_path, '/checkout') THEN '5. Checkout' WHEN starts_with(req_path, '/payment') THEN '6. Payment'
    WHEN starts_with(req_path, '/confirmation') THEN '7. Confirmation' ELSE 'Other' END"""
IMPACT = """CASE WHEN starts_with(req_path, '/api/checkout') OR starts_with(req_path, '/api/payment') THEN 'Critical'
    WHEN starts_with(req_path, '/api/') THEN 'High' WHEN starts_with(req_path, '/static/') THEN 'Medium' ELSE 'Low' END"""
REGION = """CASE WHEN country IN ('US','CA','MX') THEN 'North America' WHEN country IN ('GB','DE','FR','ES','IT') THEN 'Europe'
    WHEN country IN ('CN','JP','IN','SG','AU') THEN 'Asia Pacific' WHEN country IN ('BR','AR','CL') THEN 'South America' ELSE 'Other' END"""
PRICE = """CASE WHEN country IN ('US','CA','EU') THEN 0.085 WHEN country IN ('JP','AU','IN') THEN 0.14
    WHEN country IN ('SA','AF') THEN 0.17 ELSE 0.2 END::DOUBLE"""
THREAT = """CASE WHEN contains(security_rules, 'SQL') THEN 'SQL Injection' WHEN contains(security_rules, 'XSS') THEN 'XSS Attempts'
    WHEN contains(security_rules, 'BOT') THEN 'Bot Attacks' WHEN contains(security_rules, 'DDOS') THEN 'DDoS Attempts'
    WHEN contains(security_rules, 'PATH') THEN 'Path Traversal' WHEN contains(security_rules, 'RATE') THEN 'Rate Limit Exceeded' ELSE 'Other' END"""


def _per_label(name: str, expr: str) -> str:
    return f"SELECT {expr} AS {name}, count(*) AS requests FROM access_logs GROUP BY 1"


_SUMMARY_COLS = """window_start, {keys}, request_count, round(avg_response_time, 6) AS avg_response_time,
       round(min_response_time, 6) AS min_response_time, round(max_response_time, 6) AS max_response_time,
       round(p95_response_time, 6) AS p95_response_time, round(p99_response_time, 6) AS p99_response_time,
       error_count, unique_ips"""

SQL = {
    "enrich": "SELECT req_id, request_timestamp, hour, date, is_error, is_cache_hit, response_time_ms, is_mobile FROM enriched",
    "classify_requests": f"""SELECT req_id, {DEVICE} AS device_type, {DEVICE4} AS device_network, {BROWSER} AS browser,
        {SPEED} AS network_speed, {CONTENT} AS content_type, {PATTERN} AS endpoint_pattern, {JOURNEY} AS journey_step,
        {IMPACT} AS impact, {REGION} AS region, {PRICE} AS usd_per_gib, {THREAT} AS threat_type FROM access_logs""",
    "device_class": _per_label("device_type", DEVICE),
    "device_network_class": _per_label("device_type", DEVICE4),
    "browser_class": _per_label("browser", BROWSER),
    "network_speed": _per_label("network_speed", SPEED),
    "content_class": _per_label("content_type", CONTENT),
    "endpoint_pattern": _per_label("endpoint_pattern", PATTERN),
    "journey_step_class": _per_label("journey_step", JOURNEY),
    "impact_class": _per_label("impact", IMPACT),
    "region_of_country": _per_label("region", REGION),
    "price_tier": _per_label("usd_per_gib", PRICE),
    "threat_class": _per_label("threat_type", THREAT),
    "edgeworker_fields": """SELECT req_id, left(ew_execution_info, 50) AS edgeworker_id,
        TRY_CAST(split_part(split_part(ew_execution_info, ':', 7), '|', 1) AS INT) AS duration_ms FROM access_logs""",
    "url_decode": "SELECT req_id, concat('q=user ', user_id, '/item&n=', req_id % 50) AS query FROM access_logs",
    "redact_secrets": """SELECT doc_id, concat(regexp_replace(regexp_replace(regexp_replace(text,
        'password=\\S+', 'password=***', 'g'), 'token=\\S+', 'token=***', 'g'), 'key=\\S+', 'key=***', 'g'),
        ' password=*** token=*** key=*** end') AS text FROM documents""",
    "anonymize_older_than": """SELECT req_id,
        if(request_timestamp < @asof - INTERVAL 7 DAY, 'ANONYMIZED', cli_ip) AS cli_ip,
        if(request_timestamp < @asof - INTERVAL 7 DAY, NULL, cookie) AS cookie,
        if(request_timestamp < @asof - INTERVAL 7 DAY, NULL, x_forwarded_for) AS x_forwarded_for FROM access_logs""",
    "json_encode": """SELECT req_id, concat('{"req_id":', req_id, ',"cli_ip":"', cli_ip, '","req_path":"', req_path, '","status_code":', status_code,
        CASE WHEN error_code IS NULL THEN '' ELSE concat(',"error_code":"', error_code, '"') END, '}') AS value FROM access_logs""",
    "hourly_metrics": """SELECT window_start, window_end, country, status_code, cache_status, request_count, total_bytes,
        round(avg_response_time, 6) AS avg_response_time, response_time_sum, response_time_cnt, p50_response_time,
        p95_response_time, p99_response_time, error_count, cache_hits, round(cache_hit_rate, 6) AS cache_hit_rate, unique_ips
        FROM hourly_metrics""",
    "endpoint_metrics": """SELECT window_start, window_end, req_host, req_path, req_method, request_count,
        round(avg_response_time, 6) AS avg_response_time, p95_response_time, p99_response_time, error_count, total_bytes
        FROM endpoint_metrics""",
    "security_events": """WITH errs AS (SELECT * FROM enriched WHERE is_error = 1),
        ips AS (SELECT DISTINCT hour, country, status_code, error_code, cli_ip FROM errs),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY hour, country, status_code, error_code ORDER BY cli_ip) AS rn FROM ips),
        lists AS (SELECT hour, country, status_code, error_code, count(*) AS unique_ips,
                  string_agg(cli_ip, ',' ORDER BY cli_ip) FILTER (WHERE rn <= 100) AS source_ips
                  FROM ranked GROUP BY ALL),
        counts AS (SELECT hour, country, status_code, error_code, count(*) AS event_count FROM errs GROUP BY ALL)
        SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end, country, status_code, error_code, event_count, unique_ips, source_ips
        FROM counts JOIN lists USING (hour, country, status_code, error_code)""",
    "device_metrics": """SELECT hour AS window_start, hour + INTERVAL 1 HOUR AS window_end,
        CASE is_mobile WHEN 1 THEN 'Mobile' ELSE 'Desktop' END AS device_type, count(*) AS request_count,
        round(avg(response_time_ms), 6) AS avg_response_time, CAST(sum(is_error) AS BIGINT) AS error_count
        FROM enriched GROUP BY hour, is_mobile""",
    "performance_metrics": """SELECT hour, req_path, request_count, round(avg_response_time_ms, 6) AS avg_response_time_ms,
        p95_response_time_ms, round(cache_hit_rate, 6) AS cache_hit_rate FROM performance_metrics""",
    "business_metrics": "SELECT * FROM business_metrics",
    "daily_metrics": "SELECT date, total_requests, unique_visitors, total_bytes, round(cache_hit_rate, 6) AS cache_hit_rate FROM daily_metrics",
    "hourly_country": """SELECT hour, country, request_count, total_bytes, round(avg_ttfb, 6) AS avg_ttfb,
        round(avg_throughput, 6) AS avg_throughput, error_count, cache_hits FROM hourly_country""",
    "mergeable_rollup": """SELECT date_trunc('day', request_timestamp) AS window_start, count(*) AS request_count,
        CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(is_error) AS BIGINT) AS error_count,
        CAST(sum(is_cache_hit) AS BIGINT) AS cache_hits, round(avg(response_time_ms), 6) AS avg_response_time,
        true AS unique_ips_within_2_pct FROM enriched GROUP BY 1""",
    "mergeable_rollup_quantiles": """SELECT date_trunc('month', request_timestamp) AS window_start, country, count(*) AS request_count,
        true AS p95_rank_within_1_pct FROM enriched GROUP BY 1, 2""",
    "endpoint_summary": f"SELECT {_SUMMARY_COLS.format(keys='endpoint, method')} FROM endpoint_summary",
    "status_summary": f"SELECT {_SUMMARY_COLS.format(keys='status')} FROM status_summary",
    "user_summary": "SELECT * FROM user_summary",
    "salted_aggregation": """SELECT req_path, count(*) AS request_count, CAST(sum(bytes) AS BIGINT) AS total_bytes,
        CAST(sum(is_error) AS BIGINT) AS error_count FROM enriched GROUP BY req_path""",
}
