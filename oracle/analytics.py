"""Checks of the analytical queries."""

from oracle.tables import BROWSER, CONTENT, DEVICE, DEVICE4, IMPACT, JOURNEY, PATTERN, PRICE, REGION, SPEED, THREAT  # noqa: F401

GIB = 1073741824.0
MIB = 1048576.0
RT = "(turn_around_time_ms + transfer_time_ms)"
MOBILE = "regexp_matches(user_agent, 'Mobile|Android|iPhone')"
BOT = "regexp_matches(user_agent, 'bot|crawler')"


def within(span: str, table: str = "access_logs", ts: str = "request_timestamp", op: str = ">") -> str:
    return f"(SELECT * FROM {table} WHERE {ts} {op} @asof - INTERVAL {span})"


def days(n: int) -> str:
    return f"(SELECT * FROM access_logs WHERE CAST(request_timestamp AS DATE) >= CAST(@asof AS DATE) - {n})"


def share(cond: str) -> str:
    return f"round(100.0 * count(*) FILTER (WHERE {cond}) / count(*), 6)"


SQL = {
    "slowest_paths": f"""SELECT req_path, req_host, count(*) AS request_count, round(avg(ttfb_ms), 6) AS avg_ttfb_ms,
        round(quantile_cont(ttfb_ms, 0.95), 6) AS p95_ttfb_ms, round(avg(throughput_bps), 6) AS avg_throughput_bps
        FROM {within('7 DAY')} WHERE status_code = 200 GROUP BY ALL HAVING count(*) > 5
        ORDER BY avg(ttfb_ms) DESC, req_path, req_host LIMIT 20""",
    "geo_performance": f"""SELECT country, city, count(*) AS requests, round(avg(ttfb_ms), 6) AS avg_ttfb_ms,
        round(avg(download_time_ms), 6) AS avg_download_ms, {share('status_code >= 400')} AS error_rate_pct
        FROM {within('7 DAY')} GROUP BY country, city HAVING count(*) > 10""",
    "download_completion": f"""SELECT rsp_content_type, file_size_bucket, country, count(*) AS total_downloads,
        CAST(sum(download_initiated) AS BIGINT) AS initiated, CAST(sum(downloads_completed) AS BIGINT) AS completed,
        round(sum(downloads_completed) * 100.0 / sum(download_initiated), 6) AS completion_rate_pct,
        round(avg(download_time_ms), 6) AS avg_download_ms
        FROM {within('7 DAY')} WHERE download_initiated = 1 GROUP BY ALL HAVING sum(download_initiated) > 5""",
    "errors_by_device": f"""SELECT {DEVICE} AS device_type, status_code, error_code, count(*) AS error_count,
        count(DISTINCT cli_ip) AS affected_users, round(avg(ttfb_ms), 6) AS avg_ttfb_ms
        FROM {within('7 DAY')} WHERE status_code >= 400 GROUP BY 1, 2, 3""",
    "perf_by_device_network": f"""SELECT {DEVICE} AS device, {SPEED} AS network_speed, count(*) AS request_count,
        round(avg(ttfb_ms), 6) AS avg_ttfb_ms, round(avg(download_time_ms), 6) AS avg_download_ms,
        round(quantile_cont(download_time_ms, 0.95), 6) AS p95_download_ms
        FROM {within('7 DAY')} WHERE status_code = 200 AND download_initiated = 1 GROUP BY 1, 2""",
    "perf_by_region": f"""SELECT {REGION} AS region, round(avg(ttfb_ms), 6) AS avg_ttfb_ms, round(sum(bytes) / {GIB}, 6) AS traffic_gb,
        count(DISTINCT cli_ip) AS unique_users FROM {within('24 HOUR', op='>=')} GROUP BY 1""",
    "perf_by_device_share": f"""SELECT {DEVICE4} AS device_type, round(avg(ttfb_ms), 6) AS avg_ttfb_ms,
        round(avg(download_time_ms) / 1000, 6) AS avg_download_sec, round(avg(ttfb_ms + download_time_ms) / 1000, 6) AS avg_total_sec,
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct_of_traffic FROM {within('7 DAY', op='>=')} GROUP BY 1""",
    "journey_steps": f"""SELECT {JOURNEY} AS journey_step, round(avg(ttfb_ms + download_time_ms) / 1000, 6) AS avg_time_sec,
        {share('status_code >= 400 OR ttfb_ms + download_time_ms > 5000')} AS abandon_rate FROM {days(7)} GROUP BY 1""",
    "ux_summary": f"""SELECT round(avg(ttfb_ms + download_time_ms) / 1000, 6) AS avg_page_load_sec,
        count(*) FILTER (WHERE {MOBILE}) AS mobile_requests, count(*) FILTER (WHERE NOT {MOBILE}) AS desktop_requests,
        count(*) FILTER (WHERE {BROWSER} = 'Chrome') AS chrome_users, count(*) FILTER (WHERE {BROWSER} = 'Safari') AS safari_users,
        count(*) FILTER (WHERE user_agent LIKE '%Firefox%') AS firefox_users, {share('status_code >= 400')} AS error_rate,
        {share('ttfb_ms + download_time_ms > 3000')} AS slow_request_rate,
        round(5 - avg(ttfb_ms + download_time_ms) / 2000 - count(*) FILTER (WHERE status_code >= 400) * 1000.0 / count(*), 6) AS satisfaction_score
        FROM {within('24 HOUR', op='>=')}""",
    "ux_daily": f"""SELECT CAST(request_timestamp AS DATE) AS date, round(avg(ttfb_ms + download_time_ms) / 1000, 6) AS avg_page_load_sec,
        {share("user_agent LIKE '%Mobile%'")} AS mobile_pct, {share('status_code >= 400')} AS error_rate FROM {days(90)} GROUP BY 1""",
    "endpoint_health": f"""SELECT round(avg({RT} / 1000.0), 6) AS avg_latency, round(max({RT} / 1000.0), 6) AS max_latency,
        {share('status_code >= 400')} AS error_rate FROM {within('7 DAY', op='>=')} WHERE req_path = '/signup/payment'""",
    "top_errors": f"""SELECT req_path, status_code, count(*) AS error_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct_of_errors,
        {IMPACT} AS impact FROM {within('7 DAY', op='>=')} WHERE status_code >= 400 GROUP BY req_path, status_code
        ORDER BY error_count DESC, req_path, status_code LIMIT 10""",
    "slowest_30d": f"""SELECT req_path AS endpoint, round(avg(ttfb_ms), 6) AS avg_ttfb FROM {days(30)} GROUP BY req_path
        ORDER BY avg(ttfb_ms) DESC, req_path LIMIT 10""",
    "cache_by_content_type": f"""SELECT rsp_content_type, count(*) AS total_requests, count(*) FILTER (WHERE cache_status = 1) AS cache_hits,
        {share('cache_status = 1')} AS hit_rate_pct, round(sum(bytes) / {GIB}, 6) AS total_gb_served,
        round(coalesce(sum(bytes) FILTER (WHERE cache_status = 1), 0) / {GIB}, 6) AS cached_gb
        FROM {within('24 HOUR')} WHERE status_code = 200 GROUP BY rsp_content_type""",
    "origin_offload": f"""WITH h AS (SELECT date_trunc('hour', request_timestamp) AS hour, count(*) AS n, sum(cache_status) AS hits,
        sum(bytes) AS b, sum(bytes * cache_status) AS c FROM {within('30 DAY')} GROUP BY 1)
        SELECT round(avg(hits * 100.0 / n), 6) AS avg_hit_rate_pct, round(sum(c) / {GIB}, 6) AS total_cached_gb,
        round(sum(b - c) / {GIB}, 6) AS origin_served_gb, round(sum(b - c) / {GIB} * 0.1::DOUBLE, 6) AS origin_cost_usd,
        round(sum(c) / {GIB} * 0.1::DOUBLE, 6) AS cost_if_not_cached FROM h""",
    "expensive_traffic": f"""SELECT country, rsp_content_type, file_size_bucket, request_count, round(gb, 6) AS total_gb,
        round(gb * usd, 6) AS estimated_cost_usd FROM (SELECT country, rsp_content_type, file_size_bucket, count(*) AS request_count,
        sum(bytes) / {GIB} AS gb, {PRICE} AS usd FROM {within('30 DAY')} GROUP BY country, rsp_content_type, file_size_bucket)
        ORDER BY gb * usd DESC, country, rsp_content_type, file_size_bucket LIMIT 50""",
    "daily_cdn_cost": f"""SELECT CAST(request_timestamp AS DATE) AS date, round(sum(bytes) / {GIB}, 6) AS traffic_gb,
        round(sum(bytes) / {GIB} * 0.085::DOUBLE, 6) AS cdn_cost_usd, {share('cache_status = 1')} AS cache_hit_rate,
        round(sum(bytes) FILTER (WHERE cache_status = 1) / {GIB} * 0.15::DOUBLE, 6) AS bandwidth_saved_usd,
        round(count(*) FILTER (WHERE status_code >= 400) * 0.01::DOUBLE, 6) AS error_cost_usd FROM {days(7)} GROUP BY 1""",
    "business_daily": f"""SELECT CAST(request_timestamp AS DATE) AS date, round(sum(bytes) / {GIB}, 6) AS traffic_gb,
        round(sum(bytes) / {GIB} * 0.085::DOUBLE, 6) AS cdn_cost_usd, {share('cache_status = 1')} AS cache_hit_rate,
        round(sum(bytes) FILTER (WHERE cache_status = 1) / {GIB} * 0.15::DOUBLE, 6) AS bandwidth_saved_usd FROM {days(90)} GROUP BY 1""",
    "hourly_cost_pattern": f"""SELECT CAST(hour(h) AS INT) AS hour_of_day, round(avg(b) / {GIB}, 6) AS avg_traffic_gb, round(avg(b) / {GIB} * 0.085::DOUBLE, 6) AS avg_cost_usd
        FROM (SELECT date_trunc('hour', request_timestamp) AS h, CAST(sum(bytes) AS BIGINT) AS b FROM {within('7 DAY', op='>=')} GROUP BY 1) GROUP BY 1""",
    "cache_opportunity": f"""SELECT {PATTERN} AS endpoint_pattern, {share('cache_status = 1')} AS cache_hit_rate,
        round(sum(bytes) FILTER (WHERE cache_status <> 1) / {GIB} * 0.15::DOUBLE * 0.95::DOUBLE, 6) AS potential_savings_usd,
        round(sum(bytes) / {GIB}, 6) AS traffic_gb, count(*) AS requests FROM {days(30)} GROUP BY 1 HAVING count(*) > 100""",
    "attack_sources": f"""SELECT cli_ip, country, count(*) AS request_count, count(DISTINCT req_path) AS unique_paths,
        count(*) FILTER (WHERE status_code = 429) AS rate_limited, max(request_timestamp) AS last_seen
        FROM {within('7 DAY')} GROUP BY cli_ip, country HAVING count(*) > 10""",
    "bot_traffic": f"""SELECT user_agent, count(*) AS request_count, count(DISTINCT cli_ip) AS unique_ips,
        round(avg(throughput_bps), 6) AS avg_throughput, round(sum(bytes) / {MIB}, 6) AS total_mb,
        CASE WHEN {BOT} THEN 'Known Bot' WHEN count(*) // count(DISTINCT req_path) < 2 THEN 'Scraper'
             WHEN avg(throughput_bps) > 50000000 THEN 'High-Speed Bot' ELSE 'Likely Human' END AS traffic_type
        FROM {within('24 HOUR')} GROUP BY user_agent HAVING count(*) > 5""",
    "waf_rule_effectiveness": f"""SELECT security_rules, count(*) AS trigger_count, count(DISTINCT cli_ip) AS unique_ips,
        count(DISTINCT country) AS countries, {share('status_code = 403')} AS block_rate_pct
        FROM {within('7 DAY')} WHERE security_rules <> '' GROUP BY security_rules""",
    "security_overview": f"""SELECT count(*) AS total_requests, count(*) FILTER (WHERE security_rules <> '') AS security_threats,
        {share("security_rules <> ''")} AS threat_rate, count(*) FILTER (WHERE {BOT}) AS bot_requests, {share(BOT)} AS bot_rate,
        count(*) FILTER (WHERE proto = 'HTTPS') AS https_requests, {share("proto = 'HTTPS'")} AS https_coverage,
        count(*) FILTER (WHERE tls_version = 'TLSv1.3') AS tls13_requests, count(*) FILTER (WHERE tls_version = 'TLSv1.2') AS tls12_requests,
        count(*) FILTER (WHERE tls_version NOT IN ('TLSv1.2', 'TLSv1.3')) AS old_tls_requests FROM {within('24 HOUR', op='>=')}""",
    "security_daily": f"""SELECT CAST(request_timestamp AS DATE) AS date, count(*) FILTER (WHERE security_rules <> '') AS threats,
        {share("proto = 'HTTPS'")} AS https_coverage, {share("user_agent LIKE '%bot%'")} AS bot_rate FROM {days(90)} GROUP BY 1""",
    "threats_by_type": f"""SELECT {THREAT} AS threat_type, count(*) AS threat_count, {share('status_code IN (403, 429)')} AS blocked_rate,
        string_agg(DISTINCT country, ', ' ORDER BY country) AS top_countries FROM {days(7)} WHERE security_rules <> '' GROUP BY 1""",
    "geo_risk": f"""SELECT country, count(*) FILTER (WHERE security_rules <> '') AS threats, count(*) AS total_requests,
        {share("security_rules <> ''")} AS threat_rate, CASE WHEN count(*) FILTER (WHERE security_rules <> '') > 100 THEN 'High Risk'
        WHEN count(*) FILTER (WHERE security_rules <> '') >= 10 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level
        FROM {days(7)} GROUP BY country""",
    "fraud_risk": f"""WITH s AS (SELECT user_id, count(DISTINCT session_id) AS sessions, count(*) AS total_requests,
        count(DISTINCT req_path) AS unique_endpoints, count(*) FILTER (WHERE status_code = 401) AS failed_auth_attempts,
        count(*) FILTER (WHERE contains(req_path, '/payment')) AS payment_attempts, count(*) FILTER (WHERE {RT} < 100) AS automated_requests,
        count(DISTINCT cli_ip) AS ip_changes FROM {within('30 DAY', op='>=')} GROUP BY user_id),
        r AS (SELECT *, failed_auth_attempts * 10 + if(payment_attempts > 5, 20, 0) + if(automated_requests > 50, 30, 0)
              + if(ip_changes > 3, 25, 0) AS fraud_risk_score FROM s)
        SELECT *, CASE WHEN fraud_risk_score > 70 THEN 'High' WHEN fraud_risk_score > 50 THEN 'Medium' ELSE 'Low' END AS risk_tier
        FROM r WHERE fraud_risk_score > 30""",
    "ddos_sources": f"""SELECT cli_ip AS ip, count(*) AS requests_per_minute, count(DISTINCT req_path) AS unique_endpoints,
        round(avg({RT}) / 1000, 6) AS avg_response_time FROM {within('1 DAY', op='>=')} GROUP BY cli_ip
        HAVING count(*) > 5 OR (count(*) > 2 AND count(DISTINCT req_path) < 3)""",
    "popular_content": f"""SELECT req_path, req_host, count(*) AS views, count(DISTINCT cli_ip) AS unique_viewers,
        round(sum(bytes) / {MIB}, 6) AS total_mb_served, round(avg(download_time_ms), 6) AS avg_view_duration_ms,
        round(sum(downloads_completed) * 100.0 / nullif(sum(download_initiated), 0), 6) AS completion_rate_pct
        FROM {within('30 DAY')} WHERE status_code = 200 AND contains(rsp_content_type, 'video')
        GROUP BY req_path, req_host HAVING count(*) > 10 ORDER BY views DESC, req_path, req_host LIMIT 100""",
    "stale_content": f"""SELECT req_path, max(max_age_sec) AS cache_ttl_seconds, round(max(max_age_sec) / 3600.0, 6) AS cache_ttl_hours,
        count(*) AS request_count, max(request_timestamp) AS last_requested,
        round((epoch_us(@asof) - epoch_us(max(request_timestamp))) / 3600000000.0, 6) AS hours_since_last_request
        FROM {within('30 DAY')} WHERE cache_status = 1 GROUP BY req_path HAVING max(max_age_sec) > 86400""",
    "content_mix": f"""SELECT {CONTENT} AS content_type, round(sum(bytes) / {GIB}, 6) AS traffic_gb, count(*) AS requests,
        round(avg(obj_size) / 1024, 6) AS avg_size_kb FROM {days(7)} GROUP BY 1""",
    "edgeworker_usage": f"""SELECT left(ew_execution_info, 50) AS edgeworker_id, count(*) AS execution_count,
        round(avg(TRY_CAST(split_part(split_part(ew_execution_info, ':', 7), '|', 1) AS INT)), 6) AS avg_duration_ms,
        {share("contains(ew_execution_info, '200')")} AS success_rate_pct, round(sum(bytes) / {MIB}, 6) AS total_mb_processed
        FROM {within('7 DAY')} WHERE ew_execution_info <> '' GROUP BY 1""",
    "hot_products": f"""SELECT req_path AS endpoint, count(*) AS views, round(avg({RT} / 1000.0), 6) AS avg_latency
        FROM {within('30 DAY', op='>=')} WHERE starts_with(req_path, '/api/products/') GROUP BY req_path ORDER BY views DESC, req_path LIMIT 10""",
    "traffic_per_minute": f"""SELECT date_trunc('minute', request_timestamp) AS time, count(*) AS requests_per_minute,
        count(DISTINCT cli_ip) AS unique_ips, count(*) FILTER (WHERE status_code >= 400) AS error_count FROM {within('24 HOUR')} GROUP BY 1""",
    "seasonality": f"""SELECT date_trunc('hour', request_timestamp) AS hour, CAST(dayofweek(request_timestamp) AS INT) AS day_of_week,
        CAST(hour(request_timestamp) AS INT) AS hour_of_day, count(*) AS request_count, round(sum(bytes) / {GIB}, 6) AS gb_served,
        round(avg(ttfb_ms), 6) AS avg_ttfb_ms, max(ttfb_ms) AS max_ttfb_ms FROM {within('90 DAY')} GROUP BY 1, 2, 3""",
    "current_rps": f"SELECT count(*) / 5.0 AS requests_per_second FROM {within('5 SECOND')}",
    "capacity_peak": """SELECT max(n) AS historical_peak, round(max(n) * 1.2::DOUBLE * 1.5::DOUBLE * 1.3::DOUBLE, 6) AS planned_peak
        FROM (SELECT date_trunc('second', request_timestamp) AS s, count(*) AS n FROM access_logs GROUP BY 1)""",
    "daily_traffic": f"SELECT CAST(request_timestamp AS DATE) AS date, round(sum(bytes) / {GIB}, 6) AS traffic_gb FROM {days(30)} GROUP BY 1",
    "rps_per_minute": f"SELECT date_trunc('minute', request_timestamp) AS minute, round(count(*) / 60.0, 6) AS rps FROM {within('24 HOUR', op='>=')} GROUP BY 1",
    "noc_now": f"""WITH n AS {within('360 MINUTE', op='>=')},
        p AS (SELECT * FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 720 MINUTE AND request_timestamp < @asof - INTERVAL 360 MINUTE)
        SELECT round(count(*) / 21600.0, 6) AS current_rps, round(sum(bytes) * 8 / 21600.0 / {GIB}, 6) AS current_gbps,
        round(avg(ttfb_ms), 6) AS avg_latency_ms, {share('status_code >= 400')} AS current_error_rate,
        (SELECT {share('status_code >= 400')} FROM p) AS prev_error_rate, {share('cache_status = 1')} AS cache_hit_rate FROM n""",
    "monthly_growth": f"""WITH m AS (SELECT date_trunc('month', request_timestamp) AS month, sum(bytes) / {GIB} AS gb FROM access_logs
        WHERE request_timestamp >= CAST(@asof AS DATE) - INTERVAL 12 MONTH GROUP BY 1)
        SELECT CAST(month AS TIMESTAMP) AS month, round(gb, 6) AS traffic_gb, round(lag(gb) OVER w, 6) AS prev_month_traffic_gb,
        round((gb - lag(gb) OVER w) * 100.0 / lag(gb) OVER w, 6) AS growth_rate FROM m WINDOW w AS (ORDER BY month)""",
    "daily_growth": f"""WITH m AS (SELECT date_trunc('day', request_timestamp) AS period, sum(bytes) / {GIB} AS gb FROM access_logs
        WHERE request_timestamp >= CAST(@asof AS DATE) - INTERVAL 30 DAY GROUP BY 1)
        SELECT CAST(period AS TIMESTAMP) AS period, round(gb, 6) AS traffic_gb, round(lag(gb) OVER w, 6) AS prev_traffic_gb,
        round((gb - lag(gb) OVER w) * 100.0 / lag(gb) OVER w, 6) AS growth_rate FROM m WINDOW w AS (ORDER BY period)""",
    "growth_projection": f"""SELECT CAST(date_trunc('month', m) + to_months(CAST(n AS INT)) AS DATE) AS forecast_month,
        round(b * pow(1.234, n) / {GIB}, 6) AS projected_traffic_gb FROM (SELECT max(d) AS m, avg(b) AS b FROM
        (SELECT CAST(request_timestamp AS DATE) AS d, CAST(sum(bytes) AS BIGINT) AS b FROM access_logs
        WHERE request_timestamp >= CAST(@asof AS DATE) - INTERVAL 3 MONTH GROUP BY 1)), range(0, 13) r(n)""",
    "growth_trend": f"""WITH d AS (SELECT CAST(request_timestamp AS DATE) AS date, CAST(sum(bytes) AS BIGINT) AS b FROM access_logs
        WHERE request_timestamp >= CAST(@asof AS DATE) - INTERVAL 30 DAY GROUP BY 1),
        x AS (SELECT b, date_diff('day', CAST(@asof AS DATE), date) AS x FROM d)
        SELECT CAST(n AS INT) AS days_ahead, round((regr_intercept(b, x) + regr_slope(b, x) * n) / {GIB}, 6) AS projected_traffic_gb
        FROM x, range(0, 13) r(n) GROUP BY n""",
    "peak_pattern": f"""WITH h AS (SELECT date_trunc('hour', window_start) AS h, CAST(sum(request_count) AS BIGINT) AS n
        FROM {within('30 DAY', 'endpoint_summary', 'window_start', '>=')} GROUP BY 1)
        SELECT CAST(hour(h) AS INT) AS hour_of_day, CAST(dayofweek(h) + 1 AS INT) AS day_of_week, round(avg(n), 6) AS avg_requests,
        max(n) AS peak_requests, round(quantile_cont(n, 0.95), 6) AS p95_requests FROM h GROUP BY 1, 2""",
    "gdpr_report": f"""SELECT country, count(*) AS request_count, count(DISTINCT cli_ip) AS unique_users, round(sum(bytes) / {GIB}, 6) AS data_transferred_gb,
        count(*) FILTER (WHERE request_timestamp < @asof - INTERVAL 7 DAY) AS records_to_purge
        FROM access_logs WHERE country IN ('DE','FR','GB','IT','ES') GROUP BY country""",
    "sla_report": """WITH h AS (SELECT date_trunc('hour', request_timestamp) AS h, count(*) AS n, count(*) FILTER (WHERE status_code < 500) AS g
        FROM access_logs WHERE request_timestamp >= date_trunc('month', @asof) GROUP BY 1)
        SELECT count(*) AS total_hours, CAST(sum(n) AS BIGINT) AS total_requests, round(sum(g) * 100.0 / sum(n), 6) AS success_rate_pct,
        count(*) FILTER (WHERE g * 100.0 / n < 99) AS hours_below_sla,
        round(100.0 * count(*) FILTER (WHERE g * 100.0 / n >= 99) / count(*), 6) AS uptime_pct FROM h""",
    "compliance_status": f"""WITH c AS (SELECT 'HTTPS Coverage' AS metric, 100.0 * count(*) FILTER (WHERE proto = 'HTTPS') / count(*) AS v FROM {days(30)}
        UNION ALL SELECT 'TLS 1.2+ Usage', 100.0 * count(*) FILTER (WHERE tls_version IN ('TLSv1.2', 'TLSv1.3')) / count(*) FROM {days(30)})
        SELECT metric, round(v, 6) AS current_pct, 100.0::DOUBLE AS target_pct, CASE WHEN v >= 100 THEN 'Pass' WHEN v >= 99 THEN 'Near' ELSE 'Fail' END AS status FROM c""",
    "exec_kpis": f"""SELECT round(sum(bytes) / {GIB}, 6) AS traffic_gb, count(*) AS total_requests, round(avg(ttfb_ms), 6) AS avg_ttfb_ms,
        {share('status_code >= 400')} AS error_rate_pct, {share('cache_status = 1')} AS cache_hit_rate_pct,
        {share('status_code >= 200 AND status_code < 400')} AS availability_pct FROM {days(7)}""",
    "exec_kpis_daily": f"""SELECT CAST(request_timestamp AS DATE) AS date, round(sum(bytes) / {GIB}, 6) AS traffic_gb, count(*) AS total_requests,
        round(avg(ttfb_ms), 6) AS avg_ttfb_ms, {share('status_code >= 400')} AS error_rate_pct, {share('cache_status = 1')} AS cache_hit_rate_pct,
        count(DISTINCT cli_ip) AS unique_users FROM {days(90)} GROUP BY 1""",
    "log_totals": f"""SELECT count(*) AS total_requests, count(DISTINCT country) AS countries, round(avg(ttfb_ms), 6) AS avg_ttfb_ms,
        round(sum(bytes) / {MIB}, 6) AS total_mb FROM access_logs""",
    "requests_by_country": "SELECT country, count(*) AS requests, round(avg(ttfb_ms), 6) AS avg_ttfb_ms FROM access_logs GROUP BY country ORDER BY requests DESC, country LIMIT 10",
    "status_percentages": "SELECT status_code, count(*) AS requests, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM access_logs GROUP BY status_code",
    "cache_ratio": f"""SELECT {share('cache_status = 1')} AS cache_hit_ratio_pct, round(sum(bytes) FILTER (WHERE cache_status = 1) / {MIB}, 6) AS cached_mb,
        round(sum(bytes) FILTER (WHERE cache_status = 0) / {MIB}, 6) AS origin_mb FROM access_logs""",
    "traffic_7d_by_country": f"SELECT country, CAST(sum(bytes) AS BIGINT) AS traffic FROM {days(7)} GROUP BY country",
    "signup_funnel": f"""WITH u AS (SELECT user_id, bool_or(req_path = '/signup')::INT AS a, bool_or(req_path = '/signup/verify-email')::INT AS b,
        bool_or(req_path = '/signup/payment')::INT AS c, bool_or(req_path = '/signup/complete')::INT AS d
        FROM {within('30 DAY', op='>=')} GROUP BY user_id)
        SELECT count(*) AS total_visitors, CAST(sum(a) AS BIGINT) AS started_signup, CAST(sum(b) AS BIGINT) AS verified,
        CAST(sum(c) AS BIGINT) AS payment, CAST(sum(d) AS BIGINT) AS converted, round(sum(b) * 100.0 / nullif(sum(a), 0), 6) AS signup_to_verify_rate,
        round(sum(c) * 100.0 / nullif(sum(b), 0), 6) AS verify_to_payment_rate, round(sum(d) * 100.0 / nullif(sum(c), 0), 6) AS payment_to_complete_rate FROM u""",
    "high_intent_users": f"""WITH s AS (SELECT user_id, no, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS secs, max(ts) AS last, sum(v) AS v, sum(c) AS c
        FROM sessions_6h WHERE ts >= @asof - INTERVAL 30 DAY GROUP BY user_id, no)
        SELECT user_id, count(*) AS sessions, CAST(sum(v) AS BIGINT) AS product_views, CAST(sum(c) AS BIGINT) AS cart_actions,
        round(avg(secs), 6) AS avg_session_duration, max(last) AS last_seen FROM s GROUP BY user_id
        HAVING count(*) >= 3 AND sum(v) >= 1 AND sum(c) >= 1 AND avg(secs) > 10 AND max(last) >= @asof - INTERVAL 7 DAY""",
    "user_personas": f"""WITH s AS (SELECT user_id, no, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS secs, sum(c) AS c
        FROM sessions_6h WHERE ts >= @asof - INTERVAL 30 DAY GROUP BY user_id, no),
        u AS (SELECT user_id, count(*) AS visits, avg(secs) AS avg_s, sum(secs) AS total_s, CAST(sum(c) AS BIGINT) AS cart FROM s GROUP BY user_id),
        l AS (SELECT user_id, {CONTENT} AS c, {DEVICE} AS d, CAST(hour(request_timestamp) AS INT) AS h FROM {within('30 DAY', op='>=')}),
        pc AS (SELECT DISTINCT ON (user_id) user_id, c FROM (SELECT user_id, c, count(*) AS n FROM l GROUP BY 1, 2) ORDER BY user_id, n DESC, c),
        pd AS (SELECT DISTINCT ON (user_id) user_id, d FROM (SELECT user_id, d, count(*) AS n FROM l GROUP BY 1, 2) ORDER BY user_id, n DESC, d),
        ph AS (SELECT DISTINCT ON (user_id) user_id, h FROM (SELECT user_id, h, count(*) AS n FROM l GROUP BY 1, 2) ORDER BY user_id, n DESC, h)
        SELECT user_id, CASE WHEN visits > 10 AND avg_s > 300 THEN 'Power User' WHEN visits > 5 AND cart > 3 THEN 'Frequent Buyer'
        WHEN visits = 1 AND total_s < 60 THEN 'Bouncer' WHEN visits BETWEEN 2 AND 5 THEN 'Casual Browser' ELSE 'New Visitor' END AS persona,
        visits AS visit_frequency, cart AS cart_adds, c AS most_viewed_category, d AS preferred_device_type, h AS preferred_hour
        FROM u JOIN pc USING (user_id) JOIN pd USING (user_id) JOIN ph USING (user_id)""",
    "churn_risk": """WITH s AS (SELECT user_id, no, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS secs, min(ts) AS first, max(ts) AS last
        FROM sessions_6h WHERE ts >= @asof - INTERVAL 90 DAY GROUP BY user_id, no),
        u AS (SELECT user_id, CAST(date_diff('day', CAST(max(last) AS DATE), CAST(@asof AS DATE)) AS INT) AS days_since_last_visit,
              count(*) FILTER (WHERE first >= @asof - INTERVAL 30 DAY) AS visit_frequency_30d, count(*) AS visit_frequency_90d, avg(secs) AS a
              FROM s GROUP BY user_id),
        r AS (SELECT *, days_since_last_visit * 2 + coalesce(20::DOUBLE / nullif(visit_frequency_30d, 0), 0) + if(a < 30, 20, 0) AS score FROM u)
        SELECT user_id, days_since_last_visit, visit_frequency_30d, visit_frequency_90d, round(a, 6) AS avg_session_duration,
        round(score, 6) AS churn_risk_score FROM r WHERE visit_frequency_90d > 5 AND score > 3""",
    "churn_risk_support": """WITH opened AS (SELECT user_id, req_id, request_timestamp AS ts, CASE WHEN request_timestamp - lag(request_timestamp) OVER
        (PARTITION BY user_id ORDER BY request_timestamp, req_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM access_logs WHERE request_timestamp >= @asof - INTERVAL 90 DAY),
        s AS (SELECT user_id, no, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS secs, min(ts) AS first, max(ts) AS last
        FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, req_id) AS no FROM opened) GROUP BY user_id, no),
        u AS (SELECT user_id, CAST(date_diff('day', CAST(max(last) AS DATE), CAST(@asof AS DATE)) AS INT) AS days_since_last_visit,
              count(*) FILTER (WHERE first >= @asof - INTERVAL 30 DAY) AS visit_frequency_30d, count(*) AS visit_frequency_90d, avg(secs) AS a
              FROM s GROUP BY user_id),
        d AS (SELECT DISTINCT user_id, if(user_id % 6 = 0, user_id % 5, 0) AS tickets, if(user_id % 4 != 3, user_id % 11, NULL) AS nps FROM access_logs WHERE user_id % 3 != 2),
        r AS (SELECT u.*, days_since_last_visit * 2 + coalesce(20::DOUBLE / nullif(visit_frequency_30d, 0), 0) + if(a < 30, 20, 0)
              + coalesce(tickets, 0) * 5 + if(nps < 5, 30, 0) AS score FROM u LEFT JOIN d USING (user_id))
        SELECT user_id, days_since_last_visit, visit_frequency_30d, visit_frequency_90d, round(a, 6) AS avg_session_duration,
        round(score, 6) AS churn_risk_score FROM r WHERE visit_frequency_90d > 5 AND score > 22""",
    "tier_conversion": """WITH o AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1)
        SELECT c_mktsegment AS user_tier, count(*) AS unique_users, CAST(sum(n) AS BIGINT) AS orders, round(sum(v)::DOUBLE / sum(n), 6) AS avg_cart,
        round(count(n) * 100.0 / count(*), 6) AS conversion_rate FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1""",
    "regional_analytics": """WITH o AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1)
        SELECT r_name AS region, count(*) AS unique_users, CAST(sum(n) AS BIGINT) AS orders, round(sum(v)::DOUBLE / sum(n), 6) AS avg_cart,
        round(count(n) * 100.0 / count(*), 6) AS conversion_rate FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1""",
}

RECENT = within("24 HOUR", "endpoint_summary", "window_start", ">=")
RECENT_HOURS = within("24 HOUR", "hourly_metrics", "window_start", ">=")
SQL |= {
    "requests_per_second": f"SELECT window_start AS time, round(sum(request_count) / 30.0, 6) AS requests_per_second FROM {RECENT} GROUP BY 1",
    "error_rate_series": f"SELECT window_start AS time, round(sum(error_count) * 100.0 / sum(request_count), 6) AS error_rate_pct FROM {RECENT} GROUP BY 1",
    "p95_series": f"SELECT window_start AS time, round(avg(p95_response_time), 6) AS p95_latency FROM {RECENT} GROUP BY 1",
    "top_endpoints": f"""SELECT endpoint, CAST(sum(request_count) AS BIGINT) AS total_requests, round(avg(avg_response_time), 6) AS avg_latency
        FROM {RECENT} GROUP BY 1 ORDER BY total_requests DESC, endpoint LIMIT 10""",
    "busiest_windows": f"""SELECT window_start, endpoint, method, request_count, round(avg_response_time, 6) AS avg_response_time,
        round(error_count * 100.0 / request_count, 6) AS error_rate_pct FROM {RECENT} ORDER BY request_count DESC, window_start, endpoint, method LIMIT 10""",
    "slow_endpoints": f"""SELECT endpoint, method, count(*) AS request_count, round(avg(avg_response_time), 6) AS avg_latency,
        round(avg(p95_response_time), 6) AS p95_latency, round(avg(p99_response_time), 6) AS p99_latency,
        round(sum(error_count) * 100.0 / sum(request_count), 6) AS error_rate
        FROM {within('30 DAY', 'endpoint_summary', 'window_start', '>=')} GROUP BY endpoint, method HAVING count(*) > 100
        ORDER BY p95_latency DESC, endpoint, method LIMIT 20""",
    "error_rate_spike": f"""SELECT endpoint, round(sum(error_count) * 100.0 / sum(request_count), 6) AS error_rate_pct,
        CAST(sum(error_count) AS BIGINT) AS total_errors FROM {RECENT} WHERE NOT contains(endpoint, '/health') GROUP BY 1
        HAVING sum(error_count) * 100.0 / sum(request_count) > 1""",
    "hourly_series": f"""SELECT window_start AS time, CAST(sum(request_count) AS BIGINT) AS requests, round(avg(avg_response_time), 6) AS response_time,
        CAST(sum(error_count) AS BIGINT) AS errors FROM {RECENT_HOURS} GROUP BY 1""",
    "regrouped_series": f"""SELECT time_bucket(INTERVAL '5 minutes', window_start) AS time, round(avg(cache_hit_rate), 6) AS cache_hit_rate,
        round(avg(avg_response_time), 6) AS avg_response_time FROM {RECENT_HOURS} GROUP BY 1""",
    "hourly_error_rate": f"SELECT window_start AS hour, round(sum(error_count) * 100.0 / sum(request_count), 6) AS error_rate FROM {RECENT_HOURS} GROUP BY 1",
}
