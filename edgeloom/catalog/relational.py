"""Filters, joins, windows, set operations and retention."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS, instant, since, span
from edgeloom.operators import joins, limits, quality, retention, rollups, sets, windows
from edgeloom.operators.enrich import enrich


# -- filters -----------------------------------------------------------------------------


def relative_window(t):
    return since(t.logs, t.as_of, "24 hours").select("req_id", TS)


def bounded_range(t):
    """Half-open range: the day before the last day."""
    end = F.to_date(t.as_of).cast("timestamp_ntz")
    day = (F.col(TS) >= end - span("1 day")) & (F.col(TS) < end)
    return t.logs.filter(day).select("req_id", TS)


def predicates(t):
    """Equality, range, IN, NOT IN, BETWEEN, LIKE, NOT LIKE, NULL and empty tests."""
    wanted = (
        (F.col("req_method") == "GET")
        & F.col("country").isin("US", "DE", "FR")
        & ~F.col("tls_version").isin("TLSv1.0")
        & F.col("ttfb_ms").between(100, 2500)
        & F.col("req_path").like("/%")
        & ~F.col("req_path").like("%/health%")
        & F.col("user_agent").contains("Mozilla")
        & F.col("turn_around_time_ms").isNotNull()
        & F.col("security_rules").isNotNull()
        & (F.col("rsp_content_type") != "")
    )
    return t.logs.filter(wanted).select("req_id", "country", "ttfb_ms", "req_path")


def having_alias(t):
    return (
        t.logs.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.avg("ttfb_ms").alias("avg_ttfb"))
        .filter((F.col("n") > 10) & (F.col("avg_ttfb") > 1400))
    )


def error_subset(t):
    return enrich(t.logs).filter(F.col("is_error") == 1).select("req_id", "status_code", "error_code")


def point_lookup(t):
    return (
        since(t.logs, t.as_of, "7 days", inclusive=True)
        .filter(F.col("cli_ip") == "203.0.0.10")
        .select("req_id", TS, "req_path", "status_code")
    )


def retention_split(t):
    """Rows kept and archived per day at a fifteen-day limit."""
    keep, archive = retention.tier_split(t.logs, t.as_of, days=15)
    per_day = lambda df, where: df.groupBy(F.to_date(TS).alias("date")).agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("placed", F.lit(where))
    return per_day(keep, "keep").unionByName(per_day(archive, "archive"))


def tier_assignment(t):
    return (
        retention.with_tier(t.logs, t.as_of).groupBy("tier", "age_days").agg(F.count(F.lit(1)).alias("rows"))
    )


# -- joins -------------------------------------------------------------------------------


def geo_enrichment(t):
    nation = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    region = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    customers = t.table("customer").select("c_custkey", "c_nationkey")
    located = joins.enrich_from(joins.enrich_from(customers, nation, ["c_nationkey"]), region, ["n_regionkey"])
    return located.select("c_custkey", "n_name", "r_name")


def _ip_ranges(logs):
    """Halves of each /24 seen, except one, and the /8 around them."""
    prefix = F.substring_index("cli_ip", ".", 3)
    low = joins.ip_to_long(F.concat(F.col("prefix"), F.lit(".0")))
    net = logs.select(prefix.alias("prefix")).distinct().withColumn("first", low)
    halves = net.filter(~F.col("prefix").endswith(".2")).select(
        F.explode(
            F.array(
                F.struct(F.col("first").alias("first_ip"), (F.col("first") + 127).alias("last_ip"),
                         F.concat(F.lit("low-"), "prefix").alias("geo")),
                F.struct((F.col("first") + 128).alias("first_ip"), (F.col("first") + 255).alias("last_ip"),
                         F.concat(F.lit("high-"), "prefix").alias("geo")),
            )
        ).alias("r")
    ).select("r.*")
    around = net.select(F.shiftright("first", 24).alias("p")).distinct().select(
        F.shiftleft("p", 24).alias("first_ip"), (F.shiftleft(F.col("p") + 1, 24) - 1).alias("last_ip"),
        F.lit("around").alias("geo"),
    )
    return halves.unionByName(around)


def ip_range_lookup(t):
    found = joins.ip_range_lookup(t.logs.select("req_id", "cli_ip"), _ip_ranges(t.logs))
    return found.select("req_id", "cli_ip", "geo")


def slower_than_hour(t):
    """Per country, requests whose first byte came later than their hour's mean."""
    joined = joins.against_hourly(t.logs, rollups.hourly_country(t.logs))
    return joined.groupBy("country").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("ttfb_ms") > F.col("avg_ttfb")).alias("slower"),
        F.max("request_count").alias("busiest_hour"),
    )


def only_new(t):
    """The last day is new. What was loaded in the nine days before is sent again, under other times."""
    now = instant(t.as_of)
    loaded = t.logs.filter(F.col(TS) < now - span("1 day"))
    new = t.logs.filter(F.col(TS) >= now - span("1 day"))
    again = t.logs.filter(F.col(TS) >= now - span("10 days")).withColumn(TS, F.col(TS) + span("9 days"))
    sent = new.unionByName(again)
    return joins.only_new(sent, loaded, ["req_id"]).select("req_id", F.col(TS).alias("created_at"))


# -- windows -----------------------------------------------------------------------------


def dedup_latest(t):
    rows = t.replayed_logs.select("req_id", TS, "created_at", "cli_ip", "error_code")
    return windows.dedup_latest(rows, ["req_id", TS], "created_at")


def _hourly_by(t, *keys):
    return enrich(t.logs).groupBy("hour", *keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("response_time_ms").alias("latency"),
        (F.sum("is_error") * F.lit(100.0) / F.count(F.lit(1))).alias("error_pct"),
    )


def sustained_errors(t):
    """Countries with an error rate above 10 % in two or more consecutive hours."""
    return windows.sustained_breaches(
        _hourly_by(t, "country"), ["country"], "hour", F.col("error_pct") > 10, step_seconds=3600, periods=2
    )


def trailing_spikes(t):
    out = windows.trailing_baseline(_hourly_by(t, "country"), ["country"], "hour", "requests", 24, 2.0)
    return out.select("country", "hour", "requests", "baseline", "is_spike")


def latency_anomalies(t):
    return windows.trend_anomalies(_hourly_by(t, "req_path"), ["req_path"], "hour", "latency", t.as_of, factor=1.2)


def path_share(t):
    counts = t.logs.groupBy("req_path").agg(F.count(F.lit(1)).alias("requests"))
    return windows.share_of_total(counts, "requests")


def hourly_change(t):
    return joins.previous_period(_hourly_by(t).select("hour", "requests"), "hour", "requests")


def top_addresses_per_country(t):
    """Top three addresses per country; each map task keeps three before the shuffle."""
    counts = t.logs.groupBy("country", "cli_ip").agg(F.count(F.lit(1)).alias("requests"))
    order = Window.partitionBy("country").orderBy(F.desc("requests"), "cli_ip")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 3)


# -- set operations ----------------------------------------------------------------------


def union_files(t):
    """Rows per host over the log in two parts, as two files would hold it."""
    parts = [t.logs.filter(F.col("req_id") % 2 == k) for k in (0, 1)]
    return sets.union_files(parts).groupBy("req_host").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))


def _versions(t):
    web = t.logs.select(
        "req_id", F.col("cli_ip").alias("ip"), F.col("req_path").alias("endpoint"),
        F.col("country").alias("region"), "user_id",
    )
    old = web.filter(F.col("user_id") % 2 == 0).select("req_id", "ip", "endpoint")
    return old, web.filter(F.col("user_id") % 2 == 1)


def table_counts(t):
    return sets.table_counts(
        {
            "endpoint_summary": t.recent(rollups.endpoint_summary, "24 hours"),
            "status_summary": t.recent(rollups.status_summary, "24 hours"),
            "user_summary": t.recent(rollups.user_summary, "24 hours"),
        }
    )


QUERIES = {
    "filter_relative_window": relative_window,
    "filter_bounded_range": bounded_range,
    "filter_predicates": predicates,
    "filter_having": having_alias,
    "filter_errors": error_subset,
    "point_lookup": point_lookup,
    "retention_split": retention_split,
    "tier_assignment": tier_assignment,
    "geo_enrichment": geo_enrichment,
    "ip_range_lookup": ip_range_lookup,
    "logs_vs_hourly": slower_than_hour,
    "only_new_rows": only_new,
    "rate_vs_baseline": lambda t: joins.rate_against_baseline(t.logs, t.as_of, "city", factor=1.2),
    "latency_vs_baseline": lambda t: joins.latency_against_baseline(t.logs, t.as_of, "city", factor=1.02),
    "dedup_latest": dedup_latest,
    "rate_limit_violations": lambda t: windows.rate_limit_violations(t.logs, limit=3, window_seconds=21600),
    "admitted_requests": lambda t: limits.admitted(t.logs, limit=3, window_seconds=21600),
    "sustained_breaches": sustained_errors,
    "trailing_baseline": trailing_spikes,
    "latency_trend_anomalies": latency_anomalies,
    "share_of_total": path_share,
    "previous_period": hourly_change,
    "top_k_per_group": top_addresses_per_country,
    "union_files": union_files,
    "union_versions": lambda t: sets.union_versions(*_versions(t)),
    "backfill_versions": lambda t: sets.backfill(*_versions(t)),
    "table_counts": table_counts,
    "duplicate_ids": lambda t: quality.duplicate_ids(t.replayed_logs),
    "daily_duplicates": lambda t: quality.daily_duplicates(t.replayed_logs),
}
