"""Enrichment, classifiers and materialised roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.functions import classify as C
from edgeloom.functions import privacy
from edgeloom.operators import retention, rollups, skew
from edgeloom.operators.enrich import enrich
from edgeloom.functions.exprs import TS


def enriched(t):
    return enrich(t.logs).select(
        "req_id", TS, "hour", "date", "is_error", "is_cache_hit", "response_time_ms", "is_mobile"
    )


def classified(t):
    """Every row classifier side by side."""
    return t.logs.select(
        "req_id",
        C.device_class().alias("device_type"),
        C.device_network_class().alias("device_network"),
        C.browser_class().alias("browser"),
        C.network_speed().alias("network_speed"),
        C.content_class().alias("content_type"),
        C.endpoint_pattern().alias("endpoint_pattern"),
        C.journey_step().alias("journey_step"),
        C.impact_class().alias("impact"),
        C.region_of().alias("region"),
        C.price_per_gib().alias("usd_per_gib"),
        C.threat_class().alias("threat_type"),
    )


def column(name, label):
    """Requests per label of one classifier."""

    def query(t):
        return t.logs.groupBy(label().alias(name)).agg(F.count(F.lit(1)).alias("requests"))

    return query


def _without_clock(df):
    return df.drop("processing_timestamp")


def edgeworker_fields(t):
    return t.logs.select("req_id", *privacy.edgeworker_fields("ew_execution_info"))


def decoded_queries(t):
    return t.logs.select("req_id", privacy.url_decode("query_str").alias("query"))


def redacted_documents(t):
    """The corpus with a credential appended, then masked: whole texts in, whole texts out."""
    tagged = F.concat(
        F.col("text"), F.lit(" password=p"), F.col("doc_id"), F.lit(" token=t"), F.col("doc_id"),
        F.lit(" key=k"), F.col("doc_id"), F.lit(" end"),
    )
    docs = t.table("documents").select("doc_id", tagged.alias("text"))
    return docs.select("doc_id", privacy.redact_secrets("text").alias("text"))


def anonymized(t):
    out = retention.anonymize_older_than(t.logs, t.as_of, days=7)
    return out.select("req_id", "cli_ip", "cookie", "x_forwarded_for")


def json_rows(t):
    cols = ["req_id", "cli_ip", "req_path", "status_code", "error_code"]
    return t.logs.select("req_id", F.to_json(F.struct(*cols)).alias("value"))


def mergeable_daily(t):
    """Daily sums from hourly partials, and whether the sketched count of addresses is
    within two percent of the exact one."""
    out = rollups.merge_rollup(rollups.mergeable_rollup(t.logs))
    exact = t.logs.groupBy(F.date_trunc("day", TS).alias("window_start")).agg(F.countDistinct("cli_ip").alias("exact"))
    near = F.abs(F.col("unique_ips") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.02)
    return out.join(exact, "window_start").select(
        "window_start", "request_count", "total_bytes", "error_count", "cache_hits",
        "avg_response_time", near.alias("unique_ips_within_2_pct"),
    )


def mergeable_monthly_quantile(t):
    """Sketched p95 of a month by country from hourly partials, and whether its rank among
    the month's values is within one percent of 0.95."""
    out = rollups.merge_rollup(rollups.mergeable_rollup(t.logs), "month", ("country",)).select("window_start", "country", "request_count", "p95_response_time")
    values = enrich(t.logs).where("response_time_ms is not null").select(F.date_trunc("month", TS).alias("window_start"), "country", "response_time_ms")
    ranked = values.join(out, ["window_start", "country"]).groupBy("window_start", "country", "request_count").agg(
        (F.avg((F.col("response_time_ms") < F.col("p95_response_time")).cast("int")) <= 0.96).alias("_low"),
        (F.avg((F.col("response_time_ms") <= F.col("p95_response_time")).cast("int")) >= 0.94).alias("_high"),
    )
    return ranked.select("window_start", "country", "request_count", (F.col("_low") & F.col("_high")).alias("p95_rank_within_1_pct"))


def salted_endpoint_totals(t):
    logs = enrich(t.logs)
    return skew.salted_totals(
        logs, ["req_path"], salt_on="req_id",
        sums={"request_count": F.lit(1), "total_bytes": F.col("bytes"), "error_count": F.col("is_error")},
    )


QUERIES = {
    "enrich": enriched,
    "classify_requests": classified,
    "device_class": column("device_type", C.device_class),
    "device_network_class": column("device_type", C.device_network_class),
    "browser_class": column("browser", C.browser_class),
    "network_speed": column("network_speed", C.network_speed),
    "content_class": column("content_type", C.content_class),
    "endpoint_pattern": column("endpoint_pattern", C.endpoint_pattern),
    "journey_step_class": column("journey_step", C.journey_step),
    "impact_class": column("impact", C.impact_class),
    "region_of_country": column("region", C.region_of),
    "price_tier": column("usd_per_gib", C.price_per_gib),
    "threat_class": column("threat_type", C.threat_class),
    "edgeworker_fields": edgeworker_fields,
    "url_decode": decoded_queries,
    "redact_secrets": redacted_documents,
    "anonymize_older_than": anonymized,
    "json_encode": json_rows,
    "hourly_metrics": lambda t: _without_clock(rollups.hourly_metrics(t.logs)),
    "endpoint_metrics": lambda t: _without_clock(rollups.endpoint_metrics(t.logs)),
    "security_events": lambda t: _without_clock(rollups.security_events(t.logs)),
    "device_metrics": lambda t: _without_clock(rollups.device_metrics(t.logs)),
    "performance_metrics": lambda t: rollups.performance_metrics(t.logs),
    "business_metrics": lambda t: rollups.business_metrics(t.logs),
    "daily_metrics": lambda t: rollups.daily_metrics(t.logs),
    "hourly_country": lambda t: rollups.hourly_country(t.logs),
    "mergeable_rollup": mergeable_daily,
    "mergeable_rollup_quantiles": mergeable_monthly_quantile,
    "endpoint_summary": lambda t: rollups.endpoint_summary(t.logs),
    "status_summary": lambda t: rollups.status_summary(t.logs),
    "user_summary": lambda t: rollups.user_summary(t.logs),
    "salted_aggregation": salted_endpoint_totals,
}
