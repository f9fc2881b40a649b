"""Data quality, processing jobs and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.context import LogTables
from edgeloom.functions.exprs import span
from edgeloom.operators import alerts, jobs, quality, rollups


def _flagged(t):
    return quality.quality_flags(t.dirty_logs, t.as_of)


def quality_flags(t):
    return _flagged(t).select("req_id", *quality.CHECKS, "quality_score")


def _quality_metrics(t):
    return quality.quality_metrics(
        _flagged(t), ["job_id", "partition_date"], "seen_at", "req_id", sample_cols=["req_id", "req_path"]
    )


def _quality_totals(t):
    return quality.quality_totals(_flagged(t), ["job_id", "partition_date"], "seen_at")


def over_quality(report):
    return lambda t: report(_quality_totals(t))


def over_jobs(report, window=None, **options):
    def query(t):
        table = t.recent_metrics("processing_metrics", window) if window else t.pipeline("processing_metrics")
        return report(table, **options)

    return query


def null_required(t):
    required = {"cli_ip": "null_ips", "request_timestamp": "null_timestamps", "req_path": "null_endpoints"}
    return quality.null_required(t.dirty_logs, required)


def failures_with_quality(t):
    return jobs.failures_with_quality(t.pipeline("processing_metrics"), _quality_totals(t))


def eav_series(t):
    """Metric rows turned into one column per metric, by hour."""
    return (
        t.pipeline("ingestion_metrics")
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour"))
        .pivot("metric_name", ["queue_depth", "disk_usage_pct", "health_check"])
        .agg(F.max("metric_value"))
    )


def consumer_lag_series(t):
    return (
        t.recent_metrics("kafka_metrics", "24 hours")
        .filter(F.col("metric_name") == "consumer_lag")
        .select(F.col("timestamp").alias("time"), F.col("metric_value").alias("lag_messages"))
    )


def _alert_tables(whole):
    def open_table(name, minutes):
        # Roll-ups are by hour or day, so whole days are kept.
        t = whole.after(F.date_trunc("day", whole.as_of - span(f"{minutes} minutes")))
        if name == "access_logs":
            return t.logs
        if name == "endpoint_summary":
            return rollups.endpoint_summary(t.logs)
        if name == "hourly_metrics":
            return rollups.hourly_metrics(t.logs)
        if name == "job_quality":
            metrics = _quality_totals(t)
            seen = metrics.groupBy("job_id").agg(F.max("timestamp").alias("timestamp"))
            return quality.quality_by_job(metrics).join(seen, "job_id")
        return t.pipeline(name)

    return open_table


def all_alerts(t):
    """Five-minute windows become days, so that a month of sparse traffic fills them."""
    return alerts.evaluate_alerts(_alert_tables(t), t.as_of, alerts.stretched(alerts.RULES, 288))


class _Compressed(LogTables):
    """The same tables with time before the newest request run 288 times as fast: a month
    of sparse traffic fills windows of minutes."""

    def _read(self, name):
        rows = super()._read(name)
        if name != "events":
            return rows
        end = F.unix_micros(rows.agg(F.max(F.col("ts").cast("timestamp"))).scalar())
        back = F.floor((end - F.unix_micros(F.col("ts").cast("timestamp"))) / 288).cast("long")
        return rows.withColumn("ts", F.timestamp_micros(end - back).cast("timestamp_ntz"))


def dense_alerts(t):
    """Every rule with the window it is defined by."""
    dense = _Compressed(t.spark, t.directory, t._as_of)
    return alerts.evaluate_alerts(_alert_tables(dense), t.as_of)


QUERIES = {
    "quality_flags": quality_flags,
    "quality_metrics": _quality_metrics,
    "quality_trends": over_quality(quality.quality_by_day),
    "quality_by_check": over_quality(quality.quality_by_check),
    "quality_by_hour": over_quality(quality.quality_by_hour),
    "quality_by_job": over_quality(quality.quality_by_job),
    "quality_mean": over_quality(quality.mean_job_quality),
    "null_required": null_required,
    "job_status": over_jobs(jobs.job_status, "24 hours"),
    "job_summaries": over_jobs(jobs.hourly_summary, "24 hours"),
    "job_daily_performance": over_jobs(jobs.daily_performance, "30 days"),
    "job_daily_failures": over_jobs(jobs.daily_failures, "7 days"),
    "line_reconciliation": over_jobs(jobs.line_reconciliation, "7 days"),
    "job_series": over_jobs(jobs.job_series, "24 hours"),
    "job_totals": lambda t: jobs.job_totals(t.recent_metrics("processing_metrics", "24 hours"), t.as_of),
    "lag_and_slow_jobs": lambda t: jobs.lagging_consumers(t.pipeline("kafka_consumer_lag")),
    "slow_jobs": over_jobs(jobs.slow_jobs),
    "failed_jobs": over_jobs(jobs.failed_jobs),
    "jobs_yesterday": lambda t: jobs.yesterday_summary(t.pipeline("processing_metrics"), t.as_of),
    "job_failures_with_quality": failures_with_quality,
    "eav_pivot": eav_series,
    "eav_series": consumer_lag_series,
    "evaluate_alerts": all_alerts,
    "evaluate_alerts_dense": dense_alerts,
}
