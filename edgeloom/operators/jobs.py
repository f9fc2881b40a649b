"""Reports over the processing-job metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import day_start, hour_floor, span


def _status(errors: str, warning: str, ok: str, min_success_pct: float):
    return (
        F.when(F.col("error_count") > 0, errors)
        .when(F.col("success_rate") < min_success_pct, warning)
        .otherwise(ok)
    )


def job_status(jobs: DataFrame, min_success_pct: float = 95, limit: int = 10) -> DataFrame:
    return (
        jobs.orderBy(F.desc("timestamp"), "job_id")
        .limit(limit)
        .select(
            "job_id", "timestamp", "lines_read", "lines_processed", "lines_stored", "lines_failed",
            "success_rate", "processing_duration_ms",
            _status("Errors", "Warning", "OK", min_success_pct).alias("status"),
        )
    )


def _success():
    return F.avg(F.col("success_rate").cast("double"))


def hourly_summary(jobs: DataFrame) -> DataFrame:
    return (
        jobs.groupBy(hour_floor("timestamp").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("job_count"),
            *[F.sum(c).alias(f"total_{c}") for c in ("lines_read", "lines_processed", "lines_stored", "lines_failed")],
            _success().alias("avg_success_rate"),
            F.avg("processing_duration_ms").alias("avg_duration_ms"),
            F.sum("error_count").alias("total_errors"),
        )
        .orderBy(F.desc("hour"))
    )


def daily_performance(jobs: DataFrame) -> DataFrame:
    return (
        jobs.groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_jobs"),
            F.sum("lines_processed").alias("total_lines"),
            F.avg("throughput_lines_per_sec").alias("avg_throughput"),
            F.avg("processing_duration_ms").alias("avg_duration_ms"),
            F.percentile("processing_duration_ms", 0.95).alias("p95_duration_ms"),
        )
        .orderBy(F.desc("date"))
    )


def daily_failures(jobs: DataFrame) -> DataFrame:
    return (
        jobs.filter(F.col("lines_failed") > 0)
        .groupBy(F.col("partition_date").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("jobs_with_failures"),
            F.sum("lines_failed").alias("total_failed_lines"),
            F.avg("lines_failed").alias("avg_failed_per_job"),
            F.max("lines_failed").alias("max_failed_single_job"),
        )
        .orderBy(F.desc("date"))
    )


def missing_lines():
    return F.col("lines_read") - F.col("lines_processed") - F.col("lines_failed")


def line_reconciliation(jobs: DataFrame) -> DataFrame:
    """Jobs whose processed and failed lines do not add up to the lines read."""
    return (
        jobs.withColumn("missing_lines", missing_lines())
        .filter(F.col("missing_lines") != 0)
        .select(
            "job_id", "timestamp", "lines_read", "lines_processed", "lines_failed", "missing_lines",
            F.when(F.col("missing_lines") > 0, "DATA LOSS").otherwise("OK").alias("status"),
        )
        .orderBy(F.desc("timestamp"), "job_id")
    )


def job_series(jobs: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    return (
        jobs.groupBy(F.window("timestamp", bucket).alias("w"))
        .agg(
            F.sum("lines_processed").alias("lines"),
            F.sum("lines_failed").alias("failed"),
            (F.avg("processing_duration_ms") / F.lit(1000.0)).alias("avg_duration_sec"),
        )
        .select(F.col("w.start").alias("time"), "lines", "failed", "avg_duration_sec")
        .orderBy("time")
    )


def job_totals(jobs: DataFrame, as_of) -> DataFrame:
    """Lines processed today and mean success over the given jobs."""
    today = F.col("timestamp") > day_start(as_of)
    return jobs.agg(
        F.sum(F.when(today, F.col("lines_processed"))).alias("lines_today"), _success().alias("success_rate")
    )


def lagging_consumers(kafka_consumer_lag: DataFrame, min_lag: int = 1000) -> DataFrame:
    return (
        kafka_consumer_lag.filter(F.col("lag_count") > min_lag)
        .select("consumer_group", "topic", "partition_id", "lag_count", "timestamp")
        .orderBy(F.desc("lag_count"), "timestamp")
    )


def slow_jobs(jobs: DataFrame, min_ms: int = 120_000, limit: int = 5) -> DataFrame:
    return (
        jobs.filter(F.col("processing_duration_ms") > min_ms)
        .orderBy(F.desc("timestamp"), "job_id")
        .limit(limit)
        .select("job_id", "processing_duration_ms")
    )


def failed_jobs(jobs: DataFrame, limit: int = 5) -> DataFrame:
    return jobs.filter(F.col("error_count") > 0).orderBy(F.desc("timestamp"), "job_id").limit(limit)


def yesterday_summary(jobs: DataFrame, as_of) -> DataFrame:
    end = day_start(as_of)
    return (
        jobs.filter((F.col("timestamp") >= end - span("1 day")) & (F.col("timestamp") < end))
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.sum("lines_read").alias("total_read"),
            F.sum("lines_processed").alias("total_processed"),
            F.sum("lines_stored").alias("total_stored"),
            F.sum("lines_failed").alias("total_failed"),
            _success().alias("avg_success_rate"),
            F.count(F.lit(1)).alias("total_jobs"),
        )
    )


def failures_with_quality(jobs: DataFrame, quality: DataFrame) -> DataFrame:
    """Jobs with errors, next to the quality checks that failed in them, if any."""
    failing = quality.filter(F.col("failed_count") > 0).select("job_id", "metric_name", "failed_count", "failure_rate")
    return (
        jobs.filter(F.col("error_count") > 0)
        .select("job_id", "timestamp", "error_message", "error_count")
        .join(failing, "job_id", "left")
    )
