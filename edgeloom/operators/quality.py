"""Data-quality checks of the access log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.exprs import TS, hour_floor, instant, n_where, pct
from edgeloom.operators.enrich import flag

CHECKS = ["missing_ip", "invalid_status", "negative_bytes", "future_timestamp", "invalid_geo"]
POINTS_PER_FAILURE = 20


def quality_flags(logs: DataFrame, as_of, ts: str = TS) -> DataFrame:
    """0/1 per check and a score. A NULL status is not flagged: it compares as unknown."""
    status = F.col("status_code")
    checks = {
        "missing_ip": F.col("cli_ip").isNull(),
        "invalid_status": (status < 100) | (status > 599),
        "negative_bytes": F.col("bytes") < 0,
        "future_timestamp": F.col(ts) > instant(as_of),
        "invalid_geo": F.col("country").isNull() & F.col("cli_ip").isNotNull(),
    }
    flagged = logs.withColumns({name: flag(cond) for name, cond in checks.items()})
    failures = sum((F.col(c) for c in CHECKS), F.lit(0))
    return flagged.withColumn("quality_score", F.lit(100) - failures * POINTS_PER_FAILURE)


def _rate(failed, total):
    return F.round(pct(failed, total), 2).cast("decimal(5,2)")


def quality_metrics(
    flagged: DataFrame, job_keys: list[str], seen_at: str, row_id: str,
    sample_cols: list[str] | None = None, samples: int = 3,
) -> DataFrame:
    """One row per job and check: failed, total, rate, and a few failing rows as JSON.

    The counts cover every row; the sample is a report column, the ``samples`` lowest row
    ids. All checks share one aggregation (then unpivoted). Sampling ranks failing rows
    only, and each map task drops all but its first ``samples`` before the shuffle. The
    two parts meet in a union, which needs no NULL-safe join.
    """
    sample_cols = sample_cols or [row_id]
    long = quality_totals(flagged, job_keys, seen_at)
    failed_checks = F.filter(
        F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in CHECKS]), lambda c: c.isNotNull()
    )
    first = Window.partitionBy(*job_keys, "metric_name").orderBy(row_id)
    sample = (
        flagged.filter(F.col("quality_score") < 100)
        .withColumn("metric_name", F.explode(failed_checks))
        .withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= samples)
        .select(*job_keys, "metric_name", "rn", F.struct(*sample_cols).alias("_row"))
    )
    merged = (
        long.unionByName(sample, allowMissingColumns=True)
        .groupBy(*job_keys, "metric_name")
        .agg(
            *[F.max(c).alias(c) for c in ("timestamp", "total_count", "failed_count", "failure_rate")],
            F.array_sort(F.collect_list(F.when(F.col("rn").isNotNull(), F.struct("rn", "_row")))).alias("_sample"),
        )
    )
    return merged.select(
        *job_keys, "timestamp", "metric_name", "failed_count", "total_count", "failure_rate",
        F.to_json(F.transform("_sample", lambda s: s["_row"])).alias("sample_failed_records"),
    )


def quality_totals(flagged: DataFrame, job_keys: list[str], seen_at: str) -> DataFrame:
    """The counts and rates of ``quality_metrics`` alone, from one aggregation: what the
    trend reports read."""
    totals = flagged.groupBy(*job_keys).agg(
        F.max(seen_at).alias("timestamp"),
        F.count(F.lit(1)).alias("total_count"),
        *[F.sum(c).alias(c) for c in CHECKS],
        n_where(F.col("quality_score") < 100).alias("quality_score"),
        F.avg("quality_score").alias("_score"),
    )
    names = [*CHECKS, "quality_score"]
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    long = totals.select(
        *job_keys, "timestamp", "total_count", "_score",
        F.expr(f"stack({len(names)}, {pairs}) AS (metric_name, failed_count)"),
    )
    rate = F.when(
        F.col("metric_name") == "quality_score", F.round(F.lit(100) - F.col("_score"), 2).cast("decimal(5,2)")
    ).otherwise(_rate(F.col("failed_count"), F.col("total_count")))
    return long.select(*job_keys, "timestamp", "metric_name", "failed_count", "total_count", rate.alias("failure_rate"))


# -- trends over stored quality metrics --------------------------------------------------


def quality_by_day(metrics: DataFrame) -> DataFrame:
    score = F.when(F.col("metric_name") == "quality_score", F.lit(100) - F.col("failure_rate"))
    return (
        metrics.groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.avg(score.cast("double")).alias("avg_quality_score"), F.sum("failed_count").alias("total_failures"))
        .orderBy(F.desc("date"))
    )


def quality_by_check(metrics: DataFrame) -> DataFrame:
    rate = F.col("failure_rate").cast("double")
    return (
        metrics.groupBy("metric_name")
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.sum("failed_count").alias("total_failed"),
            F.avg(rate).alias("avg_failure_rate"),
            F.max(rate).alias("max_failure_rate"),
        )
        .orderBy(F.desc("total_failed"), "metric_name")
    )


def quality_by_hour(metrics: DataFrame, checks=("missing_ip", "invalid_status", "negative_bytes")) -> DataFrame:
    return (
        metrics.filter(F.col("metric_name").isin(*checks))
        .groupBy(hour_floor("timestamp").alias("hour"), "metric_name")
        .agg(F.avg(F.col("failure_rate").cast("double")).alias("avg_failure_rate"))
        .orderBy(F.desc("hour"), "metric_name")
    )


def quality_by_job(metrics: DataFrame) -> DataFrame:
    """100 minus the failed share of all checks, per job."""
    return metrics.groupBy("job_id").agg(
        (F.lit(100) - pct(F.sum("failed_count"), F.sum("total_count"))).alias("quality_score")
    )


def mean_job_quality(metrics: DataFrame) -> DataFrame:
    return quality_by_job(metrics).agg(F.avg("quality_score").alias("avg_quality_score"))


# -- duplicates, required fields, versions ------------------------------------------------


def duplicate_ids(logs: DataFrame, key: str = "req_id") -> DataFrame:
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def daily_duplicates(logs: DataFrame, key: str = "req_id", at: str = "created_at") -> DataFrame:
    total, unique = F.col("total_records"), F.col("unique_records")
    return (
        logs.groupBy(F.to_date(at).alias("date"))
        .agg(F.count(F.lit(1)).alias("total_records"), F.countDistinct(key).alias("unique_records"))
        .withColumn("duplicates", total - unique)
    )


def null_required(logs: DataFrame, required: dict[str, str]) -> DataFrame:
    """NULL count per required column, named by the mapping."""
    return logs.agg(*[n_where(F.col(c).isNull()).alias(name) for c, name in required.items()])


def parse_failure_rate(good: DataFrame, bad: DataFrame, max_share: float = 0.01) -> DataFrame:
    """Parsed and failed counts, and whether failures exceed ``max_share`` of the parsed."""
    both = good.select(F.lit(0).alias("f")).unionAll(bad.select(F.lit(1).alias("f")))
    return both.agg(
        n_where(F.col("f") == 0).alias("parsed"), n_where(F.col("f") == 1).alias("failed")
    ).withColumn("too_many", F.col("failed") > F.col("parsed") * max_share)


def schema_version_mix(parsed: DataFrame) -> DataFrame:
    extended = F.col("region").isNotNull() | F.col("user_id").isNotNull()
    return parsed.groupBy(F.when(extended, "v2").otherwise("v1").alias("schema_version")).agg(
        F.count(F.lit(1)).alias("records")
    )
