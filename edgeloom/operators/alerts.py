"""Threshold alerts over logs, roll-ups and pipeline metrics.

A rule measures its table over windows counted back from ``as_of``; it fires when the
latest ``hold`` windows all breach the threshold. A window without data does not breach.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import DataFrame

from edgeloom.functions.exprs import instant


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    table: str
    measure: str  # SQL aggregate; {now} stands for the reference time in seconds
    above: bool
    threshold: float
    window_minutes: int
    for_minutes: int = 0
    where: str | None = None
    ts: str = "timestamp"
    silence_fires: bool = False  # no row in the latest window is itself the alarm

    @property
    def hold(self) -> int:
        return max(1, ceil(self.for_minutes / self.window_minutes))


def _share(condition: str) -> str:
    return f"100.0D * count_if({condition}) / nullif(count(1), 0)"


def _seconds(time: str) -> str:
    """Seconds since 1970 of a time, with fractions."""
    return f"unix_micros(CAST({time} AS TIMESTAMP)) / 1000000.0D"


def _age_minutes(ts: str) -> str:
    return f"({{now}} - {_seconds(f'max({ts})')}) / 60.0D"


ERRORS_PCT = "100.0D * sum(error_count) / nullif(sum(request_count), 0)"


# --- fixed values: alert names, severities, thresholds, windows and holding times -------
RULES = [
    Rule("IngestionServiceDown", "P1", "ingestion_metrics", _age_minutes("timestamp"), True, 5, 60, 5,
         where="metric_name = 'health_check'", silence_fires=True),
    Rule("HighErrorRate", "P1", "endpoint_summary", ERRORS_PCT, True, 10, 10, 10, ts="window_start"),
    Rule("KafkaLagCritical", "P1", "kafka_metrics", "max(metric_value)", True, 100_000, 5, 5,
         where="metric_name = 'consumer_lag'"),
    Rule("QueueBacklogGrowing", "P2", "ingestion_metrics", "avg(metric_value)", True, 500, 15, 15,
         where="metric_name = 'queue_depth'"),
    Rule("SlowResponseTimes", "P2", "endpoint_summary", "avg(p95_response_time) * 1000", True, 1000, 10, 10,
         ts="window_start"),
    Rule("DiskUsageHigh", "P2", "ingestion_metrics", "max(metric_value)", True, 85, 5, 5,
         where="metric_name = 'disk_usage_pct'"),
    Rule("DataLossDetected", "critical", "processing_metrics", "count_if(lines_read - lines_processed - lines_failed > 0)", True, 0, 5),
    Rule("ProcessingFailure", "critical", "processing_metrics", "count_if(error_count > 0)", True, 0, 5),
    Rule("SuccessRateDrop", "critical", "processing_metrics",
         "avg(CAST(success_rate AS DOUBLE))", False, 90, 15),
    Rule("SlowProcessing", "warning", "processing_metrics", "avg(processing_duration_ms)", True, 120_000, 15),
    Rule("HighFailureRate", "warning", "processing_metrics",
         "avg(lines_failed * 100.0D / lines_read)", True, 1, 30),
    Rule("QualityScoreDrop", "warning", "job_quality", "avg(quality_score)", False, 95, 60),
    Rule("CacheHitRateLow", "warning", "hourly_metrics", "avg(cache_hit_rate) * 100", False, 70, 60,
         ts="window_start"),
    Rule("EdgeErrorRate", "critical", "access_logs", _share("status_code >= 400"), True, 5, 5, 2,
         ts="request_timestamp"),
    Rule("JobFailureRate", "warning", "processing_metrics", _share("error_count > 0"), True, 5, 60),
    Rule("DataStale", "warning", "access_logs", _age_minutes("request_timestamp"), True, 15, 60, ts="request_timestamp",
         silence_fires=True),
    Rule("IngestionErrors", "critical", "ingestion_requests", _share("http_status != 201"), True, 1, 5),
    Rule("QueueBacklog", "warning", "ingestion_metrics", "max(metric_value)", True, 5000, 5,
         where="metric_name = 'queue_depth'"),
    Rule("DiskFull", "critical", "ingestion_metrics", "max(metric_value)", True, 90, 5,
         where="metric_name = 'disk_usage_pct'"),
]
# --------------------------------------------------------------------------------------


def stretched(rules: list[Rule], factor: int) -> list[Rule]:
    """The same rules over longer windows, for sparse traffic."""
    return [
        replace(r, window_minutes=r.window_minutes * factor, for_minutes=r.for_minutes * factor) for r in rules
    ]


def _text(rules: list[Rule], table: str, now: str) -> str:
    """All rules of one table as SQL over ``table``, in one pass: one row per rule, with its latest value and whether it
    fires. Rows are cut to the longest span, then filed under each rule whose windows hold them; window k of
    a rule ends k windows before now. There is one row per rule even when no rule has data."""
    ts, at = rules[0].ts, f"TIMESTAMP_NTZ '{now}'"
    longest = max(r.window_minutes * r.hold for r in rules)
    filed, measures, judged = [], [], []
    for i, r in enumerate(rules):
        seconds = r.window_minutes * 60
        filed.append(f"CASE WHEN _age < {seconds * r.hold} AND ({r.where or 'true'}) THEN named_struct('no', {i}, 'k', CAST(floor(_age / {seconds}) AS INT)) END")
        measures.append(f"CAST({r.measure.format(now=_seconds(at))} AS DOUBLE) AS _v{i}")
        firing = f"count_if(no = {i} AND _v{i} {'>' if r.above else '<'} {r.threshold}) >= {r.hold}"
        if r.silence_fires:
            firing += f" OR count_if(no = {i} AND k = 0) = 0"
        judged.append(
            f"named_struct('rule', '{r.name}', 'severity', '{r.severity}', 'window_minutes', {r.window_minutes}, "
            f"'value', max(CASE WHEN no = {i} AND k = 0 THEN _v{i} END), 'threshold', {float(r.threshold)}D, 'firing', {firing})"
        )
    rows = f"SELECT *, {_seconds(at)} - {_seconds(ts)} AS _age FROM {table} WHERE {ts} > {at} - INTERVAL {longest} MINUTES AND {ts} <= {at}"
    windows = (
        f"SELECT _w.no, _w.k, {', '.join(measures)} FROM (SELECT *, explode(filter(array({', '.join(filed)}), w -> w IS NOT NULL)) AS _w FROM ({rows})) "
        "GROUP BY _w.no, _w.k"
    )
    return f"SELECT inline(array({', '.join(judged)})) FROM ({windows})"


def evaluate_alerts(tables: Callable[[str, int], DataFrame], as_of, rules: list[Rule] | None = None) -> DataFrame:
    """All rules, one row each. ``tables`` opens a table by name, with at least the rows of
    the given number of minutes before ``as_of`` (of literals), so a caller can hand in stored roll-ups;
    each table is read once, over the longest span its rules look at. The rules are one SQL text, analysed once."""
    by_table: dict[tuple[str, str], list[Rule]] = {}
    for rule in rules or RULES:
        by_table.setdefault((rule.table, rule.ts), []).append(rule)
    longest = {key: max(r.window_minutes * r.hold for r in own) for key, own in by_table.items()}
    opened = {f"t{i}": tables(key[0], longest[key]) for i, key in enumerate(by_table)}
    spark = opened["t0"].sparkSession
    now = spark.sql("SELECT 1").select(instant(as_of).cast("string")).first()[0]
    text = " UNION ALL ".join(_text(own, f"{{{name}}}", now) for name, own in zip(opened, by_table.values()))
    return spark.sql(text, **opened)
