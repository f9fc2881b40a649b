"""The roll-ups that panels and reports read, from stored partials (see ``sinks.rollup_store``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS, mib, pct
from edgeloom.operators.rollups import QUANTILES

MS = "response_time_ms"


def histogram() -> Column:
    """(value, number) of a key's milliseconds in order. A key has as many entries as different milliseconds."""
    return F.array_sort(F.collect_list(F.when(F.col(MS).isNotNull(), F.struct(F.col(MS).cast("long").alias("at"), F.col("request_count").alias("n")))))


def quantile(bins: str, share: float) -> Column:
    """The least value that at least ``share`` of a histogram's entries do not exceed; NULL without entries."""
    total = F.aggregate(bins, F.lit(0).cast("long"), lambda n, b: n + b["n"])
    rank = F.greatest(F.lit(1).cast("long"), total - F.floor(total - F.lit(share) * total))
    begin = F.struct(rank.alias("left"), F.lit(None).cast("long").alias("at"))

    def step(done: Column, b: Column) -> Column:
        return F.struct((done["left"] - b["n"]).alias("left"), F.when(done["left"] <= 0, done["at"]).otherwise(b["at"]).alias("at"))

    return F.aggregate(bins, begin, step, lambda done: done["at"])


def _latency(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    n = F.when(F.col(MS).isNotNull(), F.col("request_count"))
    return rows.groupBy(*keys).agg(
        F.sum("request_count").alias("request_count"),
        F.sum(F.col(MS) * F.col("request_count")).alias("response_time_sum"),
        F.coalesce(F.sum(n), F.lit(0)).alias("response_time_cnt"),
        F.min(MS).alias("_min"), F.max(MS).alias("_max"), histogram().alias("_bins"), *more,
    )


def _mean() -> Column:
    return F.col("response_time_sum") / F.nullif(F.col("response_time_cnt"), F.lit(0))


def hourly_metrics(store, first: str | None = None) -> DataFrame:
    out = _latency(
        store.rows("hourly", first), ["hour", "country", "status_code", "cache_status"], F.sum("total_bytes").alias("total_bytes"),
        F.sum("error_count").alias("error_count"), F.sum("cache_hits").alias("cache_hits"),
    )
    quantiles = {f"{p}_response_time": quantile("_bins", q) for p, q in QUANTILES.items()}
    out = out.withColumns({"avg_response_time": _mean(), "cache_hit_rate": F.col("cache_hits") / F.col("request_count"), **quantiles})
    return out.withColumnRenamed("hour", "window_start").drop("_bins", "_min", "_max")


def performance_metrics(store, first: str | None = None) -> DataFrame:
    out = _latency(store.rows("paths", first), ["hour", "req_path"], F.sum("cache_hits").alias("_hits"))
    more = {"avg_response_time_ms": _mean(), "p95_response_time_ms": quantile("_bins", 0.95), "cache_hit_rate": F.col("_hits") / F.col("request_count")}
    return out.withColumns(more).select("hour", "req_path", "request_count", *more)


def business_metrics(store, first: str | None = None) -> DataFrame:
    return store.rows("clients", first)


def daily_metrics(store, first: str | None = None) -> DataFrame:
    """Visitors are counted exactly: each is a row of the hours it came in."""
    return store.rows("visitors", first).groupBy("date").agg(
        F.sum("request_count").alias("total_requests"), F.countDistinct("cli_ip").alias("unique_visitors"),
        F.sum("total_bytes").alias("total_bytes"), (F.sum("cache_hits") / F.sum("request_count")).alias("cache_hit_rate"),
    )


def _seconds(rows: DataFrame, keys: list[str]) -> DataFrame:
    milli = F.lit(1000.0)
    return rows.select(
        "window_start", *keys, "request_count", (_mean() / milli).alias("avg_response_time"), (F.col("_min") / milli).alias("min_response_time"),
        (F.col("_max") / milli).alias("max_response_time"), (quantile("_bins", 0.95) / milli).alias("p95_response_time"),
        (quantile("_bins", 0.99) / milli).alias("p99_response_time"), "error_count", *[c for c in rows.columns if c == "unique_ips"],
    )


def endpoint_summary(store, first: str | None = None) -> DataFrame:
    rows = store.rows("endpoints", first).withColumnsRenamed({"req_path": "endpoint", "req_method": "method"})
    return _seconds(_latency(rows, ["window_start", "endpoint", "method"], F.sum("error_count").alias("error_count")), ["endpoint", "method"])


def status_summary(store, first: str | None = None) -> DataFrame:
    """Requests and sketches of addresses meet in a union, where a NULL status groups like any other."""
    rows = store.rows("statuses", first).unionByName(store.rows("status_visitors", first), allowMissingColumns=True)
    out = _latency(
        rows.withColumnRenamed("status_code", "status"), ["window_start", "status"], F.sum("error_count").alias("error_count"),
        F.hll_sketch_estimate(F.hll_union_agg("ip_sketch")).alias("unique_ips"),
    )
    return _seconds(out, ["status"])


# -- figures over the whole log, from hourly partials --------------------------------------


def log_totals(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        F.sum("request_count").alias("total_requests"), F.countDistinct("country").alias("countries"),
        (F.sum("ttfb_sum") / F.sum("ttfb_count")).alias("avg_ttfb_ms"), mib(F.sum("total_bytes")).alias("total_mb"),
    )


def requests_by_country(hourly: DataFrame, limit: int = 10) -> DataFrame:
    out = hourly.groupBy("country").agg(F.sum("request_count").alias("requests"), (F.sum("ttfb_sum") / F.sum("ttfb_count")).alias("avg_ttfb_ms"))
    return out.orderBy(F.desc("requests"), "country").limit(limit)


def status_percentages(hourly: DataFrame) -> DataFrame:
    counts = hourly.groupBy("status_code").agg(F.sum("request_count").alias("requests"))
    total = counts.agg(F.sum("requests")).scalar()
    return counts.withColumn("percentage", pct(F.col("requests"), total)).orderBy("status_code")


def cache_ratio(hourly: DataFrame) -> DataFrame:
    def bytes_where(state: int) -> Column:
        return mib(F.sum(F.when(F.col("cache_status") == state, F.col("total_bytes")).otherwise(0)))

    hits = F.sum(F.when(F.col("cache_status") == 1, F.col("request_count")).otherwise(0))
    return hourly.agg(pct(hits, F.sum("request_count")).alias("cache_hit_ratio_pct"), bytes_where(1).alias("cached_mb"), bytes_where(0).alias("origin_mb"))


def traffic_by_country(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("country").agg(F.sum("total_bytes").alias("traffic"))


def error_rows(store, first: str | None = None) -> DataFrame:
    """Single error requests, as the security panel lists them."""
    return store.rows("errors", first)


def newest_hours(store) -> DataFrame:
    """The newest stored hour in the place of the newest request."""
    hours = [h for h in store.hours() if h.isdigit()]
    return store.rows("clients", hours[-1] if hours else None).select(F.col("hour").alias(TS))


def hourly_baseline(store, keys: list[str], first: str, last: str, hours: int) -> DataFrame:
    """Mean requests an hour of each key in the ``hours`` hours from ``first`` to ``last`` (folder names), as alerts compare with."""
    rows = store.rows("hourly", first, last).groupBy(*keys)
    return rows.agg((F.sum("request_count") / F.lit(float(hours))).alias("baseline"))
