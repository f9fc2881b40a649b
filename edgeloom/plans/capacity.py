"""Traffic volume over time: rates, seasonality, growth, headroom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.exprs import (
    TS, day_start, gib, hour_floor, instant, n_where, pct, share, since, since_day, span,
)

# --- fixed values: planning factors ----------------------------------------------------
GROWTH_FACTOR = 1.2
EVENT_MULTIPLIER = 1.5
SAFETY_MARGIN = 1.3
MONTHLY_GROWTH = 1.234
# --------------------------------------------------------------------------------------


def traffic_per_minute(logs: DataFrame, as_of, window="1 hour") -> DataFrame:
    return (
        since(logs, as_of, window)
        .groupBy(F.date_trunc("minute", TS).alias("time"))
        .agg(
            F.count(F.lit(1)).alias("requests_per_minute"),
            F.countDistinct("cli_ip").alias("unique_ips"),
            n_where(F.col("status_code") >= 400).alias("error_count"),
        )
        .orderBy(F.desc("time"))
    )


def seasonality(logs: DataFrame, as_of, window="90 days") -> DataFrame:
    """Hourly volume with its weekday (Sunday is 0) and hour of day."""
    hourly = (
        since(logs, as_of, window)
        .groupBy(hour_floor(TS).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            gib(F.sum("bytes")).alias("gb_served"),
            F.avg("ttfb_ms").alias("avg_ttfb_ms"),
            F.max("ttfb_ms").alias("max_ttfb_ms"),
        )
    )
    return hourly.withColumns(
        {"day_of_week": F.dayofweek("hour") - 1, "hour_of_day": F.hour("hour")}
    ).orderBy("hour")


def current_rps(logs: DataFrame, as_of, seconds=5) -> DataFrame:
    return since(logs, as_of, f"{seconds} seconds").agg(
        (F.count(F.lit(1)) / F.lit(float(seconds))).alias("requests_per_second")
    )


def capacity_peak(
    logs: DataFrame, growth=GROWTH_FACTOR, event=EVENT_MULTIPLIER, safety=SAFETY_MARGIN
) -> DataFrame:
    """Busiest second on record and the rate to plan for."""
    per_second = logs.groupBy(F.date_trunc("second", TS).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return per_second.agg(
        F.max("n").alias("historical_peak"),
        (F.max("n") * F.lit(growth) * F.lit(event) * F.lit(safety)).alias("planned_peak"),
    )


def daily_traffic(logs: DataFrame, as_of, days=30) -> DataFrame:
    return (
        since_day(logs, as_of, days)
        .groupBy(F.to_date(TS).alias("date"))
        .agg(gib(F.sum("bytes")).alias("traffic_gb"))
        .orderBy("date")
    )


def rps_per_minute(logs: DataFrame, as_of, window="1 hour") -> DataFrame:
    return (
        since(logs, as_of, window, inclusive=True)
        .groupBy(F.date_trunc("minute", TS).alias("minute"))
        .agg((F.count(F.lit(1)) / F.lit(60.0)).alias("rps"))
        .orderBy("minute")
    )


def noc_now(logs: DataFrame, as_of, minutes=5) -> DataFrame:
    """The last minutes against the ones before, in one pass over both."""
    now = F.col(TS) >= instant(as_of) - span(f"{minutes} minutes")
    error = F.col("status_code") >= 400
    seconds = F.lit(minutes * 60.0)
    requests = n_where(now)
    return since(logs, as_of, f"{2 * minutes} minutes", inclusive=True).agg(
        (requests / seconds).alias("current_rps"),
        (F.sum(F.when(now, F.col("bytes"))) * F.lit(8.0) / seconds / F.lit(float(1024**3))).alias("current_gbps"),
        F.avg(F.when(now, F.col("ttfb_ms"))).alias("avg_latency_ms"),
        pct(n_where(now & error), requests).alias("current_error_rate"),
        pct(n_where(~now & error), n_where(~now)).alias("prev_error_rate"),
        pct(n_where(now & (F.col("cache_status") == 1)), requests).alias("cache_hit_rate"),
    )


def growth_by_period(logs: DataFrame, as_of, grain="month", history="12 months") -> DataFrame:
    """Volume per period with the previous one and the growth between them."""
    start = F.col("period")
    previous = F.lag("traffic_gb").over(Window.orderBy("period"))
    return (
        logs.filter(F.col(TS) >= day_start(as_of) - span(history))
        .groupBy(F.date_trunc(grain, TS).alias("period"))
        .agg(gib(F.sum("bytes")).alias("traffic_gb"))
        .withColumn("prev_traffic_gb", previous)
        .withColumn("growth_rate", pct(F.col("traffic_gb") - F.col("prev_traffic_gb"), F.col("prev_traffic_gb")))
        .orderBy(start.desc())
    )


def monthly_growth(logs: DataFrame, as_of) -> DataFrame:
    return growth_by_period(logs, as_of).select(
        F.col("period").alias("month"), "traffic_gb",
        F.col("prev_traffic_gb").alias("prev_month_traffic_gb"), "growth_rate",
    )


def growth_projection(logs: DataFrame, as_of, history="3 months", ahead=12, factor=MONTHLY_GROWTH) -> DataFrame:
    """Mean volume of a day, compounded by a fixed monthly factor."""
    daily = logs.filter(F.col(TS) >= day_start(as_of) - span(history)).groupBy(F.to_date(TS).alias("date")).agg(F.sum("bytes").alias("bytes"))
    base = daily.agg(F.date_trunc("month", F.max("date")).alias("base_month"), F.avg("bytes").alias("mean_bytes"))
    step = F.col("step")
    return base.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(ahead)))).select(
        F.add_months("base_month", step).alias("forecast_month"),
        gib(F.col("mean_bytes") * F.pow(F.lit(factor), step)).alias("projected_traffic_gb"),
    )


def growth_trend(logs: DataFrame, as_of, history="30 days", ahead=12) -> DataFrame:
    """Least-squares line through the daily volumes, extended ``ahead`` days."""
    daily = (
        logs.filter(F.col(TS) >= day_start(as_of) - span(history))
        .groupBy(F.to_date(TS).alias("date"))
        .agg(F.sum("bytes").alias("bytes"))
        .withColumn("x", F.datediff("date", instant(as_of)))
    )
    fit = daily.agg(
        F.regr_slope("bytes", "x").alias("slope"),
        F.regr_intercept("bytes", "x").alias("intercept"),
    )
    step = F.col("days_ahead")
    return fit.withColumn("days_ahead", F.explode(F.sequence(F.lit(0), F.lit(ahead)))).select(
        "days_ahead", gib(F.col("intercept") + F.col("slope") * step).alias("projected_traffic_gb")
    )


def peak_pattern(summary: DataFrame) -> DataFrame:
    """Hourly totals of a roll-up, summarised per (hour of day, weekday; Sunday is 1)."""
    hourly = summary.groupBy(hour_floor("window_start").alias("hour")).agg(F.sum("request_count").alias("total"))
    return (
        hourly.groupBy(F.hour("hour").alias("hour_of_day"), F.dayofweek("hour").alias("day_of_week"))
        .agg(
            F.avg("total").alias("avg_requests"),
            F.max("total").alias("peak_requests"),
            F.percentile("total", 0.95).alias("p95_requests"),
        )
        .orderBy("day_of_week", "hour_of_day")
    )
