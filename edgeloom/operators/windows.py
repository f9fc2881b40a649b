"""Window operators: deduplication, rate limits, sustained breaches, baselines, trends.

No window here is partitioned so that a hot key's raw rows meet in one task: input is
aggregated first, and long series are cut into slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from edgeloom.functions.exprs import TS, epoch_seconds, instant, span


def dedup_latest(df: DataFrame, keys: list[str], newest_by: str) -> DataFrame:
    """Keep the newest row per key, as ``row_number() = 1`` would.

    The limit to one row per key is planned in the map tasks too, so a key that holds a
    third of the table leaves each task as one row. Rows equal in ``newest_by`` are
    separated by their remaining columns, left to right, as far as these can be ordered
    (maps cannot).
    """
    ordered = [f.name for f in df.schema.fields if f.name not in keys and f.name != newest_by and _sortable(f.dataType)]
    newest = Window.partitionBy(*keys).orderBy(F.desc(newest_by), *[F.desc(c) for c in ordered])
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).select(*df.columns)


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def rate_limit_violations(
    logs: DataFrame, by: str = "cli_ip", limit: int = 100, window_seconds: int = 60,
    ts: str = TS, slice_seconds: int = 3600,
) -> DataFrame:
    """Seconds in which a client exceeded ``limit`` requests per sliding window.

    Counts every request, admitted or not (a limiter that forgets refused requests would
    need each client's history in order). One row per client and second: ``requests`` made
    in it, ``requests_in_window`` up to its end, and ``refused``, those of the second that
    came when the window was full.

    The log shrinks to counts per (client, second) before it is shuffled. The sliding sum
    runs per (client, time slice); seconds at the end of a slice are repeated in the next
    one, so the sum is exact and no partition is longer than a slice and a window.
    """
    slice_seconds = max(slice_seconds, window_seconds)
    second = F.unix_seconds(F.col(ts).cast("timestamp")).alias("s")
    counts = logs.groupBy(by, second).agg(F.count(F.lit(1)).alias("n"))
    home = F.floor(F.col("s") / slice_seconds).cast("long")
    reaches_next = F.col("s") + (window_seconds - 1) >= (F.col("home") + 1) * slice_seconds
    sliced = counts.withColumn("home", home).withColumn(
        "slice",
        F.explode(F.when(reaches_next, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))),
    )
    recent = Window.partitionBy(by, "slice").orderBy("s").rangeBetween(-(window_seconds - 1), 0)
    return (
        sliced.withColumn("requests_in_window", F.sum("n").over(recent))
        .filter((F.col("slice") == F.col("home")) & (F.col("requests_in_window") > limit))
        .select(
            by,
            F.timestamp_seconds("s").alias("second"),
            F.col("n").alias("requests"),
            "requests_in_window",
            F.least("n", F.col("requests_in_window") - limit).alias("refused"),
        )
    )


def sustained_breaches(
    series: DataFrame, keys: list[str], time: str, breached: Column, step_seconds: int, periods: int
) -> DataFrame:
    """Runs of at least ``periods`` consecutive breached windows, per key.

    A missing window is no data and ends a run: neighbours must be one step apart. Only
    breached windows are shuffled.
    """
    index = F.floor(epoch_seconds(F.col(time)) / step_seconds).cast("long")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(time))
    return (
        series.filter(breached)
        .withColumn("_run", index - rank)
        .groupBy(*keys, "_run")
        .agg(F.min(time).alias("breach_start"), F.max(time).alias("breach_end"), F.count(F.lit(1)).alias("periods"))
        .filter(F.col("periods") >= periods)
        .drop("_run")
    )


def trailing_baseline(
    series: DataFrame, keys: list[str], time: str, value: str, periods: int, factor: float
) -> DataFrame:
    """Compare each window with the mean of the ``periods`` windows before it."""
    before = Window.partitionBy(*keys).orderBy(time).rowsBetween(-periods, -1)
    baseline = F.col("baseline")
    return series.withColumn("baseline", F.avg(value).over(before)).withColumn(
        "is_spike", F.coalesce(F.col(value) > baseline * factor, F.lit(False))
    )


def trend_anomalies(
    series: DataFrame, keys: list[str], time: str, value: str, as_of, judge: str = "24 hours", factor: float = 2.0
) -> DataFrame:
    """Fit a least-squares line per key to the history, judge the latest windows by it.

    Slope and intercept are closed-form aggregates with map-side partials, so history is
    read once and shuffled as one row per key and task. ``x`` is hours before ``as_of``.
    """
    cut = instant(as_of) - span(judge)
    x = (epoch_seconds(F.col(time)) - epoch_seconds(instant(as_of))) / F.lit(3600.0)
    points = series.withColumn("_x", x)
    fit = points.filter(F.col(time) < cut).groupBy(*keys).agg(
        F.regr_slope(value, "_x").alias("_slope"), F.regr_intercept(value, "_x").alias("_intercept")
    )
    predicted = F.col("_intercept") + F.col("_slope") * F.col("_x")
    return (
        points.filter(F.col(time) >= cut)
        .join(fit, keys)
        .withColumn("predicted", predicted)
        .withColumn("is_anomaly", F.coalesce(F.col(value) > F.col("predicted") * factor, F.lit(False)))
        .select(*keys, time, F.col(value).alias("actual"), "predicted", "is_anomaly")
    )


def share_of_total(counts: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """Percentage of the column total, for grouped rows whose total is a scalar."""
    total = counts.agg(F.sum(value)).scalar()
    return counts.withColumn(out, F.col(value) * F.lit(100.0) / F.nullif(total, F.lit(0)))
