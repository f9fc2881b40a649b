"""Small column helpers shared by roll-ups and queries.

Everything here returns a ``Column`` made of built-in functions, so plans stay in
whole-stage codegen and filters keep reaching the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS = "request_timestamp"


def span(text: str) -> Column:
    """``span("24 hours")`` -> an interval column."""
    return F.expr(f"INTERVAL {text}")


def instant(value: Column | dt.datetime | str) -> Column:
    """Accept an ``as_of`` given as literal or as a (scalar subquery) column.

    A literal is the better choice for a scheduled job: it is folded into the scan
    filter at planning time. A naive datetime is read as UTC wall clock.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def since(df: DataFrame, as_of, window: str, ts: str = TS, inclusive: bool = False) -> DataFrame:
    """Rows newer than ``as_of - window``. The bare column stays on the left side so
    the bound can be compared with Parquet row-group statistics."""
    bound = instant(as_of) - span(window)
    return df.filter(F.col(ts) >= bound if inclusive else F.col(ts) > bound)


def since_day(df: DataFrame, as_of, days: int, ts: str = TS) -> DataFrame:
    """Rows of the ``days`` calendar days before the day of ``as_of``, and that day."""
    return df.filter(F.col(ts) >= day_start(as_of) - span(f"{days} days"))


def day_start(as_of) -> Column:
    return F.to_date(instant(as_of)).cast("timestamp_ntz")


def hour_floor(col: Column | str) -> Column:
    """Start of the hour as zone-free wall clock; zone-free input never meets the session's zone."""
    return F.to_date(col).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(col))


def n_where(cond: Column) -> Column:
    return F.count_if(cond)


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL where whole is 0."""
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def share(cond: Column) -> Column:
    """Percentage of the group's rows that satisfy ``cond``."""
    return pct(F.count_if(cond), F.count(F.lit(1)))


def sum_where(value: Column | str, cond: Column) -> Column:
    """``SUM(value) FILTER (WHERE cond)``; NULL when nothing qualifies."""
    return F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value))


def gib(col: Column) -> Column:
    return col / F.lit(float(1024**3))


def mib(col: Column) -> Column:
    return col / F.lit(float(1024**2))


def kib(col: Column) -> Column:
    return col / F.lit(1024.0)


def distinct_next_to_sketch(col: str) -> Column:
    """Exact distinct count for aggregates that also hold quantile sketches.

    With a plain ``count(DISTINCT x)`` Spark first groups *every* aggregate by
    (keys, x), so a sketch would be built and shuffled per (keys, x). The FILTER makes
    the planner expand the distinct branch on its own: sketches are then built once per
    key with map-side partials. NULLs are not counted either way.
    """
    return F.expr(f"count(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL)")


EPOCH = "1970-01-01 00:00:00"


def utc_seconds(seconds: Column) -> Column:
    """Epoch seconds as zone-free UTC wall clock."""
    none = F.lit(0)
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds.cast("decimal(18,6)"))


def seconds_of_utc(wall: Column) -> Column:
    """Epoch seconds of zone-free UTC wall clock."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), wall.cast("timestamp_ntz"))


def epoch_seconds(col: Column) -> Column:
    """Seconds since 1970 as DOUBLE, keeping fractions."""
    return F.unix_micros(col.cast("timestamp")) / F.lit(1_000_000.0)
