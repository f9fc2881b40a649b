"""Reading archives by time: partition columns and dated folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_archive(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Parquet archive partitioned by year/month/day; only folders in [start, end] are read."""
    archive = spark.read.parquet(path)
    day = partition_day()
    if start is not None:
        archive = archive.filter(day >= F.lit(start))
    if end is not None:
        archive = archive.filter(day <= F.lit(end))
    return archive


def look_up(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None, **values) -> DataFrame:
    """Rows of the archive with the given column values. Days, then files and row groups that cannot hold them are skipped."""
    rows = read_archive(spark, path, start, end)
    for column, value in values.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows


def partition_day() -> Column:
    """Date of a row from its partition columns alone, so the filter prunes folders."""
    return F.make_date("year", "month", "day")


def hour_folders(base: str, start: dt.datetime, end: dt.datetime) -> str:
    """One glob over the YYYY/MM/DD/HH folders of [start, end); absent hours match nothing. Years, months and days that
    are whole are one name each, hours are named at both ends only: a year is a handful of names."""
    hour, names = start.replace(minute=0, second=0, microsecond=0), []
    while hour < end:
        for first, after, form in _SPANS:
            if hour == first(hour) and (after(hour) <= end or form.endswith("%H")):
                names.append(hour.strftime(form))
                hour = after(hour)
                break
    return f"{base.rstrip('/')}/{{{','.join(names)}}}"


def _year(t: dt.datetime) -> dt.datetime:
    return t.replace(month=1, day=1, hour=0)


def _month(t: dt.datetime) -> dt.datetime:
    return t.replace(day=1, hour=0)


def _day(t: dt.datetime) -> dt.datetime:
    return t.replace(hour=0)


_SPANS = (
    (_year, lambda t: t.replace(year=t.year + 1), "%Y/*/*/*"),
    (_month, lambda t: _month(t + dt.timedelta(days=31)), "%Y/%m/*/*"),
    (_day, lambda t: t + dt.timedelta(days=1), "%Y/%m/%d/*"),
    (lambda t: t, lambda t: t + dt.timedelta(hours=1), "%Y/%m/%d/%H"),
)
