"""The table set a query runs on, with its reference instant."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.fixture_logs import (
    ACCESS_LOGS_SELECT, DIRTY_LOGS_SELECT, PIPELINE_TABLES, REPLAYED_LOGS_SELECT,
)
from edgeloom.functions.exprs import TS, instant, since, since_day
from edgeloom.operators.rollups import daily_metrics


LOOK_BACK_DAYS = (1, 32, 1024, 16384)


class LogTables:
    """Lazily opened tables of one data directory.

    ``as_of`` replaces "now" in every relative-time query. Left out, it is the newest
    request. Either way queries filter by a literal, which reaches the scan and prunes it.
    """

    def __init__(self, spark: SparkSession, directory: str, as_of=None, first: Column | None = None):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._as_of = as_of
        self._first = first
        self._opened: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        """A table, whose files are listed and schema read once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._opened[name]

    def table(self, name: str) -> DataFrame:
        rows = self._read(name)
        return rows if name != "events" or self._first is None else rows.where(F.col("ts") >= self._first)

    def after(self, first: Column) -> LogTables:
        """The same tables without events before ``first``: what is derived from them reads no more."""
        cut = type(self)(self.spark, self.directory, self.as_of, first)
        cut._opened = self._opened
        return cut

    @cached_property
    def logs(self) -> DataFrame:
        """Canonical access log, derived from the ``events`` table."""
        return self.spark.sql(ACCESS_LOGS_SELECT + " FROM {events}", events=self.table("events"))

    @property
    def as_of(self) -> Column:
        if self._as_of is not None:
            return instant(self._as_of)
        return F.lit(self._newest).cast("timestamp_ntz")

    @cached_property
    def _newest(self) -> str | None:
        """Time of the newest request, found once per table set. The search looks back from
        today over growing spans, and Parquet statistics skip row groups that end before
        a span, so of a table that is written in order of time only the end is read."""
        times = self.table("events").select("ts")
        newest = F.max("ts").cast("timestamp_ntz").cast("string")
        for days in LOOK_BACK_DAYS:
            begin = dt.date.today() - dt.timedelta(days=days)
            found = times.where(F.col("ts") >= F.lit(begin).cast("timestamp_ntz")).agg(newest).first()[0]
            if found is not None:
                return found
        return times.agg(newest).first()[0]

    def recent(self, rollup, window: str, start: str = "window_start") -> DataFrame:
        """Roll-up rows whose window began within ``window`` of ``as_of``. The log is cut
        to the same bound first, so only that range is scanned and aggregated."""
        cut = since(self.logs, self.as_of, window, inclusive=True)
        return since(rollup(cut), self.as_of, window, ts=start, inclusive=True)

    def daily(self, days: int) -> DataFrame:
        """The daily roll-up of so many days before today, and today."""
        return daily_metrics(since_day(self.logs, self.as_of, days))

    def errors(self, window: str) -> DataFrame:
        """Requests of the recent past, of which a panel lists the failed ones."""
        return since(self.logs, self.as_of, window, inclusive=True)

    def arrivals(self) -> DataFrame:
        """Rows whose newest time says how fresh the log is."""
        return self.logs

    def pipeline(self, name: str) -> DataFrame:
        """A pipeline-metric table (see ``fixture_logs.PIPELINE_TABLES``)."""
        select, tail = PIPELINE_TABLES[name]
        return self.spark.sql(f"{select} FROM {{events}}{tail}", events=self.table("events"))

    def recent_metrics(self, name: str, window: str) -> DataFrame:
        return since(self.pipeline(name), self.as_of, window, ts="timestamp", inclusive=True)

    @cached_property
    def dirty_logs(self) -> DataFrame:
        return self.spark.sql(DIRTY_LOGS_SELECT + " FROM {logs}", logs=self.logs)

    @cached_property
    def replayed_logs(self) -> DataFrame:
        return self.spark.sql(REPLAYED_LOGS_SELECT, logs=self.logs)
