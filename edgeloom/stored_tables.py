"""The table set whose roll-ups come from a store instead of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from edgeloom.context import LogTables
from edgeloom.functions.exprs import day_start, instant, since, span
from edgeloom.operators import rollups
from edgeloom.plans import stored
from edgeloom.sinks.rollup_store import RollupStore, folder_of

SHAPES = {
    rollups.hourly_metrics: stored.hourly_metrics,
    rollups.performance_metrics: stored.performance_metrics,
    rollups.business_metrics: stored.business_metrics,
    rollups.endpoint_summary: stored.endpoint_summary,
    rollups.status_summary: stored.status_summary,
}


class StoredTables(LogTables):
    """Panels and reports ask for roll-ups as they do of the log. Only the folders of the hours asked for are opened."""

    def __init__(self, tables: LogTables, store: RollupStore) -> None:
        super().__init__(tables.spark, tables.directory, tables._as_of, tables._first)
        self._newest, self._opened = tables._newest, tables._opened
        self.store = store

    def first_hour(self, begin) -> str:
        """The folder of the hour in which the time ``begin`` (of literals) falls, worked out by the driver."""
        return self.spark.sql("SELECT 1").select(begin.cast("timestamp_ntz").alias("hour")).select(folder_of()).first()[0]

    def recent(self, rollup, window: str, start: str = "window_start") -> DataFrame:
        first = self.first_hour(instant(self.as_of) - span(window))
        return since(SHAPES[rollup](self.store, first), self.as_of, window, ts=start, inclusive=True)

    def daily(self, days: int) -> DataFrame:
        return stored.daily_metrics(self.store, self.first_hour(day_start(self.as_of) - span(f"{days} days")))

    def errors(self, window: str) -> DataFrame:
        rows = stored.error_rows(self.store, self.first_hour(instant(self.as_of) - span(window)))
        return since(rows, self.as_of, window, inclusive=True)

    def arrivals(self) -> DataFrame:
        return stored.newest_hours(self.store)

    def hourly(self, days: int | None = None) -> DataFrame:
        """Partials of whole days, or of all."""
        return self.store.rows("hourly", None if days is None else self.first_hour(day_start(self.as_of) - span(f"{days} days")))
