"""Panels and series from stored roll-ups, which batches built in another order than that of time."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom import workspace
from edgeloom.catalog import analytics, dashboards
from edgeloom.functions.exprs import TS, hour_floor, instant, span
from edgeloom.plans import stored
from edgeloom.sinks.keyed import KeyedTable
from edgeloom.sinks.rollup_store import RollupStore
from edgeloom.stored_tables import StoredTables
from edgeloom.streaming import windows

#: The batches that build the store: the log in three parts, out of order, one of them twice.
ORDER = (2, 0, 2, 1)
PARTS = 3
#: Parts of an hour that readers add up; the batch after them makes one part of all.
PARTS_PER_HOUR = 4
_built: dict[tuple[str, str], str] = {}


def store_of(t) -> RollupStore:
    """The store of a directory's log, built once per application."""
    key = (t.spark.sparkContext.applicationId, t.directory)
    if key in _built and RollupStore(t.spark, _built[key]).log.numbers():
        return RollupStore(t.spark, _built[key])
    store = RollupStore(t.spark, workspace.fresh_path(t.spark, "rollups"), files_per_hour=1, parts_per_hour=PARTS_PER_HOUR)
    for batch in ORDER:
        store.merge(t.logs.where(F.col("req_id") % PARTS == batch), batch)
    _built[key] = store.path
    return store


def from_store(query):
    """A query of the log's roll-ups, on the stored ones."""
    return lambda t: query(StoredTables(t, store_of(t)))


def on_hourly(figure, days: int | None = None):
    return from_store(lambda t: figure(t.hourly(days)))


def live_baseline(t):
    """Hours of the last day with over 1.2 times a country's mean of the thirty days before, which a nightly job stored."""
    tables, hour = StoredTables(t, store_of(t)), hour_floor(instant(t.as_of))
    renewed = KeyedTable(t.spark, workspace.fresh_path(t.spark, "baseline"), "country STRING, baseline DOUBLE", ["country"], buckets=4)
    first, last = (tables.first_hour(hour - span(f"{h} hours")) for h in (744, 25))
    renewed.upsert(stored.hourly_baseline(tables.store, ["country"], first, last, 720), 0)
    now = windows.hourly_country_window(t.logs.where(F.col(TS) >= hour - span("24 hours")))
    alerts = windows.above_baseline(now, renewed.read(), ["country"], factor=1.2)
    return alerts.select("window_start", "country", "request_count", "baseline")


PANELS = [name for name in dashboards.QUERIES if name.startswith(("biz_", "cust_"))]
SERIES = [
    "requests_per_second", "error_rate_series", "p95_series", "top_endpoints", "busiest_windows", "slow_endpoints", "error_rate_spike",
    "hourly_series", "regrouped_series", "hourly_error_rate", "peak_pattern",
]
FIGURES = {
    "log_totals": on_hourly(stored.log_totals),
    "requests_by_country": on_hourly(stored.requests_by_country),
    "status_percentages": on_hourly(stored.status_percentages),
    "cache_ratio": on_hourly(stored.cache_ratio),
    "traffic_7d_by_country": on_hourly(stored.traffic_by_country, days=7),
}
BY_NAME = {n: from_store(dashboards.QUERIES[n]) for n in PANELS} | {n: from_store(analytics.QUERIES[n]) for n in SERIES} | FIGURES
QUERIES = {f"stored_{name}": query for name, query in BY_NAME.items()} | {"live_baseline": live_baseline}
