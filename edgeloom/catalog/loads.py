"""Loads in batches: upserts by key and ``INSERT IGNORE`` by seen keys, with batches out of order and repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from edgeloom import workspace
from edgeloom.functions.exprs import TS, instant, since
from edgeloom.sinks import tables
from edgeloom.sinks.keyed import KeyedTable, SeenKeys
from edgeloom.sources import archive

ROW = "req_id BIGINT, created_at TIMESTAMP_NTZ, status_code INT"
BATCHES = 3
BUCKETS = 8


def _sent(t):
    """Requests and their replays as they are sent, with the load that each comes in."""
    batch = F.pmod(F.dayofyear("created_at"), F.lit(BATCHES)).alias("load")
    return t.replayed_logs.select("req_id", "created_at", "status_code", batch)


def upserts(t):
    """The newest load's row of each request; in a load, the row sent last. The second load comes first, the first one twice."""
    table = KeyedTable(t.spark, workspace.fresh_path(t.spark, "upserts"), ROW, ["req_id"], BUCKETS)
    sent = _sent(t)
    for b in (1, 0, 2, 0):
        table.upsert(sent.where(F.col("load") == b).drop("load"), b)
    table.compact()
    return table.read()


def insert_ignored(t):
    """Requests that each load lets in: a request that an earlier load let in is refused, whatever its time."""
    seen = SeenKeys(t.spark, workspace.fresh_path(t.spark, "seen"), ["req_id"], "req_id BIGINT", BUCKETS)
    path, sent = workspace.fresh_path(t.spark, "let-in"), _sent(t)
    for b in (0, 0, 1, 2):
        tables.write_batch(seen.unseen(sent.where(F.col("load") == b), b, ["created_at"]), b, path)
        seen.record(t.spark.read.parquet(f"{path}/{tables.BATCH}={b}"), b)
    return t.spark.read.parquet(path).select("req_id", "created_at", "load")


def archived_lookup(t):
    """One address of the last week, from an archive that is laid out for it."""
    path = workspace.fresh_path(t.spark, "lookup")
    tables.write_lookup_archive(t.logs, path, files_per_day=1, days=30)
    now = t.spark.sql("SELECT 1").select(instant(t.as_of).cast("timestamp_ntz")).first()[0]
    rows = archive.look_up(t.spark, path, (now - dt.timedelta(days=7)).date(), now.date(), cli_ip="203.0.0.10")
    return since(rows, t.as_of, "7 days", inclusive=True).select("req_id", TS, "req_path", "status_code")


QUERIES = {"keyed_upserts": upserts, "insert_ignored": insert_ignored, "archived_point_lookup": archived_lookup}
