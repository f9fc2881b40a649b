"""Sessions: runs of a visitor's requests with no pause longer than ``gap``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.exprs import TS, epoch_seconds


def sessionize(
    logs: DataFrame, by: str = "user_id", gap: str = "30 minutes", ts: str = TS,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per session: bounds, duration in seconds, requests, and optional sums.

    Requests of one visitor inside one gap-long clock slot are always in the same
    session, so the log is first reduced to (visitor, slot) with map-side partials. The
    window that finds the pauses then sees at most one row per slot: a visitor with a
    third of all requests costs as many rows as there are slots in the period.
    """
    sums = sums or {}
    slot = F.window(ts, gap).alias("_slot")
    slots = logs.groupBy(by, slot).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("requests"),
        *[F.sum(col).alias(name) for name, col in sums.items()],
    )
    order = Window.partitionBy(by).orderBy("_first")
    pause = F.col("_first") - F.lag("_last").over(order)
    opens = F.when(F.coalesce(pause > F.expr(f"INTERVAL {gap}"), F.lit(True)), 1).otherwise(0)
    numbered = slots.withColumn("_opens", opens).withColumn("session_no", F.sum("_opens").over(order))
    out = numbered.groupBy(by, "session_no").agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("session_end"),
        F.sum("requests").alias("requests"),
        *[F.sum(name).alias(name) for name in sums],
    )
    seconds = epoch_seconds(F.col("session_end")) - epoch_seconds(F.col("session_start"))
    return out.withColumn("duration_seconds", seconds)
