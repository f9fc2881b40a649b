"""The nightly batch: read files, validate, archive, roll up, keep a ledger."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS, hour_floor
from edgeloom.operators import quality
from edgeloom.operators.enrich import from_cdn_layout
from edgeloom.plans import stored
from edgeloom.sinks import tables as sinks
from edgeloom.sinks.rollup_store import RollupStore, folder_of
from edgeloom.sources import cdn
from edgeloom.sources.archive import partition_day
from edgeloom.sources.schemas import CORRUPT

MALFORMED = "malformed"
DAY = ("year", "month", "day")


@dataclass(frozen=True)
class DailyOutputs:
    """Where a batch writes: roll-ups (see ``sinks.rollup_store``), rows by run and by the day they are of, rejected lines, quality, runs."""

    rollups: str
    archive: str
    quarantine: str
    quality: str
    ledger: str


def daily_batch(spark: SparkSession, paths: list[str] | str, day: dt.date, out: DailyOutputs) -> None:
    """Process the files of the run of ``day``. Running it again replaces what it did before.

    The files are gzip text: one pass parses each line, counts it for the ledger and lands it as Parquet, malformed ones apart; later
    steps read landed columns. Rows are filed by their own day, whichever run brings them. The hours that
    the run has rows of, or had when it ran before, are made again from the archive, so each hour has one
    roll-up of all runs, in whatever order they come.
    """
    run_id = int(day.strftime("%Y%m%d"))
    lines = spark.read.text(paths)
    with sinks.Run(spark, out.ledger, "daily_batch", str(run_id), files=len(lines.inputFiles())) as run:
        touched = hours_of(spark, out, run_id)
        parsed = run.counting(cdn.parse_lines(lines), F.col(CORRUPT).isNotNull())
        landed = from_cdn_layout(parsed, CORRUPT).withColumn(MALFORMED, F.col(CORRUPT).isNotNull().cast("int"))
        sinks.write_batch(sinks.with_day_partitions(landed), run_id, out.archive, (MALFORMED, *DAY))
        run.counted()
        mine = spark.read.parquet(f"{out.archive}/{sinks.BATCH}={run_id}")
        sinks.write_quarantine(mine.where(f"{MALFORMED} = 1").select(F.col(CORRUPT).alias("line")), out.quarantine, run_id)
        touched |= hours_of(spark, out, run_id)
        _roll_up(spark, out, touched)
        midnight = dt.datetime.combine(day, dt.time()) + dt.timedelta(days=1)
        sinks.write_batch(_quality_totals(quality.quality_flags(mine.where(f"{MALFORMED} = 0"), midnight)), run_id, out.quality)


def archived(spark: SparkSession, out: DailyOutputs, days: list[dt.date] | None = None) -> DataFrame:
    """Well-formed rows of all runs; of ``days`` alone, whose folders are the only ones opened."""
    rows = spark.read.parquet(out.archive).where(f"{MALFORMED} = 0").drop(MALFORMED, CORRUPT)
    return rows if days is None else rows.where(partition_day().isin(days) if days else F.lit(False))


def hours_of(spark: SparkSession, out: DailyOutputs, run_id: int) -> set[str]:
    """Folder names of the hours that a run has rows of in the archive; none before it ran. One value an hour reaches the driver."""
    store = RollupStore(spark, out.rollups)
    if f"{sinks.BATCH}={run_id}" not in store.log.folders(out.archive):
        return set()
    mine = spark.read.parquet(f"{out.archive}/{sinks.BATCH}={run_id}").where(f"{MALFORMED} = 0")
    return {r.h for r in mine.select(hour_floor(TS).alias("hour")).distinct().select(folder_of().alias("h")).collect()}


def _roll_up(spark: SparkSession, out: DailyOutputs, hours: set[str]) -> None:
    days = sorted({dt.datetime.strptime(h[:8], "%Y%m%d").date() for h in hours if h.isdigit()})
    rows = archived(spark, out, days)
    if any(not h.isdigit() for h in hours):  # rows without a time have no day's folder
        rows = rows.unionByName(archived(spark, out).where(F.col("year").isNull()))
    RollupStore(spark, out.rollups).replace(rows.drop(sinks.BATCH, *DAY), hours)


def hourly(spark: SparkSession, out: DailyOutputs) -> DataFrame:
    return stored.hourly_metrics(RollupStore(spark, out.rollups))


def daily(spark: SparkSession, out: DailyOutputs) -> DataFrame:
    return stored.daily_metrics(RollupStore(spark, out.rollups))


def _quality_totals(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.sum(c).alias(c) for c in quality.CHECKS],
        F.avg("quality_score").alias("quality_score"),
    )
