"""Ageing of rows: purge, archive, tiers, anonymisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions.classify import age_tier
from edgeloom.functions.exprs import TS, instant, span
from edgeloom.sinks.tables import replace_partitions

# --- fixed values: retention in days ---------------------------------------------------
RAW_LOG_DAYS = 7
SUMMARY_DAYS = 90
ANONYMOUS = "ANONYMIZED"
# --------------------------------------------------------------------------------------


def tier_split(df: DataFrame, as_of, days: int = SUMMARY_DAYS, ts: str = TS) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to archive). A NULL time is kept: its age is unknown."""
    cutoff = instant(as_of) - span(f"{days} days")
    old = F.col(ts) < cutoff
    return df.filter(F.coalesce(~old, F.lit(True))), df.filter(old)


def with_tier(df: DataFrame, as_of, ts: str = TS) -> DataFrame:
    age = F.datediff(instant(as_of), F.col(ts))
    return df.withColumns({"age_days": age, "tier": age_tier(age)})


def anonymize_older_than(logs: DataFrame, as_of, days: int = RAW_LOG_DAYS) -> DataFrame:
    """Mask the address and drop cookie and forwarding header of rows past ``days``."""
    old = F.col(TS) < instant(as_of) - span(f"{days} days")
    return logs.withColumns(
        {
            "cli_ip": F.when(old, F.lit(ANONYMOUS)).otherwise(F.col("cli_ip")),
            "cookie": F.when(~old, F.col("cookie")),
            "x_forwarded_for": F.when(~old, F.col("x_forwarded_for")),
        }
    )


def archive_old_partitions(spark: SparkSession, table: str, archive: str, as_of, day: str, days: int = SUMMARY_DAYS) -> int:
    """Move partitions older than ``days`` of a table partitioned by the date column ``day``:
    each is written to ``archive`` (replacing an earlier try), counted there, and only then dropped.
    Returns the number of partitions moved. A run that stops half-way can be repeated."""
    old, _ = old_and_young(spark, table, as_of, day, days)
    if not old:
        return 0
    rows = spark.table(table).filter(F.col(day).isin(old))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(archive)
    kept = spark.read.parquet(archive).filter(F.col(day).isin(old)).count()
    if kept != rows.count():
        raise RuntimeError(f"{archive} holds {kept} rows of the partitions to drop: nothing was dropped")
    for value in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = DATE '{value}')")
    return len(old)


def anonymize_old_partitions(spark: SparkSession, path: str, work: str, as_of, day: str, days: int = RAW_LOG_DAYS) -> None:
    """Rewrite partitions of the table at ``path`` that hold rows older than ``days``, masked.
    They are written to ``work`` first, because a folder cannot be read while it is replaced."""
    cutoff = F.to_date(instant(as_of) - span(f"{days} days"))
    old = spark.read.parquet(path).filter((F.col(day) <= cutoff) & (F.col("cli_ip") != ANONYMOUS))
    touched = [r[0] for r in old.select(day).distinct().collect()]  # one value per day
    if touched:
        rows = spark.read.parquet(path).filter(F.col(day).isin(touched))
        anonymize_older_than(rows, as_of, days).write.mode("overwrite").parquet(work)
        replace_partitions(spark.read.parquet(work), path, [day])


def old_and_young(spark: SparkSession, table: str, as_of, day: str, days: int) -> tuple[list, list]:
    """Partition dates past the limit, and the others, from the catalogue alone."""
    names = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    dates = spark.createDataFrame([(n,) for n in names], "n string").select(F.to_date("n").alias("d"), (F.to_date("n") < F.to_date(instant(as_of) - span(f"{days} days"))).alias("old"))
    rows = dates.collect()
    return [r.d for r in rows if r.old], [r.d for r in rows if not r.old]
