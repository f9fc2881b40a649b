"""Idempotent table writes on plain Parquet.

Nothing already written is rewritten in place: a batch owns the folder of its
``batch_id``, a retry replaces that folder only, and readers resolve keys. A writer lost
half-way therefore costs a retry, never earlier rows.
"""

from __future__ import annotations

import datetime as dt
import socket
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions.exprs import TS, day_start, span
from edgeloom.operators.windows import dedup_latest
from edgeloom.sinks.versions import VersionLog

BATCH = "batch_id"


def write_batch(df: DataFrame, batch_id: int, path: str, by: tuple[str, ...] = ()) -> None:
    """Write one micro-batch to the folder of its id, in folders ``by`` column inside; writing it again replaces what the
    folder held, also when the second try has no rows."""
    out = df.drop(BATCH).write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy(*by).parquet(f"{path}/{BATCH}={int(batch_id)}")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Upsert view: of the rows written per key, the one of the newest batch."""
    rows = spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))
    return dedup_latest(rows, keys, BATCH).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: list[str], target: str, batch_id: int) -> None:
    """Write the upsert view as a single batch of a new table."""
    write_batch(read_latest(spark, path, keys), batch_id, target)


def replace_partitions(df: DataFrame, path: str, by: list[str], scope: list[tuple] | None = None) -> None:
    """Replace exactly the partitions present in ``df`` (a re-run of a day, say), and those of ``scope``
    (values of ``by``) that ``df`` has no rows of any more. The source of ``df`` must not be ``path`` itself."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    if scope:
        left = {tuple(map(str, r)) for r in df.select(*by).distinct().collect()}  # one row a partition
        files = VersionLog(df.sparkSession, path)
        for values in scope:
            if tuple(map(str, values)) not in left:
                files.delete_folder("/".join([path, *(f"{name}={value}" for name, value in zip(by, values))]))


def with_day_partitions(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def write_archive(df: DataFrame, path: str, ts: str = TS, files_per_day: int | None = None) -> None:
    """Append to a Snappy Parquet archive partitioned by year/month/day.

    Without shuffling, every task writes to every day it holds. ``files_per_day`` trades a
    shuffle for few large files: rows are spread over (day, hash) so that a heavy day is
    still written by many tasks.
    """
    out = with_day_partitions(df, ts)
    if files_per_day:
        spread = F.pmod(F.xxhash64(ts), F.lit(files_per_day))
        out = out.repartition("year", "month", "day", spread)
    out.write.mode("append").option("compression", "snappy").partitionBy("year", "month", "day").parquet(path)


def write_lookup_archive(
    df: DataFrame, path: str, ts: str = TS, by: str = "cli_ip", ids: tuple[str, ...] = ("req_id",), files_per_day: int = 16,
    row_group_bytes: int = 32 << 20, days: int = 1,
) -> None:
    """Append to an archive laid out for looking up single addresses and requests: inside a day, rows lie in ranges of ``by``, so
    that the bounds of a file or row group tell whether it can hold an address, and Bloom filters on ``by`` and
    ``ids`` rule out most others. ``days`` is how many days ``df`` holds, about."""
    out = with_day_partitions(df, ts).repartitionByRange(files_per_day * days, "year", "month", "day", by, ts)
    writer = out.sortWithinPartitions("year", "month", "day", by, ts).write.mode("append").option("parquet.block.size", row_group_bytes)
    for column in (by, *ids):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy("year", "month", "day").parquet(path)


def write_quarantine(rejected: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Rejected lines with the time of rejection: of a batch that may run again in its own folder, which a retry replaces;
    without a batch they are appended."""
    stamped = rejected.withColumn("rejected_at", F.current_timestamp())
    if batch_id is None:
        stamped.write.mode("append").parquet(path)
    else:
        write_batch(stamped, batch_id, path)


def write_versions(parsed: DataFrame, batch_id: int, base: str) -> None:
    """Route parsed lines by version, and keep the union of all. Lines are parsed once: the
    versions are cut from the written union."""
    write_batch(parsed, batch_id, f"{base}/union")
    spark, extended = parsed.sparkSession, F.col("schema_version") >= 2
    written = spark.read.schema(parsed.schema).parquet(f"{base}/union/{BATCH}={int(batch_id)}")
    write_batch(written.filter(~extended), batch_id, f"{base}/v1")
    write_batch(written.filter(extended), batch_id, f"{base}/v2")


LEDGER = (
    "job_name STRING, run_id STRING, hostname STRING, status STRING, files_processed LONG, rows_processed LONG, "
    "duration_seconds LONG, error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, rows_read LONG, rows_rejected LONG"
)


def ledger_row(
    spark: SparkSession, job_name: str, run_id: str, hostname: str, started_at: dt.datetime,
    completed_at: dt.datetime, files: int, rows: int, error: str | None = None, read: int | None = None, rejected: int | None = None,
) -> DataFrame:
    status = "failed" if error else "success"
    seconds = int((completed_at - started_at).total_seconds())
    row = (job_name, run_id, hostname, status, files, rows, seconds, error, started_at, completed_at, read, rejected)
    return spark.createDataFrame([row], LEDGER)


class Run:
    """One run of a job, with counts that the job's own writing pass makes. ``with Run(...) as run: ...`` writes a row to the
    ledger at the end, also where the job fails; the counts are those of the passes that came through."""

    def __init__(self, spark: SparkSession, ledger: str, job_name: str, run_id: str, files: int = 0) -> None:
        self.spark, self.ledger, self.job_name, self.run_id, self.files = spark, ledger, job_name, run_id, files
        self.counts = {"read": 0, "rejected": 0}
        self._observed: Observation | None = None

    def counting(self, rows: DataFrame, rejected: Column) -> DataFrame:
        """``rows``, counted as they are written: all that pass, and those that ``rejected`` holds for. No scan of its own."""
        self._observed = Observation(f"{self.job_name}-{uuid.uuid4().hex}")
        return rows.observe(self._observed, F.count(F.lit(1)).alias("read"), F.count_if(rejected).alias("rejected"))

    def counted(self) -> None:
        """To be called once the counted rows are written."""
        self.counts = self._observed.get

    def __enter__(self) -> Run:
        self.started = dt.datetime.now(dt.timezone.utc)
        return self

    def __exit__(self, kind, error, trace) -> None:
        read, rejected = self.counts["read"], self.counts["rejected"]
        message = None if error is None else f"{kind.__name__}: {error}"[:1000]
        done = dt.datetime.now(dt.timezone.utc)
        row = ledger_row(self.spark, self.job_name, self.run_id, socket.gethostname(), self.started, done, self.files, read - rejected, message, read, rejected)
        row.coalesce(1).write.mode("append").parquet(self.ledger)


def export_yesterday(rollup: DataFrame, path: str, as_of, ts: str = "window_start") -> None:
    """The day before ``as_of`` as gzip CSV."""
    end = day_start(as_of)
    day = rollup.filter((F.col(ts) >= end - span("1 day")) & (F.col(ts) < end))
    day.write.mode("overwrite").option("compression", "gzip").option("quoteAll", "true").csv(path)


def jdbc_options(url: str, table: str, user: str, password: str, driver: str, batch_rows: int = 1000) -> dict[str, str]:
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "batchsize": str(batch_rows), "rewriteBatchedStatements": "true",
    }


def append_jdbc(df: DataFrame, options: dict[str, str]) -> bool:
    """Append to a database table; False, and no connection, for an empty frame."""
    if df.isEmpty():
        return False
    df.write.format("jdbc").options(**options).mode("append").save()
    return True
