"""Delivery-log files: space-delimited, headerless, gzip, ``-`` for an absent value.

A gzip file cannot be split, so one task reads one file. Land the rows as Parquet
(``sinks.archive``) before querying them repeatedly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.functions.exprs import TS, seconds_of_utc
from edgeloom.sources.schemas import CORRUPT, cdn_schema, with_corrupt_column

# Lines are read as text and parsed by an expression: the malformed line is then an
# ordinary column, and which lines count as malformed does not depend on the query.
READ_OPTIONS = {
    "sep": " ",
    "nullValue": "-",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}
FILE_INFO = ["file_path", "file_size", "file_modification_time"]
MAX_FILE_BYTES = 50 * 1024 * 1024


def scan(spark: SparkSession, paths: list[str] | str, schema: T.StructType | None = None) -> DataFrame:
    """All lines of all files through one reader, malformed ones kept in ``_corrupt_record``."""
    return parse_lines(spark.read.text(paths), schema)


def parse_lines(lines: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The text column ``value`` as the columns of a line; other columns are carried along. A
    generator keeps filters on the columns above it, so each line is parsed once."""
    layout = with_corrupt_column(schema or cdn_schema()).toDDL()
    others = [c for c in lines.columns if c != "value"]
    row = F.explode(F.array(F.from_csv("value", layout, READ_OPTIONS))).alias("_row")
    return lines.select(*others, row).select("_row.*", *others)


def scan_stream(
    spark: SparkSession, directory: str, schema: T.StructType | None = None,
    max_files: int = 10, pattern: str = "*.csv.gz",
) -> DataFrame:
    """New files of a directory, at most ``max_files`` per trigger, with their file facts."""
    lines = (
        spark.readStream.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .text(directory)
        .select("value", *[F.col(f"_metadata.{c}").alias(c) for c in FILE_INFO])
    )
    return parse_lines(lines, schema)


def split_malformed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines). Together they are all input lines."""
    bad = F.col(CORRUPT).isNotNull()
    info = [c for c in FILE_INFO if c in lines.columns]
    return (
        lines.filter(~bad).drop(CORRUPT),
        lines.filter(bad).select(F.col(CORRUPT).alias("line"), *info),
    )


def read_cdn_logs(
    spark: SparkSession, paths: list[str] | str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    return split_malformed(scan(spark, paths, schema))


def oversized(size: str = "file_size", limit: int = MAX_FILE_BYTES) -> Column:
    return F.col(size) > limit


def arrived_late(event_time: str, limit: str = "1 hour", arrived: str = "file_modification_time") -> Column:
    """True for a row whose file arrived more than ``limit`` after the request."""
    return F.col(arrived).cast("timestamp") - F.col(event_time).cast("timestamp") > F.expr(f"INTERVAL {limit}")


def to_cdn_layout(logs: DataFrame) -> DataFrame:
    """Canonical rows in the published layout; fields the log does not carry are NULL."""
    known = {
        "version": F.lit("1"), "cp": F.lit(123456), "reqId": F.col("req_id").cast("string"),
        "reqTimeSec": seconds_of_utc(F.col(TS)), "bytes": F.col("bytes"),
        "cliIP": F.col("cli_ip"), "statusCode": F.col("status_code"), "proto": F.col("proto"),
        "reqHost": F.col("req_host"), "reqMethod": F.col("req_method"), "reqPath": F.col("req_path"),
        "reqPort": F.lit(443), "rspContentType": F.col("rsp_content_type"), "UA": F.col("user_agent"),
        "tlsVersion": F.col("tls_version"), "objSize": F.col("obj_size"), "queryStr": F.col("query_str"),
        "totalBytes": F.col("bytes"), "fileSizeBucket": F.col("file_size_bucket"),
        "downloadInitiated": F.col("download_initiated"), "downloadsCompleted": F.col("downloads_completed"),
        "cookie": F.col("cookie"), "xForwardedFor": F.col("x_forwarded_for"), "maxAgeSec": F.col("max_age_sec"),
        "turnAroundTimeMSec": F.col("turn_around_time_ms").cast("long"),
        "transferTimeMSec": F.col("transfer_time_ms").cast("long"), "errorCode": F.col("error_code"),
        "timeToFirstByte": F.col("ttfb_ms"), "downloadTime": F.col("download_time_ms"),
        "throughput": F.col("throughput_bps"), "cacheStatus": F.col("cache_status"),
        "country": F.col("country"), "city": F.col("city"),
        "securityRules": F.nullif(F.col("security_rules"), F.lit("")),
        "ewExecutionInfo": F.nullif(F.col("ew_execution_info"), F.lit("")),
    }
    return logs.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in cdn_schema().fields]
    )


def to_cdn_line(logs: DataFrame) -> DataFrame:
    """One text line per row, as the files hold it, in column ``line``."""
    wide = to_cdn_layout(logs)
    line = F.to_csv(F.struct(*wide.columns), {"sep": " ", "nullValue": "-"}).alias("line")
    return wide.select("reqId", line)


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write a text column verbatim as ``*.csv.gz`` files."""
    out = lines.select("line") if files is None else lines.select("line").repartition(files)
    out.write.mode("errorifexists").csv(
        path, sep="\u0001", quote="\u0000", escape="\u0000", compression="gzip", emptyValue=""
    )
