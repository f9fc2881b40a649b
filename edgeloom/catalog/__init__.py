"""Named queries: each takes the table set of a directory and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.context import LogTables

Query = Callable[[LogTables], DataFrame]

SECTIONS = [
    "tables",
    "analytics",
    "dashboards",
    "relational",
    "observability",
    "ingest",
    "streams",
    "stored",
    "loads",
]


def registered() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for section in SECTIONS:
        entries = import_module(f"edgeloom.catalog.{section}").QUERIES
        clash = out.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(entries)
    return out


def presentable(df: DataFrame) -> DataFrame:
    """Result form shared with the checks: zone-free timestamps, six decimals."""
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.round(col.cast("double"), 6)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def runnable(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str, as_of=None) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return presentable(query(LogTables(spark, directory, as_of)))

    run.__name__ = getattr(query, "__name__", "query")
    return run
