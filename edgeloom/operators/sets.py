"""Unions of files, schema versions and per-source counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_files(parts: list[DataFrame]) -> DataFrame:
    """Bag union by column name. For plain files prefer one reader over all paths."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_versions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Both generations in one table: V1 rows get NULLs for the V2 columns."""
    return v1.withColumn("schema_version", F.lit(1)).unionByName(
        v2.withColumn("schema_version", F.lit(2)), allowMissingColumns=True
    )


def backfill(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """V1 rows in the V2 layout, ready to append."""
    have = set(v1.columns)
    return v1.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in v2.schema.fields
        ]
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, count) row per table."""
    return union_files(
        [df.agg(F.count(F.lit(1)).alias("count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    )
