"""Aggregation of heavily skewed keys in two stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_totals(
    df: DataFrame, keys: list[str], salt_on: str, sums: dict[str, Column], salts: int = 32
) -> DataFrame:
    """Sum per key through ``(key, salt)`` first, so a hot key is spread over ``salts``
    tasks. The salt is a hash of a row id: a retried task routes each row as before.

    Plain sums already shrink before the shuffle; use this where the measures or the
    rows per map task are too wide for that to help.
    """
    salt = F.pmod(F.xxhash64(salt_on), F.lit(salts)).alias("_salt")
    first = df.groupBy(*keys, salt).agg(*[F.sum(col).alias(name) for name, col in sums.items()])
    return first.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])


HOT_SHARE = 1000


def join_split_hot(rows: DataFrame, side: DataFrame, keys: list[str], spread_by: str, salts: int = 32) -> DataFrame:
    """Left join of raw rows to one row per key, with hot keys spread over ``salts`` tasks.

    Hot are keys with over a thousandth of the rows: under a thousand of them, whatever the
    table, so their list may be broadcast. Only their rows get a salt and only their side rows are repeated.
    Counting the keys combines before its shuffle and reads the key columns alone.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counts.filter(F.col("_n") > total / HOT_SHARE).select(*keys, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(*(F.lit(i).cast("long") for i in (0, salts - 1)))).otherwise(F.array(F.lit(0).cast("long")))
    left = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_hot")
    right = side.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")
