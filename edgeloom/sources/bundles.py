"""Uploaded bundles: a file body that is a JSON list of objects, or log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bundles(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Bundle bodies (path, length, body) of any size. Log lines come line by line, however long their
    file; only a JSON list, which cannot be recognised from a part of it, is one row. Which
    files are lists is read from their first characters, and joined on the path."""
    info = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")]
    lines = spark.read.text(paths).select(*info, F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("body"))
    heads = lines.filter((F.col("at") == 0) & (F.trim("body") != "")).select("path", F.substring(F.ltrim("body"), 1, 1).alias("c"), "place")
    lists = heads.groupBy("path").agg(F.min_by("c", "place").alias("first")).filter(F.col("first") == "[").select("path")
    in_order = F.array_sort(F.collect_list(F.struct("at", "place", "body")))
    whole = lines.join(lists, "path", "left_semi").groupBy("path", "length").agg(F.array_join(F.transform(in_order, lambda x: x["body"]), "\n").alias("body"))
    return lines.join(lists, "path", "left_anti").select("path", "length", "body").unionByName(whole)


def parse_bundles(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per log of each bundle: ``log`` and its ``format`` (json or text).

    ``from_json`` as a list of strings keeps every element's own JSON text; it is NULL for
    a body that is no list, which is then cut into lines. Blank lines are dropped.
    """
    # A scalar or an object is not a list, although the JSON reader would wrap it in one.
    is_list = F.col(body).rlike(r"^\s*\[")
    elements = F.when(is_list, F.from_json(body, "array<string>"))
    elements = F.when(F.exists(elements, lambda e: e.isNotNull()) | (F.size(elements) == 0), elements)
    lines = F.filter(F.transform(F.split(F.col(body), "\n"), lambda line: F.trim(line)), lambda line: line != "")
    others = [c for c in bodies.columns if c != body]
    return bodies.select(
        *others,
        F.explode(F.coalesce(elements, lines)).alias("log"),
        F.when(elements.isNotNull(), "json").otherwise("text").alias("format"),
    )
