"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.storage import staged


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (two columns, of one orderable type);
    ``root`` is the smallest node reachable.

    Each step points nodes at the smallest neighbour known and is written out, so the plan
    stays short and a lost executor costs one step. A node's smallest neighbour is an
    aggregate (combined before the shuffle), never a gathered list, so a hub with a third
    of all links is no larger than any other row; the joins that hand it back are plain
    sort-merge joins that adaptive execution splits. Rows that hold a null or link a node
    with itself count as no link. The number of steps grows with the logarithm of the
    longest chain. No links give no rows.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = staged(edges, "links")
    while not _stars(edges):
        edges = staged(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether each node either points at one root or is a root."""
    roles = edges.select(F.col("u").alias("n"), F.lit(1).alias("leaf")).union(
        edges.select(F.col("v"), F.lit(0)).distinct()
    )
    counts = roles.groupBy("n").agg(F.sum("leaf").alias("leaves"), F.count(F.lit(1)).alias("all"))
    return counts.where((F.col("leaves") >= 1) & (F.col("all") > 1)).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour, itself included."""
    both = edges.select(F.col("v").alias("n"), F.col("v").alias("m")).union(edges.select("u", "v"))
    lowest = both.groupBy("n").agg(F.min("m").alias("low"))
    moved = edges.join(lowest, edges.v == lowest.n).select("u", F.col("low").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    lowest = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("low"))
    moved = edges.join(lowest, edges.u == lowest.n).where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(lowest.select("n", "low")).distinct()
