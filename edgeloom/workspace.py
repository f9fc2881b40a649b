"""Scratch space for staged tables, stored roll-ups and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in ``spark.checkpoint.dir``.

    Where that is unset, the warehouse serves if it is on a shared file system, or if
    all of Spark runs on this machine. Else executors would each write to a disk of their own: an error.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE)
    local = spark.sparkContext.master.startswith("local")
    if not local and warehouse.split(":", 1)[0] in ("file", warehouse):
        raise RuntimeError(f"set {SETTING} to a folder that driver and executors share")
    return f"{warehouse.rstrip('/')}/staged"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
