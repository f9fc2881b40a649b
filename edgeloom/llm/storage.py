"""Tables that cut lineage, written to the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.workspace import shared_dir

def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (see ``workspace.shared_dir``): an error where a cluster names none."""
    return shared_dir(spark)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: later steps neither recompute it nor depend on an
    executor that may be lost. Values made at writing, such as row numbers, stay fixed."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the time of one job (``__`` in a name stands for a dot)."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def keep_marked(docs: DataFrame, key: Column, marked: DataFrame, order: Column) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in the one-column frame ``marked``, one per key (the
    first by ``order``). One shuffle by key serves the join and the choice."""
    from pyspark.sql import Window

    name = f"key_{uuid.uuid4().hex[:8]}"
    rank = f"rank_{name}"
    kept = docs.withColumn(name, key).join(marked.toDF(name), name, "left_semi")
    first = Window.partitionBy(name).orderBy(order)
    return kept.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(name, rank)


_shipped: set[str] = set()


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would, and
    keep batches of texts small: unless the session has its own setting, 1,000 rows."""
    import shutil
    import tempfile
    from pathlib import Path

    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
