"""Tables that are read by key without a shuffle: rows are bucketed by key when they are written."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.operators.windows import dedup_latest
from edgeloom.sinks.versions import VersionLog

PART, BATCH = "part", "batch_id"


class KeyedTable:
    """An upsert table of ``schema`` (with the ``keys``), in ``buckets`` hash buckets.

    Each batch is one part: a folder of the Spark table at ``path``/data, bucketed and sorted by key. The
    parts that count are named by the newest version (see ``versions``), together with the batch each holds. Writing a batch
    again replaces its part there, also by an empty one; readers see the old part until then. Only the batch is
    shuffled, by its key; windows, aggregates and joins by key find the history in place.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str], buckets: int = 32) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = VersionLog(spark, f"{self.path}/versions")
        self.name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()}"
        self._declare()

    def _declare(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {BATCH} BIGINT, {PART} STRING) USING parquet PARTITIONED BY ({PART}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/data'"
        )

    # -- writing

    def upsert(self, rows: DataFrame, batch_id: int) -> int:
        """Rows of one batch take the place of older ones with their keys. Returns the version that holds them. A batch that has been
        folded into a compacted part is through, and is left as it is."""
        if batch_id <= self.log.newest()[1].get("folded", -1):
            return self.log.newest()[0]
        part = self._write(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), f"b{batch_id}")
        return self.log.update(lambda now: self._with(now, {p: b for p, b in now.get("parts", {}).items() if b != batch_id} | {part: batch_id}))

    def _write(self, rows: DataFrame, label: str) -> str:
        part = f"{label}-{uuid.uuid4().hex[:12]}"
        columns = [f"`{f.name}`" for f in self.schema] + [BATCH]
        out = rows.select(*columns, F.lit(part).alias(PART)).repartition(self.buckets, *self.keys)
        writer = out.write.format("parquet").mode("append").partitionBy(PART).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.saveAsTable(self.name)
        return part

    @staticmethod
    def _with(now: dict, parts: dict[str, int], **more: int) -> dict:
        return now | {"parts": parts} | more

    # -- reading

    def rows(self, version: int | None = None, but_batch: int | None = None) -> DataFrame:
        """All rows of a version (the newest, unless given), older ones of a key included."""
        content = self.log.newest()[1] if version is None else self.log.read(version)
        parts = sorted(p for p, b in content.get("parts", {}).items() if b != but_batch)
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col(PART).isin(parts) if parts else F.lit(False)).drop(PART)

    def read(self, version: int | None = None) -> DataFrame:
        """The upsert view: of each key the row of the newest batch. Its window runs on the buckets as they lie."""
        return dedup_latest(self.rows(version), self.keys, BATCH).drop(BATCH)

    # -- upkeep

    def compact(self, but_newest: int = 1) -> int:
        """Fold all batches but the newest ``but_newest`` (which may still be written again) into one part, by swapping in a version.
        Batches that others add meanwhile stay."""
        _, now = self.log.newest()
        parts = now.get("parts", {})
        batches = sorted({b for b in parts.values() if b >= 0})
        fold = batches[: len(batches) - but_newest]
        if not fold:
            return self.log.newest()[0]
        old = [p for p, b in parts.items() if b < 0 or b in fold]
        rows = self.spark.table(self.name).where(F.col(PART).isin(old)).drop(PART)
        part = self._write(dedup_latest(rows, self.keys, BATCH), "base")

        def swap(latest: dict) -> dict | None:
            kept = latest.get("parts", {})
            if not set(old) <= set(kept):  # one of them was written again: what was folded is out of date
                return None
            return self._with(latest, {p: b for p, b in kept.items() if p not in old} | {part: -1}, folded=fold[-1])

        return self.log.update(swap)

    def vacuum(self, keep_versions: int = 2) -> int:
        """Delete folders that none of the newest versions names; returns their number. Not for use while a batch is being written."""
        self.log.forget(keep_versions)
        named = {p for n in self.log.numbers() for p in self.log.read(n).get("parts", {})}
        gone = [f for f in self.log.folders(f"{self.path}/data") if f.startswith(f"{PART}=") and f.removeprefix(f"{PART}=") not in named]
        for folder in gone:
            self.log.delete_folder(f"{self.path}/data/{folder}")
        return len(gone)


class SeenKeys:
    """Keys that have been loaded, for ``INSERT IGNORE``: a key is let in once, whatever else comes with it."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str, buckets: int = 32) -> None:
        self.keys, self.table = list(keys), KeyedTable(spark, path, schema, keys, buckets)

    def unseen(self, rows: DataFrame, batch_id: int, order: list[str]) -> DataFrame:
        """Rows of the batch whose key no other batch has loaded, of each key the first by ``order``. Only the batch is shuffled.
        The batch's own keys do not count, so a batch that runs again gives the same rows."""
        first = Window.partitionBy(*self.keys).orderBy(*order)
        once = rows.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")
        loaded = self.table.rows(but_batch=batch_id).select(*self.keys)
        return once.repartition(self.table.buckets, *self.keys).join(loaded, self.keys, "left_anti")

    def record(self, rows: DataFrame, batch_id: int) -> int:
        """Note the keys of rows that are loaded."""
        return self.table.upsert(rows.select(*self.keys), batch_id)
