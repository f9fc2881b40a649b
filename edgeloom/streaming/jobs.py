"""Running streams: sinks that take a micro-batch, the runner, and what it reports."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from edgeloom.functions import weblog
from edgeloom.sinks import tables
from edgeloom.sinks.keyed import KeyedTable, SeenKeys
from edgeloom.sinks.rollup_store import RollupStore
from edgeloom.streaming.windows import above_baseline

Sink = Callable[[DataFrame, int], None]


def batch_sink(path: str) -> Sink:
    """Each micro-batch owns a folder of ``path``: a batch that runs twice, after a failure or a
    restart, replaces what it wrote before."""
    return lambda rows, batch_id: tables.write_batch(rows, batch_id, path)


def each(*sinks: Sink) -> Sink:
    """Several sinks for one micro-batch, which is computed once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()

    return write


def dual_sink(metrics: Callable[[DataFrame], DataFrame], metrics_path: str, archive_path: str) -> Sink:
    """A micro-batch goes to the archive, and its roll-up to the metrics store."""
    roll_up: Sink = lambda rows, batch_id: tables.write_batch(metrics(rows), batch_id, metrics_path)
    return each(roll_up, batch_sink(archive_path))


def rollup_sink(store: RollupStore) -> Sink:
    """A micro-batch of requests goes into the hours that it is about, also into hours long past: files that come
    late, or in any order, end in the same roll-ups. A batch that runs again counts once."""
    return lambda rows, batch_id: store.merge(rows, batch_id)


def keyed_sink(table: KeyedTable) -> Sink:
    """A micro-batch takes the place of older rows with its keys."""
    return lambda rows, batch_id: table.upsert(rows, batch_id)


def baseline_sink(baseline: Callable[[], DataFrame], keys: list[str], sink: Sink, value: str = "request_count", factor: float = 10.0) -> Sink:
    """``sink`` for windows far above the baseline. It is read anew for each micro-batch: once a later
    job has renewed it, the next micro-batch is held against the new one, and a batch sees one version whole."""
    return lambda rows, batch_id: sink(above_baseline(rows, baseline(), keys, value, factor), batch_id)


def insert_ignore_sink(seen: SeenKeys, order: list[str], sink: Sink) -> Sink:
    """``sink`` for rows whose key was not loaded before. Keys are noted after the rows are written: a
    batch that is lost between the two writes the same rows again."""

    def write(rows: DataFrame, batch_id: int) -> None:
        new = seen.unseen(rows, batch_id, order)
        sink(new, batch_id)
        seen.record(new, batch_id)

    return write


def version_sink(base: str, line: str = "value") -> Sink:
    """Lines are parsed and filed by schema version; unparsed ones go to ``rejected``."""

    def write(lines: DataFrame, batch_id: int) -> None:
        parsed, rejected = weblog.parse_access_log(lines, line)
        tables.write_versions(parsed, batch_id, base)
        tables.write_batch(rejected, batch_id, f"{base}/rejected")

    return write


def filtered_sink(rows_of: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    """``sink`` for what ``rows_of`` makes of a micro-batch, such as alerts."""
    return lambda rows, batch_id: sink(rows_of(rows), batch_id)


def start(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "update", every: str | None = None) -> StreamingQuery:
    """Start a stream. ``checkpoint`` holds offsets and state: the same folder goes on where the
    last run stopped. Without ``every`` it ends once it has read what is there."""
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start() if every else writer.trigger(availableNow=True).start()


def run(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "update") -> StreamingQuery:
    query = start(stream, sink, checkpoint, mode)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them and were dropped, in the batches that Spark still reports
    (the newest hundred, by default). ``LateRows`` adds up all."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


class LateRows(StreamingQueryListener):
    """Adds up the rows that the watermark dropped, batch by batch, for queries of any length. Register it with
    ``spark.streams.addListener`` before the query starts."""

    def __init__(self) -> None:
        self._dropped: dict[str, dict[int, int]] = {}
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        self._dropped.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        dropped = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self._dropped.setdefault(str(event.progress.id), {})[event.progress.batchId] = dropped

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait: float = 30.0) -> int:
        """Rows dropped so far over all runs of the query that this listener saw; of a run that ended, all its batches."""
        if not query.isActive:
            self._ended[str(query.runId)].wait(wait)
        return sum(self._dropped.get(str(query.id), {}).values())
