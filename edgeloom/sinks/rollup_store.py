"""Roll-ups stored by hour and kept up batch by batch.

The store holds partials whose measures all merge exactly: sums at the grain of whole milliseconds, from which
counts, averages and exact percentiles follow, visitors as rows, and HLL sketches where only a
window's number of addresses is asked for. A batch is written as a new part. An hour may lie in up to ``parts_per_hour`` parts, whose
partials readers add up; a batch that finds an hour in so many makes one part of them, aggregated together in one shuffle. No other hour is read. Which parts hold which hour is in one version file for all tables together (see
``versions``), with the batches that are in: a reader sees a batch in all roll-ups or in none, and a batch that comes again counts once.

A part is what one write made of a table: a folder per month, with files in order of hours, as many as the rows need. The number
of files grows with the rows, not with the hours. A part may still have rows of hours that a later part has taken over; readers leave them out.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions.classify import browser_class, device_class
from edgeloom.functions.exprs import TS
from edgeloom.operators.enrich import enrich
from edgeloom.sinks.versions import Conflict, VersionLog

HOUR = "hour"
FOLDER, MONTH, PART, SPREAD, REST = "hour_id", "month_id", "part_id", "_spread", "_rest"
NO_HOUR = "none"
SKETCH_LOG2 = 12
ROWS_PER_TASK = 250_000
Content = dict


@dataclass(frozen=True)
class Partial:
    """One stored table: a row per hour and ``keys``, with sums of the expressions ``sums`` and sketches of the columns ``sketches``.
    Where the keys are ``few``, requests are added up before they are shuffled, as for sketches; else that would hardly make them fewer."""

    keys: tuple[str, ...]
    sums: dict[str, str] = field(default_factory=dict)
    sketches: dict[str, str] = field(default_factory=dict)
    rows: str = "true"
    few: bool = False

    def of(self, rows: DataFrame) -> DataFrame:
        sums = [F.expr(f"sum({e})").alias(n) for n, e in self.sums.items()]
        sketches = [F.hll_sketch_agg(c, F.lit(SKETCH_LOG2)).alias(n) for n, c in self.sketches.items()]
        return rows.where(self.rows).groupBy(HOUR, *self.keys).agg(*sums, *sketches)

    def added(self, rows: DataFrame) -> DataFrame:
        """What ``rows`` add to the table, for ``merged``: partials, or a row per request in their shape."""
        partials = self.of(rows)
        if self.few or self.sketches:
            return partials
        values = [F.expr(e).cast(partials.schema[n].dataType).alias(n) for n, e in self.sums.items()]
        return rows.where(self.rows).select(HOUR, *self.keys, *values)

    def reads(self, column: str) -> bool:
        """Whether the table may use a column of the log: its name is somewhere in the keys or expressions."""
        texts = [*self.keys, *self.sums.values(), *self.sketches.values(), self.rows]
        return any(column.lower() in text.lower() for text in texts)

    def merged(self, rows: DataFrame, *by: str) -> DataFrame:
        """One row per key; ``by`` are columns that follow from the key."""
        sums = [F.sum(n).cast(rows.schema[n].dataType).alias(n) for n in self.sums]
        sketches = [F.hll_union_agg(n).alias(n) for n in self.sketches]
        return rows.groupBy(HOUR, *by, *self.keys).agg(*sums, *sketches).drop(*by)


ONE = {"request_count": "1"}
TABLES = {
    "hourly": Partial(
        ("country", "status_code", "cache_status", "response_time_ms"),
        ONE | {"total_bytes": "bytes", "error_count": "is_error", "cache_hits": "is_cache_hit", "ttfb_sum": "ttfb_ms", "ttfb_count": "if(ttfb_ms IS NULL, 0, 1)"},
    ),
    "paths": Partial(("req_path", "response_time_ms"), ONE | {"cache_hits": "is_cache_hit"}),
    "clients": Partial(("device_type", "browser"), ONE, few=True),
    "visitors": Partial(("date", "cli_ip"), ONE | {"total_bytes": "bytes", "cache_hits": "is_cache_hit"}),
    "endpoints": Partial(("window_start", "req_path", "req_method", "response_time_ms"), ONE | {"error_count": "is_error"}),
    "statuses": Partial(("window_start", "status_code", "response_time_ms"), ONE | {"error_count": "is_error"}),
    "status_visitors": Partial(("window_start", "status_code"), sketches={"ip_sketch": "cli_ip"}),
    "errors": Partial((TS, "req_id", "cli_ip", "country", "req_path", "status_code", "security_rules"), ONE, rows="is_error = 1"),
}


def half_minute(ts: str = TS) -> Column:
    """Start of the 30 seconds that hold a zone-free time."""
    t = F.col(ts)
    halves = F.hour(t) * 120 + F.minute(t) * 2 + F.when(F.second(t) < 30, 0).otherwise(1)
    return F.to_date(t).cast("timestamp_ntz") + halves * F.expr("INTERVAL '30' SECOND")  # no decimals: far quicker


def prepared(logs: DataFrame) -> DataFrame:
    rows = enrich(logs)
    return rows.withColumns({"device_type": device_class(), "browser": browser_class(), "window_start": half_minute()})


def folder_of(hour: str = HOUR) -> Column:
    """Name of an hour, from its wall clock."""
    t = F.col(hour)
    year, month, day, clock = F.year(t), F.month(t), F.dayofmonth(t), F.hour(t)
    number = year.cast("long") * 1000000 + month * 10000 + day * 100 + clock  # far quicker than a format
    dated = F.when(year.between(1000, 9999), number.cast("string")).otherwise(F.format_string("%04d%02d%02d%02d", year, month, day, clock))
    return F.when(t.isNull(), NO_HOUR).otherwise(dated)


def with_batch(ranges: list[list[int]], batch: int) -> list[list[int]]:
    """Batch numbers as ranges, ``batch`` among them: as long as batches come without gaps, that is one."""
    out: list[list[int]] = []
    for low, high in sorted([*ranges, [batch, batch]]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def month_of(hour: str) -> str:
    """Folder of an hour's month, from the hour's name."""
    return hour if hour == NO_HOUR else hour[:-4]


def parts_of(now: Content, name: str) -> list[str]:
    """The parts behind what an hour is mapped to: a part, or the name of several."""
    return now.get("sets", {}).get(name, [name])


def hours_in(now: Content, hours: dict[str, str]) -> Counter:
    """Of each part the number of ``hours`` that it holds."""
    out: Counter = Counter()
    for held, n in Counter(hours.values()).items():
        out.update(dict.fromkeys(parts_of(now, held), n))
    return out


def whole_parts(now: Content, hours: dict[str, str], written: dict[str, int]) -> set[str]:
    """Parts of which every hour that was written is among ``hours``."""
    return {part for part, n in hours_in(now, hours).items() if n == written[part]}


class RollupStore:
    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Partial] = TABLES, files_per_hour: int = 4, threads: int = 4, parts_per_hour: int = 1) -> None:
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        self.files_per_hour, self.threads, self.parts_per_hour = files_per_hour, threads, parts_per_hour
        self.log = VersionLog(spark, f"{self.path}/versions")

    # -- writing

    def merge(self, logs: DataFrame, batch_id: int) -> int:
        """Add the requests of one batch, whatever hours they are of and in whatever order batches come. Returns the version that
        holds the batch. The batch is read and prepared once for all tables."""
        number, now = self._newest()
        if self._has(now, batch_id):
            return number
        with self._held_once(prepared(logs)) as (rows, of_batch):
            return self._merge(rows, of_batch, batch_id)

    def _merge(self, rows: DataFrame, of_batch: dict[str, set[str]], batch_id: int) -> int:
        merged_with, part, schemas = None, "", {}
        while True:
            number, now = self._newest()
            if self._has(now, batch_id):
                return number
            hours = {name: now.get("hours", {}).get(name, {}) for name in self.tables}
            limit = {name: {p for p in set(hours[name].values()) if len(parts_of(now, p)) >= self.parts_per_hour} for name in self.tables}
            full = {name: {h: hours[name][h] for h in of_batch[name] if hours[name].get(h) in limit[name]} for name in self.tables}
            held = {name: {h: parts_of(now, held) for h, held in full[name].items()} for name in self.tables}
            if held != merged_with:
                frames = {name: self._frame(name, table, rows, now, full[name]) for name, table in self.tables.items()}
                part, schemas = self._write_all(frames)
                merged_with = held
            sets, out = dict(now.get("sets", {})), {}
            for name in self.tables:
                joined = {held: self._named(sets, [*parts_of(now, held), part]) for held in sorted(set(hours[name].values()))}
                out[name] = hours[name] | {h: part if h in full[name] or h not in hours[name] else joined[hours[name][h]] for h in of_batch[name]}
            change = self._state(now | {"sets": sets}, out, part, of_batch) | {"schemas": schemas}
            try:
                return self.log.commit(number + 1, now | change | {"batches": with_batch(now.get("batches", []), batch_id)})
            except Conflict:  # another batch was first: its hours may be among ours
                continue

    @staticmethod
    def _named(sets: dict[str, list[str]], parts: list[str]) -> str:
        """One name for several parts, so that the hours' entries stay short."""
        name = next((name for name, known in sets.items() if known == parts), uuid.uuid4().hex[:16])
        sets[name] = parts
        return name

    def _frame(self, name: str, table: Partial, rows: DataFrame, now: Content, held: dict[str, str]) -> DataFrame:
        """One row per key of the batch and the hours ``held``, where rows of a key meet in the range of their hour: no aggregate needs a shuffle of its own."""
        if not held and self.files_per_hour == 1:
            return table.of(rows)  # the batch is dealt by hours already
        rows = self._with_held(name, table.added(rows), now, held)
        if self.files_per_hour == 1:
            return table.merged(rows.repartitionByRange(HOUR))
        spread = F.pmod(F.xxhash64(*table.keys), F.lit(self.files_per_hour))
        return table.merged(rows.withColumn(SPREAD, spread).repartitionByRange(HOUR, SPREAD), SPREAD)

    def _with_held(self, name: str, new: DataFrame, now: Content, held: dict[str, str]) -> DataFrame:
        return new.unionByName(self._read(name, held, now, held)) if held else new

    def replace(self, logs: DataFrame, hours: Iterable[str]) -> int:
        """Make the ``hours`` (by name) again from ``logs``, which must hold all their requests; an hour without any goes. The way
        to take in files that replace others. Other hours stay as they are, also those that others write meanwhile."""
        wanted = sorted(set(hours))
        rows = prepared(logs)
        rows = rows.where(folder_of().isin(wanted)) if wanted else rows.limit(0)
        with self._held_once(rows) as (rows, mine):
            part, schemas = self._write_all({name: self._frame(name, table, rows, {}, {}) for name, table in self.tables.items()})

        def change(now: Content) -> Content:
            out, gone = {}, set(wanted)
            for name in self.tables:
                kept = {h: p for h, p in self._known(now).get("hours", {}).get(name, {}).items() if h not in gone}
                out[name] = kept | dict.fromkeys(mine[name], part)
            return now | self._state(now, out, part, mine) | {"schemas": schemas}

        return self.log.update(change)

    @contextmanager
    def _held_once(self, rows: DataFrame) -> Iterator[tuple[DataFrame, dict[str, set[str]]]]:
        """Prepared rows with the columns that the tables use, and of each table its hours. Spark keeps the rows (memory, then disk) until all tables are
        written: the log is read, times and classes are worked out, and rows are dealt by their hours, once instead of once per table and sample.
        All columns but the hour are kept as one, a row's bytes as they are: to encode each column apart took longer than the rest of the preparation."""
        used = [c for c in rows.columns if c != HOUR and any(t.reads(c) for t in self.tables.values())]
        read = rows.select(HOUR, F.struct(*used).alias(REST)).persist()
        dealt = read
        try:
            hours, requests = self._hours_of(read.select(HOUR, f"{REST}.*") if used else read)
            if self.files_per_hour == 1:
                tasks = max(self.spark.sparkContext.defaultParallelism, requests // ROWS_PER_TASK + 1)
                dealt = read.repartitionByRange(tasks, HOUR).persist()
                dealt.count()
                read.unpersist()
            yield dealt.select(HOUR, f"{REST}.*") if used else dealt, hours
        finally:
            dealt.unpersist()
            read.unpersist()

    def _hours_of(self, rows: DataFrame) -> tuple[dict[str, set[str]], int]:
        """Of each table the names of the hours to which ``rows`` add something, and the number of rows, all in one pass."""
        used = [F.bool_or(F.expr(table.rows)).alias(f"_{i}") for i, table in enumerate(self.tables.values())]
        found = rows.groupBy(HOUR).agg(F.count("*").alias("_n"), *used).select(folder_of(), "_n", *[f"_{i}" for i in range(len(used))]).collect()
        return {name: {r[0] for r in found if r[i + 2]} for i, name in enumerate(self.tables)}, sum(r[1] for r in found)

    def _newest(self) -> tuple[int, Content]:
        number, now = self.log.newest()
        return number, self._known(now)

    def _known(self, now: Content) -> Content:
        if "hours" in now and "written" not in now:
            raise ValueError(f"{self.path} has a folder per hour, as older stores had: build it again")
        return now

    @staticmethod
    def _has(now: Content, batch_id: int) -> bool:
        return any(low <= batch_id <= high for low, high in now.get("batches", []))

    @staticmethod
    def _state(now: Content, hours: dict[str, dict[str, str]], part: str, mine: dict[str, set[str]]) -> Content:
        """``hours``, the names of several parts in them, and of each table the number of hours that were written to each part."""
        sets = {held: parts_of(now, held) for by_hour in hours.values() for held in set(by_hour.values()) if held in now.get("sets", {})}
        sizes = {name: now.get("written", {}).get(name, {}) | {part: len(mine[name])} for name in hours}
        written = {name: {p: sizes[name][p] for p in sorted(hours_in(now, by_hour))} for name, by_hour in hours.items()}
        return {"hours": hours, "sets": sets, "written": written}

    def _write_all(self, frames: dict[str, DataFrame]) -> tuple[str, dict[str, str]]:
        """All tables' rows as one part, the tables side by side. Returns its name, and the schema of each table."""
        part = uuid.uuid4().hex[:16]
        with ThreadPoolExecutor(self.threads) as pool:
            return part, dict(zip(frames, pool.map(lambda item: self._write(*item, part), frames.items())))

    def _write(self, name: str, rows: DataFrame, part: str) -> str:
        """One row per key in order of hours; those of one hour go to up to ``files_per_hour`` files, which other hours share."""
        month = F.when(F.col(FOLDER) == NO_HOUR, NO_HOUR).otherwise(F.expr(f"left({FOLDER}, length({FOLDER}) - 4)"))
        named = rows.withColumn(FOLDER, folder_of()).withColumns({PART: F.lit(part), MONTH: month})
        named.sortWithinPartitions(MONTH, HOUR, *self.tables[name].keys).write.partitionBy(MONTH).parquet(f"{self.path}/data/{part}/{name}")
        return rows.schema.toDDL()

    # -- reading

    def _read(self, name: str, hours: dict[str, str], now: Content, among: dict[str, str]) -> DataFrame:
        """The rows of ``hours`` in the parts that hold them, a row per key and part. ``hours`` are all of ``among`` between their first and last."""
        if not hours:
            return self.spark.createDataFrame([], now["schemas"][name])
        columns, whole = f"{now['schemas'][name]}, {FOLDER} STRING, {PART} STRING", whole_parts(now, among, now["written"][name])
        out = []
        for full in (True, False):
            some = [(h, p) for h, held in hours.items() for p in parts_of(now, held) if (p in whole) == full]
            if some:
                paths = sorted({f"{self.path}/data/{part}/{name}/{MONTH}={month_of(h)}" for h, part in some})
                rows = self.spark.read.schema(columns).parquet(*paths).where(F.col(FOLDER).between(min(some)[0], max(some)[0]))
                if not full:
                    pairs = self.spark.createDataFrame(some, f"{FOLDER} STRING, {PART} STRING")
                    rows = rows.join(F.broadcast(pairs), [FOLDER, PART], "left_semi")
                out.append(rows.drop(FOLDER, PART))
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    def rows(self, name: str, first: str | None = None, last: str | None = None, version: int | None = None) -> DataFrame:
        """A table's partials in the hours from ``first`` to ``last`` (names, both included), one row per key: only the folders of their months are opened."""
        now = self._known(self.log.newest()[1] if version is None else self.log.read(version))
        if "schemas" not in now:
            raise ValueError(f"nothing is stored in {self.path} yet")
        hours = now["hours"][name]
        dated = first is not None or last is not None
        inside = {h: p for h, p in hours.items() if not (dated and h == NO_HOUR) and (first is None or h >= first) and (last is None or h <= last)}
        rows = self._read(name, inside, now, hours)
        several = any(len(parts_of(now, held)) > 1 for held in set(inside.values()))
        return self.tables[name].merged(rows) if several else rows

    def hours(self) -> list[str]:
        """Names of the hours that the store holds."""
        return sorted({h for held in self.log.newest()[1].get("hours", {}).values() for h in held})

    # -- upkeep

    @staticmethod
    def _parts(now: Content) -> set[str]:
        return {p for hours in now.get("hours", {}).values() for held in set(hours.values()) for p in parts_of(now, held)}

    def vacuum(self, keep_versions: int = 2) -> int:
        """Delete folders that none of the newest versions names, while no batch is being merged. Returns their number."""
        self.log.forget(keep_versions)
        named = {p for n in self.log.numbers() for p in self._parts(self.log.read(n))}
        gone = [p for p in self.log.folders(f"{self.path}/data") if p not in named]
        for part in gone:
            self.log.delete_folder(f"{self.path}/data/{part}")
        return len(gone)
