"""Stored roll-ups: any order of batches and files, repeats, lost writers, replaced hours."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from edgeloom.context import LogTables
from edgeloom.operators import rollups
from edgeloom.plans import stored
from edgeloom.sinks.rollup_store import TABLES, RollupStore, folder_of, prepared, with_batch
from edgeloom.sinks.versions import Conflict
from edgeloom.streaming import jobs

NAMES = ("hourly", "statuses", "status_visitors", "errors")
FEW = {name: TABLES[name] for name in NAMES}


@pytest.fixture(scope="module")
def logs(spark, small):
    """A few days of the log, some of it without a time, an address or a response time."""
    rows = LogTables(spark, small).logs
    first = rows.agg(F.min("request_timestamp")).first()[0]
    rows = rows.where(F.col("request_timestamp") < F.lit(first + dt.timedelta(days=3)))
    odd = rows.limit(5).withColumns({"request_timestamp": F.lit(None).cast("timestamp_ntz"), "cli_ip": F.lit(None).cast("string")})
    return rows.unionByName(odd).persist()


def all_of(store, tables=FEW):
    """Every stored row, sketches as their estimates."""
    out = {}
    for name, table in tables.items():
        rows = store.rows(name)
        for sketch in table.sketches:
            rows = rows.withColumn(sketch, F.hll_sketch_estimate(sketch))
        out[name] = sorted(map(str, rows.collect()))
    return out


@pytest.fixture(scope="module")
def one_pass(spark, logs, tmp_path_factory):
    store = RollupStore(spark, str(tmp_path_factory.mktemp("one")), FEW)
    store.merge(logs, 0)
    return all_of(store)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0, 1, 1), (1, 0, 2, 0)])
def test_batches_in_any_order_equal_one_pass(spark, logs, one_pass, tmp_path, order):
    store = RollupStore(spark, str(tmp_path), FEW, files_per_hour=1 + order[0])
    for b in order:
        store.merge(logs.where(F.coalesce(F.col("req_id"), F.lit(0)) % 3 == b), b)
    assert all_of(store) == one_pass
    assert store.log.newest()[1]["batches"] == [[0, 2]] and len(store.log.numbers()) == 3


def test_a_batch_touches_its_hours_only(spark, logs, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"hourly": TABLES["hourly"]})
    store.merge(logs, 0)
    before = store.log.newest()[1]["hours"]["hourly"]
    hour = sorted(before)[3]
    late = prepared(logs).where(folder_of() == hour).select(logs.columns).limit(3)
    store.merge(late, 1)
    after = store.log.newest()[1]["hours"]["hourly"]
    assert {h for h in after if after[h] != before.get(h)} == {hour}
    total = store.rows("hourly", hour, hour).agg(F.sum("request_count")).first()[0]
    assert total == prepared(logs).where(folder_of() == hour).count() + late.count()
    plan = store.rows("hourly", hour, hour)._jdf.queryExecution().executedPlan().toString()
    assert "1 paths" in plan and store.hours()[-1] == "none"


def test_a_lost_writer_leaves_the_version_whole(spark, logs, one_pass, tmp_path, monkeypatch):
    store = RollupStore(spark, str(tmp_path), FEW)
    parts = [logs.where(F.col("req_id") % 2 == b) for b in (0, 1)]
    store.merge(parts[0], 0)
    before, reader = all_of(store), store.rows("hourly")
    monkeypatch.setattr(store.log, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.merge(parts[1], 1)
    monkeypatch.undo()
    assert all_of(store) == before
    store.merge(parts[1], 1)
    assert all_of(store) == one_pass and sorted(map(str, reader.collect())) == before["hourly"]
    assert store.vacuum(keep_versions=1) > 0 and all_of(store) == one_pass


def test_two_writers(spark, logs, one_pass, tmp_path, monkeypatch):
    """Another batch, with the same hours, is committed just before ours."""
    ours, other = (RollupStore(spark, str(tmp_path), FEW) for _ in range(2))
    commit, calls = ours.log.commit, []

    def late(number, content):
        if not calls:
            calls.append(number)
            other.merge(logs.where(F.col("req_id") % 2 == 1), 1)
        return commit(number, content)

    monkeypatch.setattr(ours.log, "commit", late)
    ours.merge(logs.where(F.col("req_id") % 2 == 0), 0)
    assert all_of(ours) == one_pass and calls == [1]
    with pytest.raises(Conflict):
        commit(1, {})


def test_hours_made_again_from_the_archive(spark, logs, one_pass, tmp_path):
    store = RollupStore(spark, str(tmp_path), FEW)
    hours = prepared(logs).select(folder_of().alias("h")).distinct()
    names = sorted(r.h for r in hours.collect())
    store.merge(logs.union(logs), 0)
    store.replace(logs, names)
    assert all_of(store) == one_pass
    gone = names[0]
    store.replace(prepared(logs).where(folder_of() != gone).select(logs.columns), [gone])
    assert gone not in store.hours() and set(store.hours()) == set(names) - {gone}


def test_late_files_as_a_stream(spark, logs, one_pass, tmp_path):
    """Files arrive in a random order of their hours, one per micro-batch, the stream stops and goes on."""
    rows = logs.where("request_timestamp is not null").withColumn("f", F.hour("request_timestamp") % 4)
    for i, f in enumerate(random.Random(3).sample(range(4), 4)):
        rows.where(F.col("f") == f).drop("f").coalesce(1).write.parquet(f"{tmp_path}/files/{i}")
    logs.where("request_timestamp is null").coalesce(1).write.parquet(f"{tmp_path}/files/9")
    store = RollupStore(spark, f"{tmp_path}/store", FEW)
    calls = []
    sink = jobs.rollup_sink(store)

    def failing(batch, batch_id):
        sink(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write, before the commit")

    source = lambda: spark.readStream.schema(logs.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/files")
    with pytest.raises(Exception, match="lost after"):
        jobs.run(source(), failing, f"{tmp_path}/c", mode="append")
    jobs.run(source(), failing, f"{tmp_path}/c", mode="append")
    assert len(calls) == 6 and all_of(store) == one_pass


def test_shapes_equal_the_log_s(spark, logs, tmp_path):
    store = RollupStore(spark, str(tmp_path))
    for b in range(2):
        store.merge(logs.where(F.col("req_id") % 2 == b), b)
    for shape, rollup in ((stored.hourly_metrics, rollups.hourly_metrics), (stored.status_summary, rollups.status_summary), (stored.daily_metrics, rollups.daily_metrics)):
        got = shape(store)
        names = [c for c in got.columns if c not in ("avg_response_time",)]
        want = rollup(logs).select(got.columns)
        if "window_start" in names and rollup is rollups.status_summary:
            got, want = (d.where("window_start is not null") for d in (got, want))
        assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))


def test_batch_numbers_as_ranges():
    out = []
    for b in (5, 3, 4, 9, 0, 9):
        out = with_batch(out, b)
    assert out == [[0, 0], [3, 5], [9, 9]]


def test_an_empty_store_says_so(spark, logs, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"hourly": TABLES["hourly"]})
    with pytest.raises(ValueError, match="nothing is stored"):
        store.rows("hourly")
    store.merge(logs.limit(0), 0)
    assert store.rows("hourly").count() == 0 and store.hours() == []
