"""Stored roll-ups with hours in several parts: readers add them up, a full hour becomes one part, and a batch is dealt once."""

import json

import pytest
from pyspark.sql import functions as F
from test_rollup_files import FEW, counts, requests
from test_rollup_store import all_of

from edgeloom.sinks.rollup_store import TABLES, Partial, RollupStore, parts_of, prepared
from edgeloom.sinks.versions import VersionLog

SOME = FEW | {name: TABLES[name] for name in ("visitors", "errors")}


def batch(spark, n, hours=60):
    """Each third request of an hour, some of them failed, with a repeated row and requests without a time."""
    rows = requests(spark, hours).withColumn("status_code", F.when(F.col("req_id") % 5 == 0, 500).otherwise(F.col("status_code")))
    return rows.unionByName(rows.limit(1)).where(F.col("req_id") % 3 == n)


def kinds(store, name="hourly"):
    """Numbers of parts in which hours of a table lie."""
    now = store.log.newest()[1]
    return {len(parts_of(now, held)) for held in now["hours"][name].values()}


@pytest.fixture(scope="module")
def one_pass(spark, tmp_path_factory):
    store = RollupStore(spark, str(tmp_path_factory.mktemp("one")), SOME)
    store.merge(batch(spark, 0).union(batch(spark, 1)).union(batch(spark, 2)), 0)
    return all_of(store, SOME)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 2, 1)])
@pytest.mark.parametrize("files", [1, 2])
def test_parts_add_up_to_one_pass(spark, one_pass, tmp_path, order, files):
    store = RollupStore(spark, str(tmp_path), SOME, files_per_hour=files, parts_per_hour=4)
    for n in order:
        store.merge(batch(spark, n), n)
    assert all_of(store, SOME) == one_pass and store.log.newest()[1]["batches"] == [[0, 2]]


def test_a_batch_leaves_stored_hours_where_they_are(spark, tmp_path):
    """Work follows the batch, not what is stored: no part is read or written again before an hour is full."""
    store, read = RollupStore(spark, str(tmp_path), FEW, files_per_hour=1, parts_per_hour=3), []
    reading = store._read
    store._read = lambda *a: read.append(a[0]) or reading(*a)
    rows, first = requests(spark, 60), None
    for n in range(3):
        store.merge(rows, n)
        first = first or store.rows("hourly").inputFiles()
        assert kinds(store) == {n + 1}
    read.clear()
    assert len({f.split("/data/")[1].split("/")[0] for f in store.rows("hourly").inputFiles()}) == 3
    assert set(first) <= set(store.rows("hourly").inputFiles()) and read.count("hourly") == 2
    read.clear()
    store.merge(requests(spark, 60, every=10), 3)
    assert kinds(store) == {1, 3} and sorted(read) == sorted(FEW)
    found = counts(store)
    assert found.pop("none") == 8 and sorted(set(found.values())) == [3, 4] and sum(n == 4 for n in found.values()) == 6
    assert store.rows("hourly").groupBy("hour", *TABLES["hourly"].keys).count().where("count > 1").isEmpty()


def test_no_read_while_hours_are_not_full(spark, tmp_path, monkeypatch):
    store = RollupStore(spark, str(tmp_path), FEW, files_per_hour=1, parts_per_hour=4)
    store.merge(requests(spark, 30), 0)
    monkeypatch.setattr(store, "_read", lambda *a: pytest.fail("stored hours are read"))
    store.merge(requests(spark, 30), 1)
    monkeypatch.undo()
    assert set(counts(store).values()) == {2, 4}


def test_tables_of_a_dealt_batch_need_no_shuffle(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), SOME, files_per_hour=1)
    with store._held_once(prepared(requests(spark, 60))) as (rows, hours):
        assert len(hours["hourly"]) == 61
        for name, table in SOME.items():
            frame = store._frame(name, table, rows, {}, {})
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
            assert "Aggregate" in plan and "Exchange" not in plan, plan


def test_hours_in_several_parts_are_made_again(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"hourly": TABLES["hourly"]}, files_per_hour=1, parts_per_hour=4)
    for n in range(2):
        store.merge(requests(spark, 72), n)
    store.replace(requests(spark, 72).where("request_timestamp >= '2024-01-01 05:00:00'"), ["2024010104", "2024010105"])
    found = counts(store)
    assert "2024010104" not in found and found["2024010105"] == 1 and found["none"] == 4 and len(found) == 72
    assert counts(store, first="2024010105", last="2024010106") == {"2024010105": 1, "2024010106": 2}
    store.vacuum(keep_versions=1)
    assert counts(store) == found
    store.replace(requests(spark, 72), store.hours())
    assert store.log.newest()[1]["sets"] == {} and store.vacuum(keep_versions=1) == 3
    assert set(counts(store).values()) == {1, 2}


def test_another_batch_first(spark, one_pass, tmp_path, monkeypatch):
    ours, other = (RollupStore(spark, str(tmp_path), SOME, files_per_hour=1, parts_per_hour=2) for _ in range(2))
    ours.merge(batch(spark, 2), 2)
    commit, calls = ours.log.commit, []

    def late(number, content):
        if not calls:
            calls.append(number)
            other.merge(batch(spark, 1), 1)
        return commit(number, content)

    monkeypatch.setattr(ours.log, "commit", late)
    ours.merge(batch(spark, 0), 0)
    assert all_of(ours, SOME) == one_pass and calls == [2]


def test_large_versions_are_packed_and_read_once(spark, tmp_path, monkeypatch):
    """A store of many hours has a long list of them: what it costs to write and read should not follow its text."""
    small, large = {"hours": {"a": "ä"}}, {"hours": {f"{h:010d}": "0123456789abcdef" for h in range(100_000)}}
    log = VersionLog(spark, f"{tmp_path}/versions")
    log.commit(1, small)
    log.commit(2, large)
    sizes = [len(open(f"{tmp_path}/versions/{n:012d}.json").read()) for n in (1, 2)]
    assert sizes[0] < 40 and sizes[1] < len(json.dumps(large)) / 4
    again = VersionLog(spark, f"{tmp_path}/versions")
    assert again.newest() == (2, large) and again.read(1) == small and again.newest() == (2, large)
    monkeypatch.setattr(again, "_read", lambda n: pytest.fail("read twice"))
    assert again.newest() == (2, large)


@pytest.mark.parametrize("files", [1, 2])
def test_a_batch_is_kept_as_whole_rows(spark, tmp_path, files):
    """To encode each column of a batch apart, twice, took longer than the rest of its preparation: two columns are kept, and rows come back as they were."""
    store, logs = RollupStore(spark, str(tmp_path), SOME, files_per_hour=files), prepared(batch(spark, 0))
    with store._held_once(logs) as (rows, hours):
        kept = rows._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan [")[1].split("]")[0]
        assert len(kept.split(", ")) == 2, kept
        assert sorted(map(str, rows.collect())) == sorted(map(str, logs.select(rows.columns).collect())) and "none" in hours["hourly"]


def test_a_table_that_reads_the_hour_alone(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"volume": Partial((), {"request_count": "1"})}, files_per_hour=1, parts_per_hour=2)
    for n in range(3):
        store.merge(batch(spark, n), n)
    assert sum(counts(store, "volume").values()) == batch(spark, 0).count() + batch(spark, 1).count() + batch(spark, 2).count()
