"""Versioned tables by key: upserts, replays, crashes, compaction, plans."""

import threading

import pytest

from edgeloom.sinks.keyed import KeyedTable, SeenKeys
from edgeloom.sinks.versions import Conflict, VersionLog

SCHEMA = "k bigint, v string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(df):
    return {r.k: r.v for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"{tmp_path}/t", SCHEMA, ["k"], buckets=4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upserts_replays_and_old_versions(spark, table):
    assert content(table.read()) == {}
    one = table.upsert(rows(spark, (1, "a"), (2, "a"), (None, "n")), 0)
    table.upsert(rows(spark, (2, "b"), (3, "b"), (None, "m")), 1)
    assert content(table.read()) == {1: "a", 2: "b", 3: "b", None: "m"}
    table.upsert(rows(spark, (2, "c")), 1)  # the batch again, with other rows
    assert content(table.read()) == {1: "a", 2: "c", None: "n"}
    table.upsert(rows(spark, (9, "x")).limit(0), 1)
    assert content(table.read()) == content(table.read(one)) == {1: "a", 2: "a", None: "n"}
    again = KeyedTable(spark, table.path, SCHEMA, ["k"], buckets=4)
    assert content(again.read()) == content(table.read())


def test_batches_in_any_order(spark, tmp_path):
    want = None
    for order in ([0, 1, 2], [2, 0, 1, 2, 0]):
        t = KeyedTable(spark, f"{tmp_path}/{len(order)}", SCHEMA, ["k"], buckets=2)
        for b in order:
            t.upsert(rows(spark, *[(k, f"b{b}") for k in range(b, 10, b + 1)]), b)
        want = want or content(t.read())
        assert content(t.read()) == want


def test_a_reader_sees_one_version_whole(spark, table, monkeypatch):
    table.upsert(rows(spark, (1, "old")), 0)
    reader = table.read()
    monkeypatch.setattr(table.log, "update", lambda change: (_ for _ in ()).throw(RuntimeError("lost between data and version")))
    with pytest.raises(RuntimeError, match="lost between"):
        table.upsert(rows(spark, (1, "new"), (2, "new")), 0)
    monkeypatch.undo()
    assert content(reader) == content(table.read()) == {1: "old"}  # the folder is there, no version names it
    assert len(table.log.folders(f"{table.path}/data")) == 2
    table.upsert(rows(spark, (1, "new")), 0)
    assert content(reader) == {1: "old"} and content(table.read()) == {1: "new"}


def test_compaction_swaps_and_cleans_up(spark, table):
    for b in range(4):
        table.upsert(rows(spark, (1, f"b{b}"), (10 + b, f"b{b}")), b)
    before = content(table.read())
    reader = table.read()
    table.compact()
    parts = table.log.newest()[1]["parts"]
    assert sorted(parts.values()) == [-1, 3] and content(table.read()) == content(reader) == before
    table.upsert(rows(spark, (1, "late")), 2)  # folded already
    assert content(table.read()) == before
    table.upsert(rows(spark, (1, "again")), 3)
    table.upsert(rows(spark, (10, "b4")), 4)
    table.compact(but_newest=0)
    assert table.log.newest()[1]["parts"].keys() == {p for p, b in table.log.newest()[1]["parts"].items() if b == -1} and content(table.read()) == {1: "again", 10: "b4", 11: "b1", 12: "b2"}
    assert table.vacuum(keep_versions=1) >= 4
    assert content(table.read())[1] == "again" and len(table.log.folders(f"{table.path}/data")) == 1


def test_compaction_gives_way_to_a_replay(spark, table, monkeypatch):
    for b in range(3):
        table.upsert(rows(spark, (1, f"b{b}"), (b, "x")), b)
    write = table._write

    def slow(out, label):
        part = write(out, label)
        if label == "base":
            table.upsert(rows(spark, (0, "other")), 0)
        return part

    monkeypatch.setattr(table, "_write", slow)
    table.compact()
    assert content(table.read())[0] == "other" and sorted(table.log.newest()[1]["parts"].values()) == [0, 1, 2]


def test_the_view_does_not_shuffle_the_table(spark, table):
    for b in range(2):
        table.upsert(rows(spark, (1, f"b{b}"), (2, "x")), b)
    text = plan(table.read())
    assert "Exchange" not in text and "Bucketed: true" in text


def test_a_seen_key_is_not_let_in_again(spark, tmp_path):
    seen = SeenKeys(spark, f"{tmp_path}/seen", ["k"], "k bigint", buckets=4)
    first = rows(spark, (1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-01"))
    for _ in range(2):  # and the same batch once more
        new = seen.unseen(first, 0, ["v"])
        assert content(new) == {1: "2024-01-01", 2: "2024-01-01"}
        seen.record(new, 0)
    other_time = rows(spark, (1, "2024-01-05"), (3, "2024-01-05"))
    assert content(seen.unseen(other_time, 1, ["v"])) == {3: "2024-01-05"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(seen.unseen(other_time, 1, ["v"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = text[text.index("FileScan") - 300 :]
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    loaded = text.split("== Initial Plan ==")[0]
    lines = loaded.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            above.append(line)
            depth = d
        if "SortMergeJoin" in line:
            break
    assert above and not any("Exchange" in line for line in above), loaded
    assert scan


def test_versions_are_written_once(spark, tmp_path):
    logs = [VersionLog(spark, f"{tmp_path}/v") for _ in range(2)]
    assert logs[0].newest() == (0, {})
    logs[0].commit(1, {"n": 1})
    with pytest.raises(Conflict):
        logs[1].commit(1, {"n": 2})
    assert logs[1].newest() == (1, {"n": 1})

    def add():
        log = VersionLog(spark, f"{tmp_path}/v")
        for _ in range(5):
            log.update(lambda now: {"n": now["n"] + 1}, tries=100)

    threads = [threading.Thread(target=add) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert logs[0].newest() == (16, {"n": 16})
    logs[0].forget(2)
    assert logs[0].numbers() == [15, 16]
