"""Sources and sinks over real files."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from edgeloom.catalog import ingest
from edgeloom.context import LogTables
from edgeloom.operators import retention
from edgeloom.operators.windows import dedup_latest
from edgeloom.sinks import tables
from edgeloom.sources import archive, bundles, cdn, daily, schemas


@pytest.fixture(scope="module")
def landed(spark, small, tmp_path_factory):
    """Two gzip files of good lines and one that also holds malformed ones."""
    base = tmp_path_factory.mktemp("cdn")
    lines = [r.line for r in cdn.to_cdn_line(LogTables(spark, small).logs).select("line").collect()]
    for i, part in enumerate((lines[:500], lines[500:], ["not a line at all", lines[0].replace("1 123456", "1 x", 1)])):
        (base / f"f{i}.csv.gz").write_bytes(gzip.compress("\n".join(part).encode()))
    return base, len(lines)


def test_good_and_quarantined_lines_are_all_lines(spark, landed):
    base, n = landed
    good, bad = cdn.read_cdn_logs(spark, [str(base)])
    assert (good.count(), bad.count()) == (n, 2)
    assert good.agg(F.sum("bytes")).first()[0] > 0 and good.select("country").count() == n
    assert {r.line[:5] for r in bad.collect()} == {"not a", "1 x A"[:5]} or bad.count() == 2
    assert bad.columns == ["line"]


def test_new_files_of_a_directory_as_a_stream(spark, landed, tmp_path):
    base, n = landed
    rows = cdn.scan_stream(spark, str(base), max_files=1)
    good, _ = cdn.split_malformed(rows)
    query = good.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == n and out.select("file_path").distinct().count() == 2 and len(query.recentProgress) >= 3


def outputs(tmp_path):
    return daily.DailyOutputs(*[f"{tmp_path}/{x}" for x in ("rollups", "archive", "quarantine", "quality", "ledger")])


def test_daily_batch_can_be_repeated(spark, landed, tmp_path):
    base, n = landed
    out = outputs(tmp_path)
    for _ in range(2):
        daily.daily_batch(spark, [str(base)], dt.date(2024, 1, 15), out)
    assert daily.archived(spark, out).count() == n and spark.read.parquet(out.quarantine).count() == 2
    assert daily.hourly(spark, out).agg(F.sum("request_count")).first()[0] == n
    assert spark.read.parquet(out.quality).count() == 1
    runs = spark.read.parquet(out.ledger).collect()
    assert [(r.status, r.rows_read, r.rows_processed, r.rows_rejected, r.files_processed) for r in runs] == [("success", n + 2, n, 2, 3)] * 2


def rollups_of(spark, out):
    hours = daily.hourly(spark, out)
    assert hours.count() == hours.select("window_start", "country", "status_code", "cache_status").distinct().count()
    return sorted(map(str, hours.collect())), sorted(map(str, daily.daily(spark, out).collect()))


def test_any_order_of_files_and_runs_ends_the_same(spark, landed, tmp_path):
    """Two runs whose files hold rows of the same days, in both orders, one with other files first."""
    base, n = landed
    first, second, broken = ([str(base / f"f{i}.csv.gz")] for i in (0, 1, 2))
    one, two = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    ends = []
    for i, order in enumerate(([(first, one), (second, two)], [(second, two), (second, one), (first, one), (second, two)], [(first + second, one), (broken, one), (first, one), (second, two)])):
        out = outputs(tmp_path / str(i))
        for files, day in order:
            daily.daily_batch(spark, files, day, out)
        ends.append(rollups_of(spark, out))
        assert daily.archived(spark, out).count() == n
    assert ends[0] == ends[1] == ends[2]
    days = daily.archived(spark, out).select(F.to_date("request_timestamp").alias("d"), F.make_date("year", "month", "day").alias("p"))
    assert days.where("d != p").count() == 0
    a_day = days.first().d
    pruned = daily.archived(spark, out, [a_day])
    assert pruned.count() == days.where(F.col("d") == a_day).count() < n
    assert "isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_run_that_fails_is_in_the_ledger(spark, landed, tmp_path, monkeypatch):
    base, n = landed
    out = outputs(tmp_path)
    monkeypatch.setattr(daily, "_roll_up", lambda *a: (_ for _ in ()).throw(RuntimeError("no room")))
    with pytest.raises(RuntimeError, match="no room"):
        daily.daily_batch(spark, [str(base)], dt.date(2024, 1, 15), out)
    monkeypatch.undo()
    daily.daily_batch(spark, [str(base)], dt.date(2024, 1, 15), out)
    runs = spark.read.parquet(out.ledger).orderBy("started_at").collect()
    assert [(r.status, r.rows_read) for r in runs] == [("failed", n + 2), ("success", n + 2)] and "no room" in runs[0].error_message
    assert daily.hourly(spark, out).agg(F.sum("request_count")).first()[0] == n


def test_a_line_is_parsed_once(spark, landed):
    for half in cdn.read_cdn_logs(spark, [str(landed[0])]):
        assert half._jdf.queryExecution().executedPlan().toString().count("from_csv") == 1


def test_an_empty_retry_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    tables.write_batch(rows, 6, f"{tmp_path}/t")
    tables.write_batch(rows, 7, f"{tmp_path}/t")
    tables.write_batch(rows.limit(0), 7, f"{tmp_path}/t")
    assert [r.batch_id for r in spark.read.parquet(f"{tmp_path}/t").select("batch_id").distinct().collect()] == [6]


def test_upserts_with_maps_and_ties(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, m map<string,string>")
    tables.write_batch(rows((1, "old", {"a": "1"}), (2, "only", None)), 1, f"{tmp_path}/t")
    tables.write_batch(rows((1, "new", {"a": "2"}), (1, "newer", {})), 2, f"{tmp_path}/t")
    got = {r.k: (r.v, r.m) for r in tables.read_latest(spark, f"{tmp_path}/t", ["k"]).collect()}
    assert got == {1: ("newer", {}), 2: ("only", None)}
    tables.compact(spark, f"{tmp_path}/t", ["k"], f"{tmp_path}/compact", 9)
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 2
    same = dedup_latest(rows((1, "a", None), (1, "b", None)).withColumn("at", F.lit(1)), ["k"], "at").collect()
    assert [r.v for r in same] == ["b"]


def test_versions_and_quarantine(spark, tmp_path):
    parsed = spark.createDataFrame([("a", 1, {"x": "y"}), ("b", 2, None)], "ip string, schema_version int, custom_fields map<string,string>")
    tables.write_versions(parsed, 3, f"{tmp_path}/v")
    counts = [spark.read.parquet(f"{tmp_path}/v/{p}").count() for p in ("v1", "v2", "union")]
    assert counts == [1, 1, 2]
    for _ in range(2):
        tables.write_quarantine(parsed.select("ip"), f"{tmp_path}/once", 7)
    assert spark.read.parquet(f"{tmp_path}/once").count() == 2
    tables.write_quarantine(parsed.select("ip"), f"{tmp_path}/q")
    tables.write_quarantine(parsed.select("ip"), f"{tmp_path}/q")
    assert spark.read.parquet(f"{tmp_path}/q").where("rejected_at is not null").count() == 4


def test_archive_prunes_days_and_dated_folders(spark, small, tmp_path):
    logs = LogTables(spark, small).logs
    tables.write_archive(logs, f"{tmp_path}/a", files_per_day=2)
    day = logs.agg(F.to_date(F.min("request_timestamp"))).first()[0]
    one = archive.read_archive(spark, f"{tmp_path}/a", day, day)
    assert one.count() == logs.filter(F.to_date("request_timestamp") == F.lit(day)).count() > 0
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()
    pattern = archive.hour_folders("/base", dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))
    assert pattern == "/base/{2024/01/01/23,2024/01/02/00}"
    long = archive.hour_folders("/b/", dt.datetime(2022, 11, 29, 22, 30), dt.datetime(2024, 2, 2, 1, 30))
    assert long == "/b/{2022/11/29/22,2022/11/29/23,2022/11/30/*,2022/12/*/*,2023/*/*/*,2024/01/*/*,2024/02/01/*,2024/02/02/00,2024/02/02/01}"


def test_export_ledger_and_empty_database_append(spark, small, tmp_path):
    as_of = dt.datetime(2024, 1, 2, 5)
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3), 1), (dt.datetime(2024, 1, 2, 3), 2)], "window_start timestamp_ntz, n int")
    tables.export_yesterday(rows, f"{tmp_path}/csv", as_of)
    assert [r._c1 for r in spark.read.csv(f"{tmp_path}/csv").collect()] == ["1"]
    row = tables.ledger_row(spark, "job", "r1", "host", as_of, as_of + dt.timedelta(seconds=90), 3, 10, None).first()
    assert (row.status, row.duration_seconds) == ("success", 90)
    assert tables.ledger_row(spark, "job", "r1", "host", as_of, as_of, 0, 0, "boom").first().status == "failed"
    assert tables.append_jdbc(rows.limit(0), tables.jdbc_options("jdbc:x", "t", "u", "p", "d")) is False


def test_bundles_of_any_size(spark, tmp_path):
    (tmp_path / "list.json").write_text('\n [{"a": 1},\n {"a": 2}]')
    (tmp_path / "lines.log").write_text("0 first\n\n 7 second \n" + "x\n" * 2000)
    parsed = bundles.parse_bundles(bundles.read_bundles(spark, str(tmp_path)))
    assert {r.log for r in parsed.where("format = 'json'").collect()} == {'{"a":1}', '{"a":2}'}
    assert parsed.where("format = 'text'").count() == 2002 and parsed.where("log = '7 second'").count() == 1


def test_schema_specs_and_evolution():
    spec = json.dumps({"fields": [{"name": "a", "type": "integer"}, {"name": "b", "type": "string"}]})
    old, new = schemas.schema_from_spec(spec), schemas.schema_from_spec({"fields": [{"name": "a", "type": "long"}, {"name": "c", "type": "string"}]})
    assert schemas.evolution_problems(old, old) == [] and schemas.evolution_problems(old, new) == ["removed: b"]
    assert len(schemas.cdn_schema()) == 68


def test_retention_moves_partitions_and_masks_in_place(spark, small, tmp_path):
    logs = LogTables(spark, small).logs.withColumn("day", F.to_date("request_timestamp"))
    days = sorted(r.day for r in logs.select("day").distinct().collect())
    as_of, n = dt.datetime.combine(days[-1], dt.time()), logs.count()
    logs.select("req_id", "request_timestamp", "day").write.partitionBy("day").saveAsTable("aged")
    for _ in range(2):
        moved = retention.archive_old_partitions(spark, "aged", f"{tmp_path}/arch", as_of, "day", days=10)
        kept, archived = spark.table("aged").count(), spark.read.parquet(f"{tmp_path}/arch").count()
        assert kept + archived == n and 0 < kept < n
    assert moved == 0
    logs.write.partitionBy("day").parquet(f"{tmp_path}/logs")
    for i in range(2):
        retention.anonymize_old_partitions(spark, f"{tmp_path}/logs", f"{tmp_path}/work{i}", as_of, "day", days=10)
    got = spark.read.parquet(f"{tmp_path}/logs")
    expect = retention.anonymize_older_than(logs, as_of, 10)
    assert got.count() == n
    assert got.where("cli_ip = 'ANONYMIZED'").count() == expect.where("cli_ip = 'ANONYMIZED'").count() > 0


def test_busy_visitors_upload_several_bundles(spark, small, monkeypatch):
    t = LogTables(spark, small)
    hot = t.logs.withColumn(ingest.TS, F.lit(dt.datetime(2024, 1, 2))).withColumn("user_id", F.when(F.col("req_id") % 3 == 0, 7).otherwise(F.col("user_id")))
    busy = type("Tables", (), {"logs": hot})
    whole = sorted(map(tuple, ingest.bundle_logs(busy).collect()))
    parse, seen = bundles.parse_bundles, []
    monkeypatch.setattr(ingest, "BUNDLE", 5, raising=False)
    monkeypatch.setattr(bundles, "parse_bundles", lambda bodies: seen.append(bodies) or parse(bodies))
    assert sorted(map(tuple, ingest.bundle_logs(busy).collect())) == whole
    most = seen[0].where("user_id = 7").select(F.max(F.size(F.split("body", "req_id")) - 1)).first()[0]
    assert hot.where("user_id = 7").count() > 100 and most < 4 * 5


def scanned(df):
    """Rows that the scans of a plan hand on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    out, todo = 0, [leaves.apply(i) for i in range(leaves.size())]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName() or "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.plan() if "QueryStage" in node.nodeName() else node.executedPlan())
        elif node.children().isEmpty():
            out += node.metrics().apply("numOutputRows").value()
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_lookups_skip_most_row_groups(spark, small, tmp_path):
    logs = LogTables(spark, small).logs
    many = logs.crossJoin(spark.range(20).withColumnRenamed("id", "copy")).withColumn("req_id", F.col("req_id") * 20 + F.col("copy")).drop("copy")
    many = many.withColumn("cli_ip", F.concat_ws(".", F.lit("203.0"), F.col("req_id") % 250, F.col("user_id") % 251)).persist()
    days = many.select(F.to_date("request_timestamp").alias("d")).distinct().count()
    small_groups = {"parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10"}
    for k, v in small_groups.items():
        spark.conf.set(k, v)
    tables.write_lookup_archive(many, f"{tmp_path}/a", files_per_day=4, row_group_bytes=1 << 16, days=days)
    one = many.where("req_id % 977 = 5").first()
    day = one.request_timestamp.date()
    in_day = many.where(F.to_date("request_timestamp") == F.lit(day)).count()
    by_address = archive.look_up(spark, f"{tmp_path}/a", day, day, cli_ip=one.cli_ip)
    want = many.where((F.col("cli_ip") == one.cli_ip) & (F.to_date("request_timestamp") == F.lit(day))).count()
    assert by_address.count() == want > 0 and scanned(by_address) < 0.35 * in_day
    by_id = archive.look_up(spark, f"{tmp_path}/a", req_id=one.req_id)
    assert by_id.count() == 1 and scanned(by_id) < 0.2 * many.count()
    absent = archive.look_up(spark, f"{tmp_path}/a", req_id=one.req_id + 10**12)
    assert scanned(absent) == 0
    for k in small_groups:
        spark.conf.unset(k)
    many.unpersist()


def test_a_partition_that_a_run_empties_goes(spark, tmp_path):
    rows = spark.createDataFrame([(d, h, i) for i, (d, h) in enumerate([(1, 0), (1, 1), (2, 0), (3, 0)])], "day int, hour int, v int")
    path, by = f"{tmp_path}/t", ["day", "hour"]
    tables.replace_partitions(rows, path, by)
    again = rows.where("day = 1 and hour = 1").withColumn("v", F.lit(9))
    tables.replace_partitions(again, path, by, scope=[(1, 0), (1, 1), (2, 0), (7, 7)])
    assert sorted((r.day, r.hour, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1, 9), (3, 0, 3)]
