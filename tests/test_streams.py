"""The streaming jobs as streams: same as batch, late rows, restarts, replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from edgeloom.context import LogTables
from edgeloom.functions import weblog
from edgeloom.operators.enrich import enrich
from edgeloom.operators.windows import sustained_breaches
from edgeloom.sinks.keyed import KeyedTable
from edgeloom.streaming import jobs, windows


@pytest.fixture(scope="module")
def arrived(spark, small, tmp_path_factory):
    """The log in files by time, as it would arrive."""
    path = f"{tmp_path_factory.mktemp('arrived')}/logs"
    logs = LogTables(spark, small).logs
    logs.repartitionByRange(3, "request_timestamp").sortWithinPartitions("request_timestamp").write.parquet(path)
    return path, spark.read.parquet(path)


def stream(spark, arrived, **options):
    return spark.readStream.schema(arrived[1].schema).options(**options).parquet(arrived[0])


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("job", [windows.endpoint_window, windows.status_window, windows.user_window, windows.hourly_country_window])
def test_stream_equals_batch(spark, arrived, tmp_path, job):
    keys = {"endpoint_window": ["endpoint", "method"], "status_window": ["status"], "user_window": ["ip"], "hourly_country_window": ["country"]}[job.__name__]
    jobs.run(job(stream(spark, arrived)), jobs.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    from edgeloom.sinks.tables import read_latest

    got = read_latest(spark, f"{tmp_path}/out", ["window_start", *keys])
    assert rows(got) == rows(job(arrived[1]))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "request_timestamp timestamp_ntz, v int"
    start = dt.datetime(2024, 1, 1)
    for i, minutes in enumerate((0, 30, 1)):  # the third file comes after the watermark has passed it
        spark.createDataFrame([(start + dt.timedelta(minutes=minutes), i)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{i}")
    spark.read.parquet(f"{tmp_path}/in0").write.parquet(f"{tmp_path}/in")
    count = lambda s: windows.timed(s).groupBy(F.window("request_timestamp", "30 seconds")).count()
    late = 0
    for i in range(3):
        if i:
            spark.read.parquet(f"{tmp_path}/in{i}").write.mode("append").parquet(f"{tmp_path}/in")
        query = jobs.run(count(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), jobs.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
        late += jobs.late_rows(query)
    assert late == 1 and spark.read.parquet(f"{tmp_path}/out").agg(F.sum("count")).first()[0] == 2


def test_restart_goes_on_and_replay_counts_once(spark, arrived, tmp_path):
    sink = jobs.batch_sink(f"{tmp_path}/out")
    source = lambda: stream(spark, arrived, maxFilesPerTrigger=1).select("req_id", "request_timestamp")
    calls = []

    def failing(rows_, batch_id):
        sink(rows_, batch_id)
        calls.append(batch_id)
        if batch_id == 1 and calls.count(1) == 1:
            raise RuntimeError("lost after the write, before the commit")

    with pytest.raises(Exception, match="lost after the write"):
        jobs.run(source(), failing, f"{tmp_path}/c", mode="append")
    jobs.run(source(), failing, f"{tmp_path}/c", mode="append")
    assert calls.count(0) == 1 and calls.count(1) == 2
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == arrived[1].count() == out.select("req_id").distinct().count()
    jobs.run(source(), failing, f"{tmp_path}/c", mode="append")
    assert spark.read.parquet(f"{tmp_path}/out").count() == arrived[1].count()


def test_dedup_sessions_and_dual_sink(spark, arrived, tmp_path):
    twice = stream(spark, arrived).select("req_id", "request_timestamp")
    again = twice.union(stream(spark, arrived).select("req_id", "request_timestamp"))
    jobs.run(windows.first_arrivals(again, ["req_id", "request_timestamp"]), jobs.batch_sink(f"{tmp_path}/once"), f"{tmp_path}/c1", mode="append")
    assert spark.read.parquet(f"{tmp_path}/once").count() == arrived[1].count()
    closed = windows.sessions(stream(spark, arrived), gap="6 hours")
    jobs.run(closed, jobs.batch_sink(f"{tmp_path}/sessions"), f"{tmp_path}/c2", mode="append")
    got = spark.read.parquet(f"{tmp_path}/sessions").drop("batch_id")
    batch = windows.sessions(arrived[1], gap="6 hours")
    assert set(rows(got)) <= set(rows(batch)) and got.count() > 0.8 * batch.count()
    totals = lambda df: df.groupBy("country").count()
    jobs.run(stream(spark, arrived), jobs.dual_sink(totals, f"{tmp_path}/m", f"{tmp_path}/a"), f"{tmp_path}/c3", mode="append")
    assert spark.read.parquet(f"{tmp_path}/a").count() == spark.read.parquet(f"{tmp_path}/m").agg(F.sum("count")).first()[0] == arrived[1].count()


def test_versions_are_routed_and_alerts_sent(spark, arrived, tmp_path):
    lines = arrived[1].select(weblog.combined_line().alias("value")).union(spark.createDataFrame([("garbage",)], "value string"))
    lines.write.text(f"{tmp_path}/lines")
    source = spark.readStream.text(f"{tmp_path}/lines")
    jobs.run(source, jobs.version_sink(f"{tmp_path}/v"), f"{tmp_path}/c1", mode="append")
    counts = {p: spark.read.parquet(f"{tmp_path}/v/{p}").count() for p in ("v1", "v2", "union", "rejected")}
    assert counts["v1"] + counts["v2"] == counts["union"] == arrived[1].count() and counts["rejected"] == 1 and counts["v2"] > 0
    alerts = jobs.filtered_sink(windows.window_alerts, jobs.batch_sink(f"{tmp_path}/alerts"))
    jobs.run(windows.endpoint_window(stream(spark, arrived), "1 hour"), alerts, f"{tmp_path}/c2")
    expect = windows.window_alerts(windows.endpoint_window(arrived[1], "1 hour"))
    assert rows(spark.read.parquet(f"{tmp_path}/alerts").drop("batch_id")) == rows(expect)


def test_sustained_alerts_as_a_stream_across_a_restart(spark, arrived, tmp_path):
    """The same runs as the batch finds, but for those that the watermark has not passed."""
    logs = arrived[1]
    hourly = enrich(logs).groupBy("hour", "country").agg((F.sum("is_error") * 100.0 / F.count(F.lit(1))).alias("pct"))
    batch = sustained_breaches(hourly, ["country"], "hour", F.col("pct") > 10, 3600, 2)
    columns = ["country", "breach_start", "breach_end", "periods"]
    as_text = lambda df: sorted(str(tuple(map(str, r))) for r in df.select(columns).collect())
    assert as_text(windows.sustained_alerts(logs, ["country"])) == as_text(batch) and batch.count() >= 5
    spark.createDataFrame([], logs.schema).write.parquet(f"{tmp_path}/in")
    days = sorted(r.d for r in logs.select(F.to_date("request_timestamp").alias("d")).distinct().collect())
    cuts = (days[0], days[len(days) // 3], days[2 * len(days) // 3], days[-1] + dt.timedelta(days=1))
    for low, high in zip(cuts, cuts[1:]):  # the stream ends after each part, and goes on from its checkpoint
        logs.where((F.to_date("request_timestamp") >= F.lit(low)) & (F.to_date("request_timestamp") < F.lit(high))).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(logs.schema).parquet(f"{tmp_path}/in")
        jobs.run(windows.sustained_alerts(source, ["country"]), jobs.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c", mode="append")
    got, want = as_text(spark.read.parquet(f"{tmp_path}/out")), as_text(batch)
    assert set(got) <= set(want) and len(got) == len(set(got)) and len(got) >= len(want) - 1


def test_a_renewed_baseline_is_seen_by_the_next_batch(spark, arrived, tmp_path):
    logs = arrived[1]
    table = KeyedTable(spark, f"{tmp_path}/baseline", "country string, baseline double", ["country"], buckets=2)
    hourly = windows.hourly_country_window(logs)
    usual = hourly.groupBy("country").agg(F.avg("request_count").alias("baseline"))
    table.upsert(usual, 0)
    got, seen = {}, []

    def keep(rows_, batch_id):
        got[batch_id] = rows_.select("country", "request_count", "baseline").collect()
        seen.append(batch_id)
        table.upsert(usual.withColumn("baseline", F.lit(0.0)), 1)  # a later job renews it between two batches

    sink = jobs.baseline_sink(table.read, ["country"], keep, factor=1.5)
    source = stream(spark, arrived, maxFilesPerTrigger=1).select("country", "request_timestamp")
    counted = source.groupBy("country", F.to_date("request_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("request_count"))
    jobs.run(counted, sink, f"{tmp_path}/c")
    assert len(seen) >= 3 and got[1] and {r.baseline for r in got[1]} == {0.0} and 0.0 not in {r.baseline for r in got[0]}


def test_late_rows_of_more_batches_than_are_reported(spark, tmp_path):
    schema, start = "request_timestamp timestamp_ntz, v int", dt.datetime(2024, 1, 1)
    for i in range(8):  # after the first, every file is late
        minutes = 90 if i == 0 else i
        spark.createDataFrame([(start + dt.timedelta(minutes=minutes), i)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    listener = jobs.LateRows()
    spark.streams.addListener(listener)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = jobs.run(windows.timed(source()).groupBy(F.window("request_timestamp", "30 seconds")).count(), jobs.batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
        kept = spark.read.parquet(f"{tmp_path}/out").agg(F.sum("count")).first()[0]
        assert jobs.late_rows(query) < listener.of(query) == 8 - kept > 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(listener)
