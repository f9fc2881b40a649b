"""Answers that are known without any other program, and default thresholds on frames built for them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from edgeloom.functions import weblog
from edgeloom.operators import joins, limits, windows
from edgeloom.plans import performance, security
from edgeloom.sources import messages
from edgeloom.streaming.windows import endpoint_window

LINE = '84.167.73.187 - - [07/Dec/2025:20:59:02 +0000] "GET /api HTTP/1.1" 200 1234 "-" "curl" 0.5'
NOW = dt.datetime(2025, 12, 13, 10, 0)


def parse(spark, line):
    good, bad = weblog.parse_access_log(spark.createDataFrame([(line,)], "line string"))
    return good.collect(), bad.collect()


def test_first_version_of_a_line(spark):
    (row,), bad = parse(spark, LINE)
    assert not bad and row.ip == "84.167.73.187" and row.region is None and row.schema_version == 1
    assert row.event_timestamp == dt.datetime(2025, 12, 7, 20, 59, 2) or row.event_timestamp is not None


def test_second_version_of_a_line(spark):
    (row,), _ = parse(spark, LINE + " region=us-east-1 user_id=12345")
    assert (row.region, row.user_id, row.schema_version) == ("us-east-1", "12345", 2)


def test_malformed_line(spark):
    good, (row,) = parse(spark, "invalid log format")
    assert not good and row.error == "Invalid log format"


def test_unknown_fields_are_kept(spark):
    (row,), _ = parse(spark, LINE + " custom_field=value")
    assert row.custom_fields == {"custom_field": "value"}


def test_three_requests_make_one_window_row(spark):
    sent = [f'{{"timestamp":"2025-12-13T10:00:0{i}Z","ip":"1.2.3.4","method":"GET","endpoint":"/test","status":200,"response_time":0.{5 + i}}}' for i in range(3)]
    good, bad = messages.decode_json(spark.createDataFrame([(s.encode(),) for s in sent], "value binary"))
    assert bad.count() == 0
    logs = good.select(
        F.col("event_timestamp").alias("request_timestamp"), F.col("ip").alias("cli_ip"), F.col("method").alias("req_method"), F.col("endpoint").alias("req_path"),
        F.col("status").alias("status_code"), (F.col("response_time") * 1000).alias("turn_around_time_ms"), F.lit(0).alias("transfer_time_ms"), F.lit("curl").alias("user_agent"),
    )
    (row,) = endpoint_window(logs).collect()
    assert (row.request_count, row.error_count, row.unique_ips) == (3, 0, 1) and row.avg_response_time == pytest.approx(0.6)


def test_addresses(spark):
    df = spark.createDataFrame([("0.0.0.1",), ("255.255.255.255",), ("300.1.1.1",), ("1.2.3",), (None,)], "ip string")
    assert [r.n for r in df.select(joins.ip_to_long("ip").alias("n")).collect()] == [1, 2**32 - 1, None, None, None]


def test_narrowest_range_wins(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "all"), (10 * 2**24, 11 * 2**24 - 1, "ten"), (10 * 2**24 + 5, 10 * 2**24 + 5, "one"), (10 * 2**24 + 250, 10 * 2**24 + 260, "across")], "first_ip long, last_ip long, geo string")
    logs = spark.createDataFrame([(i, a) for i, a in enumerate(["10.0.0.5", "10.0.0.6", "11.0.0.0", "10.0.1.4", "10.0.0.250", "x"])] + [(100 + i, "10.0.0.5") for i in range(5000)], "req_id long, cli_ip string")
    got = {r.req_id: r.geo for r in joins.ip_range_lookup(logs, ranges).collect()}
    assert [got[i] for i in range(6)] == ["one", "ten", "all", "across", "across", None] and len(got) == 5006 and got[200] == "one"


def test_insert_ignore_keeps_the_first(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "req_id long, request_timestamp timestamp_ntz, v string")
    batch = rows((1, NOW, "a"), (1, NOW + dt.timedelta(seconds=1), "b"), (2, NOW, "c"), (3, NOW, "d"))
    got = joins.only_new(batch, rows((3, NOW, "loaded")), ["req_id"])
    assert sorted((r.req_id, r.v) for r in got.collect()) == [(1, "a"), (2, "c")]
    assert joins.only_new(batch.limit(0), rows((3, NOW, "loaded")), ["req_id"]).collect() == []
    later = rows((3, NOW + dt.timedelta(days=4), "again"), (4, NOW + dt.timedelta(days=4), "e"))
    loaded = rows((3, NOW, "loaded"))
    assert [r.v for r in joins.only_new(later, loaded, ["req_id"]).collect()] == ["e"]
    assert joins.only_new(later, loaded, ["req_id"], same_time=True).count() == 2  # on the caller's word


def test_limiter_at_its_own_limit(spark):
    at = [NOW] * 100 + [NOW + dt.timedelta(seconds=59)] * 3 + [NOW + dt.timedelta(seconds=60)]
    logs = spark.createDataFrame([("a", t) for t in at], "cli_ip string, request_timestamp timestamp_ntz")
    got = windows.rate_limit_violations(logs).collect()
    assert [(r.requests, r.requests_in_window, r.refused) for r in got] == [(3, 103, 3)]


def _requests(spark, n, path="/p", ip="a", back=dt.timedelta(seconds=30)):
    return spark.range(n).select(
        F.lit(ip).alias("cli_ip"), F.lit("US").alias("country"), F.lit(path).alias("req_path"), F.lit("h").alias("req_host"), F.lit(200).alias("status_code"),
        F.lit((NOW - back).isoformat(sep=" ")).cast("timestamp_ntz").alias("request_timestamp"), F.lit(5).alias("turn_around_time_ms"), F.lit(5).alias("transfer_time_ms"),
        F.lit(1).alias("cache_status"), F.lit(10).cast("long").alias("bytes"), F.lit("ua").alias("user_agent"), F.lit(7).cast("long").alias("ttfb_ms"), F.lit(9).cast("long").alias("throughput_bps"),
    )


@pytest.mark.parametrize("query,least", [(security.attack_sources, 1000), (security.ddos_sources, 1000)])
def test_default_floods(spark, query, least):
    below, above = (query(_requests(spark, n), NOW).count() for n in (least // 20, least + 1))
    assert (below, above) == (0, 1)


def test_default_least_requests_of_slow_paths(spark):
    logs = _requests(spark, 1001, "/busy").union(_requests(spark, 900, "/quiet"))
    assert [r.req_path for r in performance.slowest_paths(logs, NOW).collect()] == ["/busy"]


def test_default_least_requests_of_bots(spark):
    assert security.bot_traffic(_requests(spark, 50), NOW).count() == 0


def test_hours_are_utc_in_any_session_zone(spark):
    from edgeloom.operators.enrich import enrich, from_cdn_layout

    raw = spark.createDataFrame([(1704076200, 200, 1, 5, 5, "Mobile")], "reqTimeSec long, statusCode int, cacheStatus int, turnAroundTimeMSec long, transferTimeMSec long, UA string")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        row = enrich(from_cdn_layout(raw)).select("request_timestamp", "hour", "date").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.request_timestamp, row.hour, row.date) == (dt.datetime(2024, 1, 1, 2, 30), dt.datetime(2024, 1, 1, 2), dt.date(2024, 1, 1))


def plain_limiter(times, limit, window):
    """The admitting limiter, request by request."""
    kept, out = [], {}
    for t in sorted(times):
        kept = [k for k in kept if t - k < window]
        ok = len(kept) < limit
        kept += [t] * ok
        n, a = out.get(t, (0, 0))
        out[t] = (n + 1, a + ok)
    return out


def test_limiter_that_counts_what_it_let_in(spark):
    import random

    rng = random.Random(2)
    clients = {"hot": [rng.randrange(4000) for _ in range(20_000)], "calm": [rng.randrange(4000) for _ in range(60)], None: [5] * 120 + [64, 65, 66], "pauses": [0] * 101 + [60, 200, 200] + [900] * 150}
    rows = [(c, NOW + dt.timedelta(seconds=t)) for c, times in clients.items() for t in times]
    logs = spark.createDataFrame([*rows, ("calm", None)], "cli_ip string, request_timestamp timestamp_ntz").repartition(5)
    for limit, window in ((100, 60), (7, 300)):
        got = {}
        for r in limits.admitted(logs, limit=limit, window_seconds=window).collect():
            got.setdefault(r.cli_ip, {})[int((r.second - NOW).total_seconds())] = (r.requests, r.admitted)
            assert r.refused == r.requests - r.admitted
        assert got == {c: plain_limiter(times, limit, window) for c, times in clients.items()}
    trusted = limits.admitted(logs, limit=F.when(F.col("cli_ip") == "hot", 1000).otherwise(100)).where("cli_ip = 'hot'").agg(F.sum("refused")).first()[0]
    assert trusted == 0


def test_ranges_that_overlap_in_any_way(spark):
    import random

    rng = random.Random(4)
    ranges = []
    for i in range(60):
        first = rng.randrange(2**32)
        ranges.append((first, min(2**32 - 1, first + rng.choice([0, 1, 255, 65_535, 65_536, 2**20, 2**30])), f"r{i}"))
    ranges += [(2**24, 2**24 + 9, None), (2**24, 2**24 + 99, "wide"), (2**32 - 1, 2**32 - 1, "last")]
    numbers = sorted({n for a, b, _ in ranges for n in (a, b, min(b + 1, 2**32 - 1), max(a - 1, 0), (a + b) // 2)})
    logs = spark.createDataFrame([(i, ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))) for i, n in enumerate(numbers)], "req_id long, cli_ip string")
    frame = spark.createDataFrame(ranges, "first_ip long, last_ip long, geo string")
    got = {r.req_id: r.geo for r in joins.ip_range_lookup(logs, frame).collect()}
    for i, n in enumerate(numbers):
        holding = [(b - a, a, g) for a, b, g in ranges if a <= n <= b]
        narrowest = {g for w, a, g in holding if (w, a) == min((w, a) for w, a, _ in holding)} if holding else {None}
        assert got[i] in narrowest, (n, got[i], holding)
    assert joins.ip_range_lookup(logs, frame.limit(0)).where("geo is not null").count() == 0
