"""Stored roll-ups as files: their number grows with the rows, not with the hours, and rows of hours that moved on are left out."""

import glob

import pytest
from pyspark.sql import functions as F

from edgeloom.sinks.rollup_store import TABLES, RollupStore, folder_of, half_minute, prepared

FEW = {name: TABLES[name] for name in ("hourly", "clients", "statuses", "status_visitors")}
HOURS = 24 * 70


def requests(spark, hours=HOURS, every=1):
    """One request in each ``every``th hour from New Year's Eve on, and two without a time."""
    rows = spark.range(hours).where(F.col("id") % every == 0)
    at = F.expr("TIMESTAMP_NTZ '2023-12-31 00:10:00' + make_dt_interval(0, CAST(id AS INT))")
    return rows.select("id", at.alias("request_timestamp")).unionByName(
        spark.range(2).select("id", F.lit(None).cast("timestamp_ntz").alias("request_timestamp"))
    ).selectExpr(
        "id AS req_id", "request_timestamp", "concat('a', id % 3) AS cli_ip", "'US' AS country", "'/' AS req_path", "'GET' AS req_method",
        "CAST(IF(id % 7 = 0, NULL, 200) AS INT) AS status_code", "id AS bytes", "CAST(id % 90 AS INT) AS turn_around_time_ms",
        "CAST(1 AS INT) AS transfer_time_ms", "id AS ttfb_ms", "CAST(id % 2 AS INT) AS cache_status", "'Mozilla' AS user_agent", "'' AS security_rules",
    )


def counts(store, name="hourly", **options):
    rows = store.rows(name, **options)
    return {r.h: r.n for r in rows.groupBy(folder_of().alias("h")).agg(F.sum("request_count").alias("n")).collect()}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Two batches in all hours, one in every tenth, which takes those over."""
    store = RollupStore(spark, str(tmp_path_factory.mktemp("files")), FEW, files_per_hour=1)
    for batch, every in ((1, 1), (0, 1), (2, 10)):
        store.merge(requests(spark, every=every), batch)
    return store


def test_files_do_not_grow_with_the_hours(store):
    files = glob.glob(f"{store.path}/data/*/hourly/**/*.parquet", recursive=True)
    assert len(store.hours()) == HOURS + 1 and len(files) < 60, len(files)


def test_rows_of_hours_that_moved_on_are_left_out(spark, store):
    whole = counts(store)
    assert whole.pop("none") == 6 and len(whole) == HOURS
    assert sorted(set(whole.values())) == [2, 3] and sum(n == 3 for n in whole.values()) == HOURS // 10
    week = counts(store, first="2024022900", last="2024030623")
    assert week == {h: n for h, n in whole.items() if "2024022900" <= h <= "2024030623"} and len(week) == 7 * 24
    visitors = store.rows("status_visitors").agg(F.count("*"), F.min(F.hll_sketch_estimate("ip_sketch")), F.max(F.hll_sketch_estimate("ip_sketch"))).first()
    assert tuple(visitors) == (HOURS + 2, 1, 1)


def test_an_hour_that_is_made_again_or_goes(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"hourly": TABLES["hourly"]})
    store.merge(requests(spark, 72), 0)
    store.replace(requests(spark, 72).where("request_timestamp >= '2024-01-01 05:00:00'"), ["2024010104", "2024010105"])
    found = counts(store)
    assert "2024010104" not in found and set(found.values()) == {1, 2} and len(found) == 72 and sorted(found) == store.hours()
    store.merge(requests(spark, 72), 1)
    found = counts(store)
    assert found["2024010104"] == 1 and found["2024010105"] == 2 and found["none"] == 4


def test_one_shuffle_for_a_batch_and_what_is_held(spark, store):
    _, now = store.log.newest()
    table = TABLES["hourly"]
    rows = store._with_held("hourly", table.added(prepared(requests(spark, 24))), now, {"2024010104": now["hours"]["hourly"]["2024010104"]})
    plan = table.merged(rows.withColumn("s", F.lit(0)).repartitionByRange("hour", "s"), "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def test_a_store_of_the_older_layout_says_so(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), FEW)
    store.log.commit(1, {"hours": {"hourly": {}}, "schemas": {}, "batches": [[0, 0]]})
    for use in (lambda: store.rows("hourly"), lambda: store.merge(requests(spark, 1), 1)):
        with pytest.raises(ValueError, match="build it again"):
            use()


def test_a_batch_is_read_once_for_all_tables(spark, tmp_path):
    seen, cached = spark.sparkContext.accumulator(0), spark.sparkContext._jsc.getPersistentRDDs().size()

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    logs, store = requests(spark, 48), RollupStore(spark, str(tmp_path), FEW)
    rows = logs.mapInArrow(counted, logs.schema)
    store.merge(rows, 0)
    assert seen.value == 50 and sum(counts(store).values()) == 50
    store.merge(rows, 1)
    assert seen.value == 100 and sum(counts(store).values()) == 100
    store.replace(rows, store.hours())
    assert seen.value == 150 and sum(counts(store).values()) == 50
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_hours_that_only_some_tables_have(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path), {"hourly": TABLES["hourly"], "errors": TABLES["errors"]})
    rows = requests(spark, 10)
    store.merge(rows.withColumn("status_code", F.when(F.col("req_id") % 2 == 0, 500).otherwise(F.col("status_code"))), 0)
    store.merge(rows.where("status_code = 200"), 1)
    hours = store.log.newest()[1]["hours"]
    assert len(hours["hourly"]) == 11 and sorted(hours["errors"]) == ["2023123100", "2023123102", "2023123104", "2023123106", "2023123108", "none"]
    assert sum(counts(store, "errors").values()) == 6


def test_half_minutes(spark):
    found = spark.sql("""SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.999999' AS request_timestamp UNION ALL SELECT TIMESTAMP_NTZ '2024-02-29 00:00:29.999999'
        UNION ALL SELECT TIMESTAMP_NTZ '2024-03-31 02:30:30' UNION ALL SELECT NULL""").select(half_minute().cast("string").alias("t"))
    assert {r.t for r in found.collect()} == {"1969-12-31 23:59:30", "2024-02-29 00:00:00", "2024-03-31 02:30:30", None}
