"""What must and must not be in the plans."""

import datetime as dt

import pytest

from edgeloom import catalog
from edgeloom.context import LogTables

ENTRIES = catalog.registered()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["current_rps", "biz_total_requests", "point_lookup", "filter_relative_window", "noc_now", "slowest_paths", "evaluate_alerts"])
def test_the_clock_is_a_literal_that_reaches_the_scan(spark, small, name):
    for as_of in (None, dt.datetime(2024, 1, 15)):
        text = plan(catalog.runnable(ENTRIES[name])(spark, small, as_of))
        scans = [line for line in text.split("\n") if "FileScan" in line and "ts#" in line.split("DataFilters")[0]]
        assert scans and all("GreaterThan" in line.split("PushedFilters")[1] for line in scans), text
        assert "max(ts" not in text or name == "evaluate_alerts"  # job tables keep their newest row


def test_newest_request_is_found_by_looking_back(spark, small):
    tables = LogTables(spark, small)
    assert tables._newest == str(tables.table("events").agg({"ts": "max"}).first()[0])
    assert LogTables(spark, small).after(tables.as_of).table("events").count() == 1


def test_alerts_read_each_table_once(spark, small):
    assert plan(catalog.runnable(ENTRIES["evaluate_alerts"])(spark, small)).split("== Initial Plan ==")[0].count("FileScan") <= 16


def test_security_events_rank_without_a_second_shuffle_of_the_log(spark, small):
    df = catalog.runnable(ENTRIES["security_events"])(spark, small)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert "WindowGroupLimit" in text and text.count("FileScan") == 1
