"""Ingest round trips: rows are rendered as the source holds them, damaged here and there, and parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.functions import weblog
from edgeloom.functions.exprs import TS
from edgeloom.operators import quality
from edgeloom.operators.enrich import from_cdn_layout
from edgeloom.sources import bundles, cdn, messages, schemas


def _every(n: int, damaged, line: str):
    return F.when(F.col("req_id") % n == 0, damaged).otherwise(F.col(line))


def _cdn(t):
    lines = cdn.to_cdn_line(t.logs).withColumn("req_id", F.col("reqId").cast("long"))
    broken = F.regexp_replace("line", "^1 123456 ", "1 not-a-number ")
    return cdn.split_malformed(cdn.parse_lines(lines.select("req_id", _every(50, broken, "line").alias("value"))))


def cdn_parsed(t):
    good = from_cdn_layout(_cdn(t)[0])
    return good.select("req_id", TS, "cli_ip", "status_code", "req_path", "user_agent", "bytes", "turn_around_time_ms", "country", "error_code", "ew_execution_info")


def cdn_split(t):
    """Rows kept and lines quarantined, each counted on its own."""
    good, bad = (d.agg(F.count(F.lit(1)).alias("lines")) for d in _cdn(t))
    return good.withColumn("part", F.lit("good")).unionByName(bad.withColumn("part", F.lit("quarantine")))


def cdn_fields(t):
    """Columns of a reader schema built from a JSON spec, read from the same lines."""
    spec = {"fields": [{"name": f.name, "type": {"int": "integer", "bigint": "long"}.get(f.dataType.simpleString(), "string")} for f in schemas.cdn_schema().fields]}
    lines = cdn.to_cdn_line(t.logs).select(F.col("line").alias("value"))
    parsed = cdn.parse_lines(lines, schemas.schema_from_spec(spec))
    return parsed.groupBy("statusCode", "cacheStatus").agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("bytes"), F.countDistinct("reqId").alias("ids"))


def _messages(t):
    rows = t.logs.select(
        "req_id", F.date_format(F.col(TS).cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.col("cli_ip").alias("ip"),
        F.col("req_method").alias("method"), F.col("req_path").alias("endpoint"), F.col("status_code").alias("status"),
        (F.col("ttfb_ms") / 1000.0).alias("response_time"), "user_agent",
    )
    sent = messages.encode_json(rows, key="req_id").withColumn("req_id", F.col("key").cast("long"))
    return messages.decode_json(sent.select(_every(70, F.lit("{not json").cast("binary"), "value").alias("value")))


def queue_decoded(t):
    good, _ = _messages(t)
    return good.groupBy("endpoint", "method", "status").agg(
        F.count(F.lit(1)).alias("messages"), F.round(F.sum("response_time"), 3).alias("response_time"), F.max("event_timestamp").alias("newest")
    )


def queue_split(t):
    good, bad = (d.agg(F.count(F.lit(1)).alias("messages")) for d in _messages(t))
    return good.withColumn("part", F.lit("decoded")).unionByName(bad.withColumn("part", F.lit("rejected")))


#: Requests in one bundle, about.
BUNDLE = 10_000


def bundle_logs(t):
    """Bundles of one visitor and day, several for a visitor with over ``BUNDLE`` requests: JSON lists for odd visitors, lines for even ones."""
    log = F.struct("req_id", "req_path")
    rows = t.logs.select("user_id", F.to_date(TS).alias("day"), "req_id", "req_path")
    busy = rows.groupBy(F.col("user_id").alias("visitor"), F.col("day").alias("date")).agg(F.ceil(F.count(F.lit(1)) / BUNDLE).alias("n")).where("n > 1")
    dealt = rows.join(busy, F.col("user_id").eqNullSafe(F.col("visitor")) & F.col("day").eqNullSafe(F.col("date")), "left")
    slot = F.pmod(F.xxhash64("req_id", "req_path"), F.coalesce("n", F.lit(1)))
    own = dealt.groupBy("user_id", "day", slot.alias("slot")).agg(F.sort_array(F.collect_list(log)).alias("logs"))
    lists = F.to_json("logs")
    lines = F.array_join(F.transform("logs", lambda x: F.concat(x["req_id"].cast("string"), F.lit(" "), x["req_path"])), "\n\n")
    bodies = own.select("user_id", F.when(F.col("user_id") % 2 == 1, lists).otherwise(lines).alias("body"))
    return bundles.parse_bundles(bodies).select("user_id", "log", "format")


def _lines(t):
    rendered = t.logs.select("req_id", "user_id", weblog.combined_line().alias("line"))
    return rendered.select("req_id", "user_id", _every(60, F.lit("garbage in the log"), "line").alias("line"))


def combined_parsed(t):
    parsed, _ = weblog.parse_access_log(_lines(t).drop("user_id"))
    return parsed.select(
        "req_id", "ip", "method", "endpoint", "status", "size", "response_time", "region", "user_id", "session_id",
        F.element_at("custom_fields", "plan").alias("plan"), F.size("custom_fields").alias("custom"), "schema_version", "event_timestamp",
    )


def combined_rejected(t):
    return weblog.parse_access_log(_lines(t).drop("user_id"))[1].select("req_id", "line", "error")


def line_versions(t):
    lines = _lines(t)
    return lines.groupBy(weblog.detect_schema_version("line").alias("version"), weblog.is_valid_line("line").alias("valid")).agg(F.count(F.lit(1)).alias("lines"))


def missing_fields(t):
    """First missing field of rows whose fields are blanked in turn."""
    rows = t.logs.select(
        "req_id", F.when(F.col("req_id") % 11 != 0, F.col("cli_ip")).alias("ip"), F.when(F.col("req_id") % 13 != 0, F.col(TS).cast("string")).otherwise("").alias("timestamp"),
        F.when(F.col("req_id") % 17 != 0, F.col("req_path")).alias("endpoint"),
    )
    good, bad = weblog.require_fields(rows)
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("rows")).unionByName(good.groupBy(F.lit("none").alias("error")).agg(F.count(F.lit(1)).alias("rows")))


def retyped_fields(t):
    """Status codes that became text, and a field that moved into nested JSON."""
    status = F.when(F.col("req_id") % 2 == 0, F.concat(F.col("status_code").cast("string"), F.lit(" OK"))).otherwise(F.col("status_code").cast("string"))
    line = F.concat(F.lit("geo="), F.to_json(F.struct("country", "city")), F.lit(" end"))
    return t.logs.select("req_id", weblog.tolerant_status(status).alias("status"), weblog.nested_json_field(line, "geo", "$.country").alias("country"))


def parse_failures(t):
    return quality.parse_failure_rate(*weblog.parse_access_log(_lines(t).drop("user_id")))


def version_mix(t):
    return quality.schema_version_mix(weblog.parse_access_log(_lines(t).drop("user_id"))[0])


QUERIES = {
    "cdn_lines_parsed": cdn_parsed,
    "cdn_lines_split": cdn_split,
    "cdn_schema_from_spec": cdn_fields,
    "queue_json_decoded": queue_decoded,
    "queue_json_split": queue_split,
    "bundle_logs": bundle_logs,
    "combined_lines_parsed": combined_parsed,
    "combined_lines_rejected": combined_rejected,
    "line_versions": line_versions,
    "missing_fields": missing_fields,
    "retyped_fields": retyped_fields,
    "parse_failure_rate": parse_failures,
    "schema_version_mix": version_mix,
}
