"""Declared schemas. All reading is schema-on-read with nullable fields."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# --- fixed values: the published delivery-log layout, in file order --------------------
CDN_FIELDS = """
version string, cp integer, reqId string, reqTimeSec long, streamId integer, edgeAttempts integer,
deliveryPolicyReqStatus integer, deliveryPolicyId integer, arlid integer, bytes long, cliIP string,
statusCode integer, proto string, reqHost string, reqMethod string, reqPath string, reqPort integer,
rspContentLen long, rspContentType string, UA string, tlsOverheadTimeMSec integer, tlsVersion string,
objSize long, uncompressedSize long, overheadBytes long, queryStr string, totalBytes long,
fileSizeBucket string, downloadInitiated integer, downloadsCompleted integer, edgeIPBinding integer,
tlsEarlyData integer, accLang string, cookie string, range string, referer string,
xForwardedFor string, maxAgeSec integer, reqEndTimeMSec long, turnAroundTimeMSec long,
transferTimeMSec long, errorCode string, dnsLookupTimeMSec integer, lastByte integer, asn integer,
timeToFirstByte long, startupError integer, downloadTime long, throughput long,
prefetchMidgressHits integer, cacheStatus integer, breadcrumbs string, cacheable integer,
country string, city string, state string, edgeIP string, serverCountry string,
billingRegion integer, securityRules string, ewUsageInfo string, ewExecutionInfo string,
cmcd string, deliveryType integer, deliveryFormat integer, mediaEncryption integer,
contentProtectionInfo string, customField string
"""
# --- fixed values: web-log schemas of the stream ---------------------------------------
WEBLOG_V0 = (
    "timestamp STRING, ip STRING, method STRING, endpoint STRING, status INT, "
    "response_time DOUBLE, user_agent STRING"
)
WEBLOG_ENTRY = (
    "ip STRING, timestamp STRING, method STRING, endpoint STRING, status INT, size INT, referer STRING, "
    "user_agent STRING, response_time DOUBLE, request_id STRING, ingestion_timestamp STRING"
)
WEBLOG_V1 = (
    "ip STRING, timestamp STRING, method STRING, endpoint STRING, status INT, size INT, referer STRING, "
    "user_agent STRING, response_time DOUBLE"
)
WEBLOG_V2 = WEBLOG_V1 + ", region STRING, user_id STRING, session_id STRING, request_id STRING"
WEBLOG_UNION = (
    WEBLOG_V1 + ", schema_version INT, region STRING, user_id STRING, session_id STRING, "
    "request_id STRING, custom_fields MAP<STRING, STRING>"
)
PROMOTED_FIELDS = ["region", "user_id", "session_id", "request_id"]
# --------------------------------------------------------------------------------------

CORRUPT = "_corrupt_record"
_TYPES = {"string": T.StringType(), "integer": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType()}


def schema_from_spec(spec: str | dict) -> T.StructType:
    """Reader schema from a JSON spec ``{"fields": [{"name", "type"}, ...]}``."""
    fields = (json.loads(spec) if isinstance(spec, str) else spec)["fields"]
    return T.StructType([T.StructField(f["name"], _TYPES[f["type"]], True) for f in fields])


def cdn_schema() -> T.StructType:
    return T.StructType.fromDDL(CDN_FIELDS)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


# Widenings that keep old files readable: fixed values.
_SAFE_CASTS = {("int", "bigint"), ("float", "double")}


def evolution_problems(old: T.StructType, new: T.StructType) -> list[str]:
    """Changes from ``old`` to ``new`` that would break readers; empty when additive."""
    now = {f.name: f for f in new.fields}
    problems = []
    for field in old.fields:
        other = now.get(field.name)
        if other is None:
            problems.append(f"removed: {field.name}")
            continue
        a, b = field.dataType.simpleString(), other.dataType.simpleString()
        if a != b and (a, b) not in _SAFE_CASTS:
            problems.append(f"retyped: {field.name} {a} -> {b}")
        if field.nullable and not other.nullable:
            problems.append(f"made required: {field.name}")
    known = {f.name for f in old.fields}
    problems += [f"required field added: {f.name}" for f in new.fields if f.name not in known and not f.nullable]
    return problems
