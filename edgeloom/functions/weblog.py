"""Combined-log lines: parsing, version detection, validation, tolerance.

A line is matched once: the pattern rewrites it into its groups joined by a separator
that log text never holds, and the pieces are split apart. A line that does not match
stays as it was and yields too few pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.sources.schemas import PROMOTED_FIELDS

# --- fixed values: line formats ---------------------------------------------------------
BASE_PATTERN = (
    r'^(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+).*?" (\d{3}) (\d+) "([^"]*)" "([^"]*)" ([\d.]+)'
)
SHORT_PATTERN = r'^(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+).*?" (\d{3}) (\d+)'
VALID_PATTERN = r'^\S+ \S+ \S+ \[[\w:/]+\s[+\-]\d{4}\] ".+" \d{3} \d+'
PAIR_PATTERN = r"(\w+)=([\w\-]+)"
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
BASE_FIELDS = ["ip", "timestamp", "method", "endpoint", "status", "size", "referer", "user_agent", "response_time"]
V1_TOKENS = 9
REJECTED = "Invalid log format"
# --------------------------------------------------------------------------------------

_SEP = "\u0001"
_FIELD_TYPES = {"status": "int", "size": "int", "response_time": "double"}


def _pieces(line: Column, pattern: str, groups: int) -> Column:
    """Array of the groups and the rest of the line; a single piece when unmatched."""
    joined = _SEP.join(f"${i}" for i in range(1, groups + 2))
    return F.split(F.regexp_replace(line, f"{pattern}(.*)$", joined), _SEP)


def pairs_map(text: Column) -> Column:
    """``k=v`` pairs of a text as a map; of a repeated key the last value counts."""
    keys = F.regexp_extract_all(text, F.lit(PAIR_PATTERN), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(PAIR_PATTERN), F.lit(2))
    entries = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), e["k"]),
    )
    return F.map_from_arrays(F.transform(last, lambda e: e["k"]), F.transform(last, lambda e: e["v"]))


def detect_schema_version(line: Column | str) -> Column:
    """2 with a region or user id, 1 with enough tokens, else 0."""
    line = F.col(line) if isinstance(line, str) else line
    extended = line.contains("region=") | line.contains("user_id=")
    enough = F.size(F.split(F.rtrim(line), " ")) >= V1_TOKENS
    return F.when(extended, 2).when(enough, 1).otherwise(0)


def is_valid_line(line: Column | str) -> Column:
    """Cheap acceptance test of a line, before parsing."""
    line = F.col(line) if isinstance(line, str) else line
    return F.coalesce(line.rlike(VALID_PATTERN), F.lit(False))


def parse_access_log(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected lines). Known trailing keys become columns, the rest stay in
    ``custom_fields``. Other input columns are carried along."""
    groups = len(BASE_FIELDS)
    # A generator keeps filters above it: pushed below, they would match each line again per field.
    staged = lines.withColumn("_p", F.explode(F.array(_pieces(F.col(line), BASE_PATTERN, groups))))
    fields = {
        name: F.get("_p", F.lit(i)).try_cast(_FIELD_TYPES.get(name, "string")) for i, name in enumerate(BASE_FIELDS)
    }
    staged = staged.withColumns({**fields, "_rest": F.get("_p", F.lit(groups))})
    ok = (F.size("_p") == groups + 1) & F.col("status").isNotNull() & F.col("size").isNotNull() & F.col(
        "response_time"
    ).isNotNull()
    # NULL lines are rejected, not lost.
    ok = F.coalesce(ok, F.lit(False))
    rejected = staged.filter(~ok).select(*lines.columns, F.lit(REJECTED).alias("error"))
    kept = staged.filter(ok).withColumn("_kv", pairs_map(F.col("_rest")))
    promoted = {name: F.try_element_at("_kv", F.lit(name)) for name in PROMOTED_FIELDS}
    parsed = kept.withColumns(
        {
            **promoted,
            "custom_fields": F.map_filter("_kv", lambda k, _: ~k.isin(PROMOTED_FIELDS)),
            "schema_version": detect_schema_version(line),
            "event_timestamp": F.try_to_timestamp("timestamp", F.lit(TIME_FORMAT)),
        }
    )
    carried = [c for c in lines.columns if c != line]
    return (
        parsed.select(
            *carried, *BASE_FIELDS, *PROMOTED_FIELDS, "custom_fields", "schema_version", "event_timestamp"
        ),
        rejected,
    )


def parse_short(lines: DataFrame, line: str = "line") -> DataFrame:
    """The six leading fields only; NULLs where the line does not match."""
    names = BASE_FIELDS[:6]
    staged = lines.withColumn("_p", _pieces(F.col(line), SHORT_PATTERN, len(names)))
    matched = F.size("_p") == len(names) + 1
    return staged.select(
        *lines.columns,
        *[
            F.when(matched, F.get("_p", F.lit(i)).try_cast(_FIELD_TYPES.get(n, "string"))).alias(n)
            for i, n in enumerate(names)
        ],
    )


def require_fields(rows: DataFrame, required: list[str] = ("ip", "timestamp", "endpoint")) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejected rows with the first missing field as ``error``)."""
    missing = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"{c} is required")) for c in required]
    flagged = rows.withColumn("error", F.coalesce(*missing))
    return flagged.filter(F.col("error").isNull()).drop("error"), flagged.filter(F.col("error").isNotNull())


def tolerant_status(text: Column | str) -> Column:
    """The status code of ``200`` as well as of ``"200 OK"``."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(text, r'^\s*"?(\d{3})', 1).try_cast("int")


def nested_json_field(line: Column | str, name: str, path: str) -> Column:
    """A value inside ``name={...}`` of a line."""
    line = F.col(line) if isinstance(line, str) else line
    return F.get_json_object(F.regexp_extract(line, rf"\b{name}=(\{{.*?\}})", 1), path)


def combined_line() -> Column:
    """Render a canonical log row as a combined-log line with trailing pairs for some."""
    ms = F.coalesce(F.col("turn_around_time_ms") + F.col("transfer_time_ms"), F.lit(0))
    when = F.date_format(F.col("request_timestamp").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss")
    base = F.concat(
        F.col("cli_ip"), F.lit(" - - ["), when, F.lit(' +0000] "'), F.col("req_method"), F.lit(" "), F.col("req_path"),
        F.lit(' HTTP/1.1" '), F.col("status_code"), F.lit(" "), F.col("bytes"), F.lit(' "-" "'), F.col("user_agent"),
        F.lit('" '), (ms / F.lit(1000.0)).cast("string"),
    )
    extra = F.concat(
        F.lit(" region="), F.col("country"), F.lit(" user_id="), F.col("user_id"), F.lit(" session_id="),
        F.col("session_id"), F.lit(" plan=free plan=p"), F.col("user_id") % 4,
    )
    return F.when(F.col("user_id") % 3 == 0, F.concat(base, extra)).otherwise(base)
