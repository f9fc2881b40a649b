"""Joins: dimensions, address ranges, roll-ups, baselines, already-loaded rows.

The optimizer broadcasts a side whose measured size is under its threshold, and splits
skewed partitions of a sort-merge join otherwise; joins of raw rows spread hot keys first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from edgeloom.functions.exprs import TS, hour_floor, instant, n_where, span
from edgeloom.operators.skew import join_split_hot


def enrich_from(df: DataFrame, dimension: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a keyed dimension; unmatched rows keep NULLs."""
    return df.join(dimension, on, "left")


OCTET = r"(25[0-5]|2[0-4]\d|[01]?\d?\d)"


def ip_to_long(ip: Column | str) -> Column:
    """Dotted IPv4 as a number; NULL for anything else."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    valid = ip.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$")
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("long"), lambda n, octet: n * 256 + octet.try_cast("long"))
    return F.when(valid, number)


BLOCK_BITS = 16


def _prefix(number: Column) -> Column:
    """The first ``bits`` of a 32-bit number."""
    return F.call_function("shiftrightunsigned", number, F.lit(32) - F.col("bits"))


def _filed(ranges: DataFrame) -> DataFrame:
    """Ranges under the longest prefix length, in steps of four bits, whose block is at least as wide: under two prefixes at most."""
    width = F.col("last_ip") - F.col("first_ip") + 1
    needed = F.when(width <= 1, F.lit(0)).otherwise(F.length(F.bin(width - 1)))
    bits = (F.lit(32) - F.ceil(needed / 4) * 4).cast("int")
    ends = F.array(*(_prefix(F.col(c).cast("long")) for c in ("first_ip", "last_ip")))
    return ranges.withColumn("bits", bits).withColumn("prefix", F.explode(F.array_distinct(ends)))


def narrowest_at(points: DataFrame, ranges: DataFrame, label: str) -> DataFrame:
    """(n, ``label`` of the narrowest range that holds n) for each number; NULL where none does. Numbers and ranges meet on a prefix,
    not on inequalities, and a number asks only the lengths that some range has."""
    filed = _filed(ranges)
    lengths = filed.agg(F.collect_set("bits")).scalar()
    probes = points.withColumn("bits", F.explode(lengths)).withColumn("prefix", _prefix(F.col("n")))
    inside = F.col("n").between(F.col("first_ip"), F.col("last_ip"))
    held = probes.join(filed, ["bits", "prefix"]).filter(inside).groupBy("n").agg(
        F.min_by(F.struct(F.col(label)), F.struct(F.col("last_ip") - F.col("first_ip"), "first_ip")).alias("held")
    )
    return points.join(held, "n", "left").select("n", F.col(f"held.{label}").alias(label))


def ip_range_lookup(logs: DataFrame, ranges: DataFrame, ip: str = "cli_ip", label: str = "geo", row_id: str = "req_id") -> DataFrame:
    """Attach the label of the narrowest range (``first_ip``..``last_ip``) holding the address.

    Nested and overlapping ranges become one flat line first: between two neighbouring bounds of ranges the
    narrowest range is the same, so it is looked up once per bound. Addresses are then swept along with the bounds, in order:
    each takes what the last bound before it says. The line is cut in blocks of 65,536 addresses, which
    many tasks sweep; a block holds no more distinct addresses and bounds than that. Distinct addresses
    are looked up, not requests, and the label is joined back with hot addresses spread out.
    """
    block = F.shiftrightunsigned("n", BLOCK_BITS)
    addresses = logs.select(ip).distinct().withColumn("n", ip_to_long(ip)).filter(F.col("n").isNotNull())
    firsts = addresses.select(F.shiftleft(block, BLOCK_BITS).alias("n"))
    bounds = ranges.select(F.explode(F.array(F.col("first_ip").cast("long"), F.col("last_ip").cast("long") + 1)).alias("n"))
    points = narrowest_at(firsts.union(bounds).distinct(), ranges, label)
    bound = points.select("n", F.lit(0).alias("is_address"), F.struct(label).alias("says"), F.lit(None).cast("string").alias(ip))
    asked = addresses.select("n", F.lit(1).alias("is_address"), F.lit(None).cast(bound.schema["says"].dataType).alias("says"), ip)
    along = Window.partitionBy(block).orderBy("n", "is_address")
    swept = bound.unionByName(asked).withColumn("says", F.last("says", ignorenulls=True).over(along)).filter(F.col("is_address") == 1)
    return join_split_hot(logs, swept.select(ip, F.col(f"says.{label}").alias(label)), [ip], row_id)


def against_hourly(logs: DataFrame, hourly_country: DataFrame, row_id: str = "req_id") -> DataFrame:
    """Each request next to the roll-up row of its hour and country; busy hours are spread out."""
    keyed = logs.withColumn("hour", hour_floor(TS))
    side = hourly_country.select("hour", "country", "request_count", "avg_ttfb")
    return join_split_hot(keyed, side, ["hour", "country"], row_id)


def only_new(
    incoming: DataFrame, loaded: DataFrame, keys: list[str], ts: str = TS, tie_break: tuple[str, ...] = (), same_time: bool = False
) -> DataFrame:
    """First row of each key that is not loaded yet, as ``INSERT IGNORE`` keeps it: the key alone decides.

    Repeats within the batch go first: the one that is least in ``ts`` and then in
    ``tie_break`` stays, and the limit to one row per key is planned in the map tasks
    too. Of ``loaded`` the keys alone are read, of all its rows: a key may be sent again with another time. Only a caller who
    knows that it never is (``same_time``) has ``loaded`` cut to the batch's time range, a literal that prunes its
    scan. Where batches come often, ``sinks.keyed.SeenKeys`` meets the history without shuffling it.
    """
    first = Window.partitionBy(*keys).orderBy(ts, *tie_break)
    batch = incoming.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")
    if same_time:
        lo, hi = incoming.agg(F.min(ts).cast("string"), F.max(ts).cast("string")).first()
        kind = dict(loaded.dtypes)[ts]
        loaded = loaded.filter(F.col(ts).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
    return batch.join(loaded.select(*keys), keys, "left_anti")


def rate_against_baseline(
    logs: DataFrame, as_of, by: str, now: str = "24 hours", now_hours: float = 24.0,
    history: str = "30 days", history_hours: float = 720.0, factor: float = 10.0,
) -> DataFrame:
    """Requests per hour now against each key's own history, both from one pass."""
    start = instant(as_of) - span(now)
    current = F.col(TS) >= start
    return (
        logs.filter(F.col(TS) >= instant(as_of) - span(history))
        .groupBy(by)
        .agg(
            (n_where(current) / F.lit(now_hours)).alias("current_rate"),
            (n_where(~current) / F.lit(history_hours - now_hours)).alias("baseline_rate"),
        )
        .filter(F.col("current_rate") > F.col("baseline_rate") * factor)
    )


def latency_against_baseline(
    logs: DataFrame, as_of, by: str, now: str = "24 hours", history: str = "30 days", factor: float = 2.0
) -> DataFrame:
    current = F.col(TS) >= instant(as_of) - span(now)
    ms = F.col("turn_around_time_ms") + F.col("transfer_time_ms")
    return (
        logs.filter(F.col(TS) >= instant(as_of) - span(history))
        .groupBy(by)
        .agg(
            F.avg(F.when(current, ms)).alias("current_ms"),
            F.avg(F.when(~current, ms)).alias("baseline_ms"),
        )
        .filter(F.col("current_ms") > F.col("baseline_ms") * factor)
    )


def previous_period(series: DataFrame, time: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Value of the preceding row of a series and the change in percent."""
    order = Window.partitionBy(*(keys or [])).orderBy(time)
    prev = F.lag(value).over(order)
    return series.withColumn("previous", prev).withColumn(
        "change_pct", (F.col(value) - F.col("previous")) * F.lit(100.0) / F.nullif(F.col("previous"), F.lit(0))
    )
