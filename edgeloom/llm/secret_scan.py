"""Secrets in text, told apart by how many owners and repositories hold the same value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.storage import staged

#: Fixed values. Kinds in the order in which spans of equal start are listed: pattern, group
#: with the value, least characters of that group. The first three always count.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # runs of hex digits; shorter ones fail in any case
}
#: Candidates that count only while few owners hold them.
OWNED = {
    "pem": (r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    "prefixed": (r"(?:ghp|gho|ghs|xoxb|xoxp|sk_live|rk_live)_?-?[A-Za-z0-9-]{16,}", 0, 0),
}
SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string>"


#: Matches that are numbered together.
CHUNK = 256


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` worked out once, however often ``of`` uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def spans_of(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind, leftmost and non-overlapping, in code points. The text split at the
    matches gives what lies between them, so a match starts after all gaps and matches before it. Matches are
    numbered in chunks, each from the length of the chunks before it: a list grows by copying,
    and so no list grows longer than a chunk, or than the number of chunks."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))

    def end_of(at: Column, x: Column) -> Column:
        return at + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))

    def step(done: Column, x: Column) -> Column:
        start, end = done["at"] + F.length(x["gap"]), end_of(done["at"], x)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(done["out"], F.array(span))).otherwise(done["out"]).alias("out"))

    def inside(chunk: Column, begin: Column) -> Column:
        begun = F.struct(begin.alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.aggregate(chunk, begun, step, lambda done: done["out"])

    def begins(chunks: Column) -> Column:
        def next_begin(done: Column, chunk: Column) -> Column:
            return F.struct(F.aggregate(chunk, done["at"], end_of).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out"))

        return F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), next_begin, lambda done: done["out"])

    def chunks(steps: Column) -> Column:
        numbers = F.sequence(F.lit(0), ((F.size(steps) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)))

    found = _bound(_bound(steps, chunks), lambda c: F.flatten(F.zip_with(c, begins(c), inside)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start and then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) over all rows of (hash, owner, repository). Each
    step counts distinct rows, combined before its shuffle, so a value in a third of all documents
    is one row per task; no list of owners is ever gathered. A null owner or repository counts as one."""
    distinct = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = distinct.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang"),
    max_owners: int = 2, max_repositories: int = 4,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``spans``, ``n_live`` and ``n_copied``.

    Spans of the base kinds stand whoever holds them. The hash of each candidate's value is
    counted over the whole corpus by distinct owners and repositories. A value of at most ``max_owners``
    owners and ``max_repositories`` repositories looks like a live credential of these
    owners (``n_live``); others are widely copied examples (``n_copied``). Candidates of the
    further kinds become spans only if they look live. Where ``docs`` lacks the owner or a
    repository column, that part counts as null.

    Texts are read once; what follows works on the found spans, written with a row
    number each. Null texts count as empty; empty texts have no spans; repeated rows and null ids
    give a row each; an empty table gives none; other columns are not read.
    """
    def column(name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in docs.columns else F.lit(None).cast("string")

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kinds = {**BASE, **OWNED}
    spans = [spans_of(F.col("text"), kind, rank, *rule) for rank, (kind, rule) in enumerate(kinds.items())]
    repository = F.concat_ws("\u001f", *(F.coalesce(column(c), F.lit("")) for c in repository_cols))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), column(owner_col).alias("owner"), repository.alias("repository"), text.alias("text"))
    rows = rows.select("id", "owner", "repository", F.concat(*spans[: len(BASE)]).alias("base"), F.concat(*spans[len(BASE) :]).alias("more"))
    rows = staged(rows.withColumn("number", F.monotonically_increasing_id()), "secrets")

    found = rows.where((F.size("base") > 0) | (F.size("more") > 0))
    each = found.select("number", "owner", "repository", F.explode(F.concat("base", "more")).alias("span"))
    each = each.withColumn("hash", F.sha2("span.value", 256))
    counted = ownership(each)
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    judged = each.join(counted, "hash").select("number", F.col("span"), live.alias("live"))
    per_row = judged.groupBy("number").agg(
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_copied"),
        F.collect_list(F.when(F.col("live") & (F.col("span.rank") >= len(BASE)), F.col("span"))).alias("owned"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    full = rows.join(per_row, "number", "left")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return full.select(
        F.col("id").alias(id_col),
        *(count(kind) for kind in BASE),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", F.coalesce("owned", none))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
