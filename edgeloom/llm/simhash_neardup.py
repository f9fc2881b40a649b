"""SimHash near-duplicates found by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.components import connected
from edgeloom.llm.storage import keep_marked, staged
from edgeloom.operators.skew import join_split_hot

BITS = 64
PIECE_BYTES = 1 << 22


def _shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each word shingle, in blocks; the last words of a block lead the next."""
    raw = text.encode("utf-8", "surrogatepass")
    carry: list[bytes] = []
    start, any_hash = 0, False
    while start < len(raw):
        end = min(start + PIECE_BYTES, len(raw))
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        words = carry + raw[start:end].lower().split()  # bytes: A-Z only, ASCII white space only
        start = end
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends - [len(w) + 1 for w in words])[: len(words) - shingle + 1].tolist()
            stops = (ends[shingle - 1 :] - 1).tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[i:j], 42) for i, j in zip(starts, stops)], dtype=np.uint64)
            any_hash = True
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if not any_hash and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), 42)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half the shingle hashes, as a signed 64-bit number; 0 without words."""
    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in _shingle_hashes(text or "", shingle):
        total += len(hashes)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_of(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a column expression."""

    @F.pandas_udf(T.LongType())
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash(text.cast("string"))


def _ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` ones among the low ``width`` bits."""
    return [sum(1 << i for i in ones) for r in range(radius + 1) for ones in combinations(range(width), r)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _mask_rows(masks: list[int], top: bool = False) -> Column:
    """An array literal of masks; with ``top``, each beside its highest bit."""
    if not top:
        return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    high = [1 << (m.bit_length() - 1) if m else 0 for m in masks]
    return F.array(*[F.struct(F.lit(_signed(m)).cast("long").alias("m"), F.lit(_signed(h)).cast("long").alias("h")) for m, h in zip(masks, high)])


def hamming_links(prints: DataFrame, max_bits: int = 2, segments: int = 2, bucket_rows: int = 256) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints within ``max_bits`` of each other.

    ``prints`` has one column of distinct fingerprints. Cut into ``segments``, two such
    fingerprints differ by at most ``max_bits // segments`` bits in one of the first
    segments or by one bit less in one of the others. So each fingerprint asks the table of each
    segment for every value of that small Hamming ball, and the full distance of each match
    is verified. A pair is asked for from one side only: the one whose highest flipped bit is 0.

    A segment value that more than ``bucket_rows`` fingerprints share would make candidates
    with the square of that number. Fingerprints that meet such a value are compared by the
    one table of full width instead, balls of half the distance on both sides: each names its
    ball's points, and at a point those of the smaller radius are linked with everything
    there, for which the smallest of them stands. That needs no candidates at all; it keeps
    the components, not each single pair. Both ways are exact.
    """
    f = prints.columns[0]
    prints = prints.select(F.col(f).alias("f"))
    width = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    shift = [sum(width[:i]) for i in range(segments)]
    radius, rest = divmod(max_bits, segments)
    tables, asks = [], []
    for i in range(segments):
        ball = radius if i <= rest else radius - 1
        if ball < 0:
            continue
        value = F.shiftrightunsigned("f", shift[i]).bitwiseAND(F.lit(_signed((1 << width[i]) - 1)))
        tables.append(prints.select(F.lit(i).alias("t"), value.alias("key"), "f"))
        probe = prints.select("f", value.alias("value"), F.explode(_mask_rows(_ball(width[i], ball), top=True)).alias("x"))
        probe = probe.where(F.col("value").bitwiseAND(F.col("x.h")) == 0)
        asks.append(probe.select(F.lit(i).alias("t"), F.col("value").bitwiseXOR(F.col("x.m")).alias("key"), F.col("f").alias("g"), (F.col("x.m") == 0).alias("same")))
    store, probes = tables[0], asks[0]
    for x, y in zip(tables[1:], asks[1:]):
        store, probes = store.union(x), probes.union(y)

    hot = staged(store.groupBy("t", "key").count().where(F.col("count") > bucket_rows).select("t", "key"), "hot-buckets")
    none = hot.isEmpty()
    cold = store if none else store.join(hot, ["t", "key"], "left_anti")
    links = (
        probes.join(cold, ["t", "key"])
        .where(~F.col("same") | (F.col("g") < F.col("f")))
        .where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))).between(1, max_bits))
        .select(F.col("g").alias("a"), F.col("f").alias("b"))
    )
    if none:
        return links
    met = store.select("t", "key", "f").union(probes.select("t", "key", "g")).join(hot, ["t", "key"], "left_semi").select("f").distinct()
    return links.union(_meet_in_the_middle(staged(met, "hot-prints"), max_bits))


def _meet_in_the_middle(prints: DataFrame, max_bits: int) -> DataFrame:
    near, far = max_bits // 2, (max_bits + 1) // 2
    points = prints.select("f", F.explode(_mask_rows(_ball(BITS, far))).alias("m")).select(F.col("f").bitwiseXOR(F.col("m")).alias("z"), "f", (F.bit_count("m") <= near).alias("inner"))
    centre = points.groupBy("z").agg(F.min(F.when(F.col("inner"), F.col("f"))).alias("low"), F.count(F.lit(1)).alias("n"))
    centre = centre.where((F.col("n") > 1) & F.col("low").isNotNull()).select("z", "low")
    return points.join(centre, "z").where("f != low").select(F.col("low").alias("a"), F.col("f").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, bucket_rows: int = 256
) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over fingerprints that differ in at most
    ``max_bits`` bits.

    Only ids and fingerprints are shuffled, after one pass over the texts; equal
    fingerprints count once in the search. Null and empty texts, and texts without a word,
    have fingerprint zero and are linked like any other. A null id never is a component's
    smallest; a component of null ids alone has component_id null. Repeated rows give
    repeated results, an empty table gives none, other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint_of(F.col(f"`{text_col}`"), shingle).alias("f"))
    return _labelled(staged(rows, "simhash"), max_bits, bucket_rows).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id"
    )


def _labelled(rows: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """``rows`` (id, f, ...) with ``component_id``, the least id of each component."""
    prints = staged(rows.groupBy("f").agg(F.min("id").alias("least")), "prints")
    joined = connected(hamming_links(prints.select("f"), max_bits, bucket_rows=bucket_rows))
    grouped = joined.join(prints, joined.node == prints.f).select("f", "root", "least")
    lowest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = grouped.join(lowest, "root").select("f", "component_id")
    label = prints.join(linked.withColumn("found", F.lit(True)), "f", "left").select(
        "f", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")
    )
    # a print that many rows share is spread over tasks
    return join_split_hot(rows, label, ["f"], "id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: smallest id (null last), then smallest text
    digest. Columns are unchanged; of wholly repeated rows one stays."""
    text = F.col(f"`{text_col}`")
    sha = F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), sha.alias("sha"), fingerprint_of(text, shingle).alias("f"))
    rows = staged(rows, "simhash")
    numbered = rows.groupBy("f").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "sha")).alias("id"))
    best = _labelled(numbered, max_bits, 256).groupBy("component_id").agg(F.lit(1)).select("component_id.*")
    return keep_marked(docs, _row_key(F.col(f"`{id_col}`"), sha), best.select(_row_key(F.col("id"), F.col("sha"))), F.struct(text.isNull(), text))


def _row_key(ident: Column, sha: Column) -> Column:
    return F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), sha)
