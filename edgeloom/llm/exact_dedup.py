"""Exact deduplication as a stateful stream whose keyed state lives on disk and never expires."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.storage import fresh_path, keep_marked, settings, staged

WHITE_SPACE = " \t\n\v\f\r"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOT_SHARE, SALTS = 1000, 64
#: Values of the digests' hash by which texts without a second one are kept out of the comparison's shuffle.
SLOTS = 1 << 18


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def _with_locator(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_file`` and ``_row``, where the content of each row can be read again."""
    try:
        return docs.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    except AnalysisException:  # not straight from files
        return docs.withColumns({"_file": F.lit(""), "_row": F.monotonically_increasing_id()})


def deduplicate_stream(arrivals: DataFrame, checkpoint: str) -> None:
    """Run a stream of (digest, n, id, file, row) through the keyed state, up to what is
    there now. For each digest the state holds how many rows came and, of the one that
    stays, length, stable identifier and content locator. It is kept by RocksDB on the
    executors' disks and in ``checkpoint``; without a watermark no key is ever dropped, and a
    later run with the same ``checkpoint`` goes on from there. Rows of a digest are combined
    before the shuffle, so a hot one costs a row per task."""
    spark = arrivals.sparkSession
    stays = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("id").isNull().alias("no_id"), "id", "file", "row"))
    state = arrivals.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), stays.alias("stays"))
    rocks = {
        "spark.sql.streaming.stateStore.providerClass": ROCKS,
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many stores with little each
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    }
    with settings(spark, **rocks):
        query = (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def read_state(spark, checkpoint: str) -> DataFrame:
    """What the state holds: digest, group_size and ``stays``."""
    held = spark.read.format("statestore").load(checkpoint)
    return held.select("key.digest", F.col("value.count").alias("group_size"), F.col("value.min").alias("stays"))


def _unequal_bytes(texts: DataFrame, groups: DataFrame, rows: Column) -> DataFrame:
    """Digests under which texts differ in any byte. Only rows of groups of two or more are
    compared: each against the smallest and largest text of its group, partial per task. A group with
    over a thousandth of all rows (there are under a thousand of these) is spread over salts."""
    hits = groups.where("group_size > 1").select("digest", "group_size")
    # At most SLOTS rows, whatever the number of hits: of few hits, hardly another text goes on to the shuffle.
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS)).cast("int").alias("slot")
    texts = texts.withColumn("slot", slot).join(F.broadcast(hits.select(slot).distinct()), "slot", "left_semi").drop("slot")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = F.broadcast(hits.where(F.col("group_size") > total / HOT_SHARE).select("digest", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(rows, F.spark_partition_id()), F.lit(SALTS))).otherwise(F.lit(0))
    texts = texts.join(hot, "digest", "left").withColumn("salt", salt).drop("hot")
    salts = F.when(F.col("hot"), F.sequence(*(F.lit(i).cast("long") for i in (0, SALTS - 1)))).otherwise(F.array(F.lit(0).cast("long")))
    keys = hits.join(hot, "digest", "left").select("digest", F.explode(salts).alias("salt"))
    part = texts.join(keys, ["digest", "salt"]).groupBy("digest", "salt").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    return part.groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_chars: int = 64) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` (of the text without ASCII white space) and ``n`` (code points).

    Equal texts form a group; of these the row with most code points stays, then the one
    with smallest id (null last), then the one stored first. Exactly one row of a group has ``kept``,
    repeated rows included. Null texts count as empty; an empty table gives no rows; other
    columns are not read.

    The texts are read twice. First digest, id, length and locator of each row are written as
    the stream's arrivals, and ``deduplicate_stream`` runs over them. Then texts of each group
    are compared whole; should different ones share a digest (``digest_chars`` shortens it
    for tests), their rows are grouped anew by digest and text.
    """
    spark = docs.sparkSession
    norm, text = normalised(F.col(f"`{text_col}`")), F.col(f"`{text_col}`").cast("string")
    sha = F.sha2(norm, 256)
    located = _with_locator(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    row = [
        F.substring("text_sha256", 1, digest_chars).alias("digest"),
        "text_sha256",
        "n",
        F.col(f"`{id_col}`").alias("id"),
        F.col("_file").alias("file"),
        F.col("_row").alias("row"),
    ]
    size = F.coalesce(F.length(text), F.lit(0)).cast("long")
    arrived, checkpoint = fresh_path(spark, "arrivals"), fresh_path(spark, "dedup-state")
    located.withColumns({"text_sha256": sha, "n": size}).select(*row).write.parquet(arrived)
    arrivals = spark.read.parquet(arrived)
    if arrivals.isEmpty():
        return arrivals.select(F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.col("n").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "n")
    deduplicate_stream(spark.readStream.schema(arrivals.schema).parquet(arrived), checkpoint)
    groups = staged(read_state(spark, checkpoint), "dedup-groups")

    texts = docs.select(F.col(f"`{id_col}`").alias("id"), norm.alias("norm")).select(F.substring(F.sha2("norm", 256), 1, digest_chars).alias("digest"), "norm", "id")
    unequal = staged(_unequal_bytes(texts, groups, F.col("id")), "unequal")
    if unequal.isEmpty():
        return _verdicts(arrivals, groups, ["digest"], id_col)
    again = located.withColumn("norm", norm).withColumns({"text_sha256": F.sha2("norm", 256), "n": size}).select(*row, "norm").join(unequal, "digest", "left_semi")
    stays = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("id").isNull().alias("no_id"), "id", "file", "row"))
    regrouped = again.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), stays.alias("stays"))
    rest = arrivals.join(unequal, "digest", "left_anti")
    return _verdicts(rest, groups, ["digest"], id_col).union(_verdicts(again, regrouped, ["digest", "norm"], id_col))


def _verdicts(rows: DataFrame, groups: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    own = F.struct((-F.col("n")).alias("minus_n"), F.col("id").isNull().alias("no_id"), "id", "file", "row")
    return rows.join(groups, keys).select(
        F.col("id").alias(id_col),
        F.col("stays.id").alias("keep_id"),
        "group_size",
        own.eqNullSafe(F.col("stays")).alias("kept"),
        "text_sha256",
        "n",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``deduplicate`` drops; columns are unchanged. Rows that
    agree in id, length and text but for white space are settled by the text itself."""
    verdict = deduplicate(docs, id_col, text_col).where("kept")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def key(ident: Column, n: Column, sha: Column) -> Column:
        return F.concat_ws(":", ident.cast("string"), n.cast("string"), sha)

    mine = key(F.col(f"`{id_col}`"), F.length(text), F.sha2(normalised(text), 256))
    marked = verdict.select(key(F.col(f"`{id_col}`"), F.col("n"), F.col("text_sha256"))).distinct()
    raw = F.col(f"`{text_col}`")
    return keep_marked(docs, mine, marked, F.struct(raw.isNull(), raw))
