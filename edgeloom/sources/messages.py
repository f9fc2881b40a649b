"""Message queues: options, decoders and encoders for a binary ``value`` column.

The connector packages are not part of Spark itself; a session that loads them can use
``read_topic`` and ``decode_avro``. The decoders work on any table with a ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.sources.schemas import WEBLOG_V0


def topic_options(
    servers: str, topic: str, starting: str = "earliest", max_offsets: int = 10_000, fail_on_data_loss: bool = True
) -> dict[str, str]:
    """Lost offsets stop the stream and a first start reads the backlog, unless told otherwise."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def decode_json(messages: DataFrame, schema: str = WEBLOG_V0) -> tuple[DataFrame, DataFrame]:
    """(decoded rows with ``event_timestamp``, undecodable messages)."""
    text = F.col("value").cast("string")
    with_corrupt = f"{schema}, _bad STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    staged = messages.select(text.alias("value"), F.from_json(text, with_corrupt, options).alias("data"))
    bad = F.col("data").isNull() | F.col("data._bad").isNotNull()
    good = (
        staged.filter(~bad).select("data.*").drop("_bad")
        .withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
    )
    return good, staged.filter(bad).select("value")


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages: a ``value`` column, and a ``key`` when one is named."""
    value = F.to_json(F.struct(*df.columns)).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def decode_avro(messages: DataFrame, schema_json: str) -> DataFrame:
    """Avro messages; needs the avro package on the session's classpath."""
    from pyspark.sql.avro.functions import from_avro

    return messages.select(from_avro("value", schema_json).alias("data")).select("data.*")
