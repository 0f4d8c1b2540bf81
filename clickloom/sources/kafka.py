"""Kafka in and out: options and the JSON form of the records.

The connector itself is a separate jar. Everything but the two functions that name the
format works on any frame with Kafka's column layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

# Default topic, broker and starting point.
DEFAULT_TOPIC = "hotitems"
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_START = "latest"


def kafka_options(
    topic: str = DEFAULT_TOPIC,
    servers: str = DEFAULT_SERVERS,
    start: str = DEFAULT_START,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options. ``max_offsets`` bounds the rows of a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def decode_json(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records' binary ``value`` as typed columns; what does not parse gives nulls."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return records.select(parsed.alias("_r")).select("_r.*")


def encode_json(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows as Kafka records: JSON ``value`` and, from the key columns, ``key``."""
    value = F.to_json(F.struct(*df.columns)).cast("binary").alias("value")
    if not key:
        return df.select(value)
    return df.select(F.to_json(F.struct(*key)).cast("binary").alias("key"), value)


def read_kafka(spark: SparkSession, schema: T.StructType, **options) -> DataFrame:
    """A topic as a typed stream."""
    stream = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return decode_json(stream, schema)


def write_kafka(
    df: DataFrame,
    checkpoint: str,
    topic: str = DEFAULT_TOPIC,
    servers: str = DEFAULT_SERVERS,
    key: Sequence[str] = (),
) -> DataStreamWriter:
    """A writer of a typed stream to a topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return encode_json(df, key).writeStream.format("kafka").options(**options)
