"""Message-shaped input (A4): a binary ``value`` holding a JSON object.

A Kafka source yields exactly this shape (``key, value, topic, partition,
offset, timestamp``); with the connector on the classpath the source is
``spark.readStream.format("kafka").option("subscribe", topic)...load()`` and the
decode below applies unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_messages(df: DataFrame, schema: T.StructType, topic: str | None = None) -> DataFrame:
    """Parse ``value`` into typed columns (struct expansion, C4); malformed
    payloads give NULL fields. ``source_file`` records ``kafka://<topic>``."""
    src = F.lit(f"kafka://{topic}") if topic else F.concat(F.lit("kafka://"), F.col("topic"))
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("data"), src.alias("source_file")).select(
        "data.*", "source_file"
    )


def encode_messages(df: DataFrame, columns: Sequence[str], topic: str) -> DataFrame:
    """Rows to messages: ``value`` = UTF-8 JSON of the chosen columns."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*columns)).cast("binary").alias("value"),
    )


def kafka_messages(spark, bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The message stream itself, for a deployment with the Kafka connector on
    the classpath (it is not installed here, so this is untested locally). Its
    rows have the ``topic`` / binary ``value`` shape ``decode_messages`` reads;
    progress lives in the sink's checkpoint, so offsets are committed once."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()
