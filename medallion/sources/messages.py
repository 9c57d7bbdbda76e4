"""Message topics: a Kafka topic, or a folder of text files with one message a
line. Both give a frame with a ``value`` string column; Kafka's has the position of
each message as well."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Columns of a message's position, as Kafka names them.
POSITION = ("topic", "partition", "offset")


def kafka_options(
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. ``minPartitions`` in ``options`` splits a topic partition
    that holds most of the messages over several tasks."""
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets)
    return {**chosen, **(options or {})}


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of a topic from its earliest offset. Needs the Kafka connector."""
    reader = spark.readStream.format("kafka")
    reader = reader.options(**kafka_options(servers, topic, max_offsets, options))
    return positioned(reader.load())


def positioned(frame: DataFrame) -> DataFrame:
    """A frame of Kafka's columns as text and position."""
    return frame.select(F.col("value").cast("string").alias("value"), *POSITION)


def text_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the lines in a folder of text files."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def write_kafka(
    messages: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Publish ``value``, without a message key."""
    (
        messages.select("value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **(options or {})})
        .save()
    )


def write_text(messages: DataFrame, path: str) -> None:
    """Append ``value`` as lines of text."""
    messages.select("value").write.mode("append").text(path)
