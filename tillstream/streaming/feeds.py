"""Streaming sources. Every job takes a DataFrame, so the source can be a topic or files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: rows and bytes per micro-batch; they bound what one key can bring to one task at a time
MAX_OFFSETS = 1_000_000
MAX_BYTES = 1 << 30


def _limited(reader, max_files: int | None, max_bytes: int | None):
    """The file source takes one kind of limit: a number of files if given, else bytes."""
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes or MAX_BYTES)


def kafka_feed(
    spark: SparkSession,
    topics: str | Sequence[str],
    servers: str,
    group: str | None = None,
    max_offsets: int = MAX_OFFSETS,
) -> DataFrame:
    """`topic, value` from the earliest offset. Needs the Spark Kafka connector on the class path."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", names)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().selectExpr("topic", "cast(value as string) as value")


def text_feed(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """`value` per line of the text files in a folder, oldest file first."""
    return _limited(spark.readStream, max_files, max_bytes).text(path)


def parquet_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    reader = _limited(spark.readStream.schema(schema), max_files, max_bytes)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def by_topic(feed: DataFrame, topic: str) -> DataFrame:
    """The rows of one topic of a shared feed."""
    return feed.where(feed["topic"] == topic)
