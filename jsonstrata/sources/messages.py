"""The message frame and the stream source that fills it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_messages(
    df: DataFrame,
    partition: Column,
    offset: Column,
    json: Column,
    source: Column | None = None,
) -> DataFrame:
    """``(partition int, offset bigint, json string, source string)`` from any frame."""
    origin = F.lit(None) if source is None else source
    return df.select(
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        json.cast("string").alias("json"),
        origin.cast("string").alias("source"),
    )


def topic_options(
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the topic source. ``starting_offsets`` is the policy for a first run
    (``earliest`` / ``latest``) or the text made from stored progress; connection and security
    settings come from the caller."""
    chosen = {"subscribe": topic, "startingOffsets": starting_offsets, **(options or {})}
    if max_offsets_per_trigger is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return chosen


def topic_messages(rows: DataFrame) -> DataFrame:
    """Messages from the columns that the topic source delivers."""
    return as_messages(
        rows, F.col("partition"), F.col("offset"), F.col("value"), F.col("topic")
    )


def read_topic_stream(spark: SparkSession, topic: str, **options) -> DataFrame:
    """Streaming messages of a topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**topic_options(topic, **options))
    return topic_messages(reader.load())


def spread_messages(messages: DataFrame, chars: int, chars_per_task: int) -> DataFrame:
    """The messages in as many partitions as their volume asks for, if they stand in fewer.

    A topic with few large partitions would otherwise be parsed by as few tasks. Messages are dealt
    by a hash, so a recomputed task gets the same ones.
    """
    wanted = -(-chars // chars_per_task)
    if wanted <= 1 or wanted <= messages.rdd.getNumPartitions():
        return messages
    return messages.repartition(wanted, "partition", "offset")


def sample_messages(messages: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by partition and offset, for a debug run."""
    return messages.orderBy("partition", "offset").limit(n)
