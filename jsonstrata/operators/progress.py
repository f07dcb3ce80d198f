"""Load progress per (layer, tag, topic, partition) and the filter that skips loaded messages.

``source`` names the topic of a message. Two topics have the same partition numbers, so it is part of
every key wherever a frame has it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name
from jsonstrata.operators.skew import DEFAULT_LIMITS, JoinLimits, fits_broadcast, salted_join

EARLIEST = -2  # fixed value of the stream source: read a partition from its start


def partition_keys(*frames: DataFrame) -> list[str]:
    """The columns that all frames have of those that name a partition."""
    return [c for c in ("source", "partition") if all(c in df.columns for df in frames)]


def layer_watermarks(watermarks: DataFrame, layer: str) -> DataFrame:
    """The progress rows of one layer."""
    return watermarks.where(F.col("layer") == layer)


def latest_watermarks(watermarks: DataFrame, layer: str, tag: str) -> DataFrame:
    """Latest offset per partition for one layer and tag."""
    return (
        layer_watermarks(watermarks, layer)
        .where(F.col("tag") == tag)
        .groupBy(*partition_keys(watermarks))
        .agg(F.max("offset").alias("offset"))
    )


def after_watermark(
    messages: DataFrame, latest: DataFrame, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Messages beyond the stored offset of their partition; a partition without one is kept whole.

    ``latest`` has one narrow row per partition of the topic. It is broadcast once its size has
    been checked, so the messages do not move. Beyond the bound a salted join is used, because a
    topic partition may hold a large share of the messages.
    """
    columns = messages.columns
    key, seen = free_name("_partition", columns), free_name("_loaded", columns)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in partition_keys(messages, latest)]
    loaded = latest.select(F.struct(*parts).alias(key), F.col("offset").alias(seen))
    keyed = messages.withColumn(key, F.struct(*parts))
    if fits_broadcast(loaded, limits):
        joined = keyed.join(F.broadcast(loaded), key, "left")
    else:
        joined = salted_join(keyed, loaded, key, "left", ["offset"], limits)
    unseen = F.col(seen).isNull() | (F.col("offset") > F.col(seen))
    return joined.where(unseen).select(*columns)


def advance(messages: DataFrame, layer: str, tag: str, by_topic: bool = False) -> DataFrame:
    """Progress rows after these messages: the largest offset of each partition, and with
    ``by_topic`` of each topic's partition, then with a column ``source``."""
    keys = ["partition", "source"] if by_topic else ["partition"]
    return (
        messages.groupBy(*keys)
        .agg(F.max("offset").alias("offset"))
        .select(F.lit(layer).alias("layer"), F.lit(tag).alias("tag"), "partition", "offset", *keys[1:])
    )


def start_offsets(watermarks: DataFrame, wanted: Iterable[tuple[str, str]]) -> DataFrame:
    """First offset to read per partition so that no wanted (layer, tag) misses a message.

    The slowest of them decides; a partition that one of them never loaded starts at the
    beginning (``-2``).
    """
    pairs = list(wanted)
    keys = [f"{layer}/{tag}" for layer, tag in pairs]
    key = F.concat_ws("/", "layer", "tag")
    by = partition_keys(watermarks)
    return (
        watermarks.where(key.isin(keys))
        .groupBy(*by, key.alias("_key"))
        .agg(F.max("offset").alias("offset"))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("_known"), F.min("offset").alias("offset"))
        .select(
            *by,
            F.when(F.col("_known") == len(set(keys)), F.col("offset") + 1)
            .otherwise(F.lit(EARLIEST).cast("bigint"))
            .alias("next_offset"),
        )
    )


def starting_offsets_option(
    offsets: DataFrame, topic: str | Mapping[str, int], partitions: int | None = None
) -> str:
    """The stream source's ``startingOffsets`` text, for one topic or for topics with their
    partition counts. It must name every partition of a topic, so the counts also bound what is
    brought to the driver. Offsets without a ``source`` belong to the one topic."""
    topics = {topic: partitions} if isinstance(topic, str) else dict(topic)
    named = "source" in offsets.columns
    if len(topics) > 1 and not named:
        raise ValueError("offsets of several topics need their source")
    text = {}
    for name, count in topics.items():
        rows = offsets.where(F.col("source") == name) if named else offsets
        rows = rows.where(F.col("partition").between(0, count - 1))
        known = {r["partition"]: r["next_offset"] for r in rows.toLocalIterator()}
        text[name] = {str(p): known.get(p, EARLIEST) for p in range(count)}
    return json.dumps(text)
