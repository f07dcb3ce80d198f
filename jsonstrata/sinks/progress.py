"""Stored load progress."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.operators.progress import advance
from jsonstrata.operators.ranges import contiguous, merge_ranges, offset_ranges
from jsonstrata.sinks.commits import CommitLog
from jsonstrata.sinks.tables import BATCH_COLUMN, BatchTable

SCHEMA = "partition int, offset bigint, seq bigint, batch string, source string"
RANGE_SCHEMA = "partition int, first bigint, last bigint, seq bigint, batch string, source string"


def _slot(seq: int) -> str:
    return f"slot{seq % 2}"


@dataclass(frozen=True)
class Progress:
    """The newest snapshot before a batch. Its rows are picked by directory, so a plan over them
    never reads the slot that the batch will write. ``seq`` is 0 when nothing was stored yet."""

    layer: str
    tag: str
    batch_id: str
    seq: int
    latest: DataFrame


@dataclass(frozen=True)
class WatermarkTable:
    """Latest offset per (layer, tag, topic, partition).

    Every write is a full snapshot of one (layer, tag), so the table does not grow with the number
    of batches. Two slots take turns: a batch writes the slot that does not hold the newest
    snapshot of the batches before it, and reads leave its own rows out. A batch that is run again
    therefore sees what it saw the first time, and a crash while writing loses nothing. With
    ``commits`` only snapshots of published batches count, so that what a batch loaded and never
    published is loaded again, also by a batch of another name.
    """

    table: BatchTable
    commits: CommitLog | None = None
    schema = SCHEMA
    values = ("source", "partition", "offset")

    @classmethod
    def at(cls, name: str, path: str, commits: CommitLog | None = None) -> WatermarkTable:
        return cls(BatchTable(name, path, keys=("layer", "tag")), commits)

    def create(self, spark: SparkSession) -> None:
        self.table.create(spark, spark.createDataFrame([], self.schema).schema)

    def _known(self, spark: SparkSession, without_batch: str | None) -> DataFrame:
        rows = self.table.read(spark, with_partitions=True)
        if without_batch is not None:
            rows = rows.where(F.col("batch") != without_batch)
        if self.commits is not None:
            # Two snapshots of each layer and tag, so as many names at most.
            named = [r["batch"] for r in rows.select("batch").distinct().collect()]
            rows = rows.where(F.col("batch").isin([b for b in named if self.commits.holds(spark, b)]))
        return rows

    def read(self, spark: SparkSession, without_batch: str | None = None) -> DataFrame:
        """``(layer, tag, partition, offset, source)`` of the newest snapshot of every layer and tag."""
        rows = self._known(spark, without_batch)
        # Snapshots only move forward, so the larger offset is the newer one.
        newest = rows.groupBy("layer", "tag", "partition", "source").agg(F.max("offset").alias("offset"))
        return newest.select("layer", "tag", "partition", "offset", "source")

    def stored(self, spark: SparkSession, layer: str, tag: str, batch_id: str) -> Progress:
        """Progress of one layer and tag as the batches before ``batch_id`` left it."""
        rows = self.table.read(spark, with_partitions=True).where(
            (F.col("layer") == layer) & (F.col("tag") == tag) & (F.col("batch") != batch_id)
        )
        snapshots = rows.select("seq", "batch").distinct().collect()
        seq = max(
            (r["seq"] for r in snapshots if self.commits is None or self.commits.holds(spark, r["batch"])), default=0
        )
        slot = rows.where((F.col(BATCH_COLUMN) == _slot(seq)) & (F.col("seq") == seq))
        return Progress(layer, tag, batch_id, seq, slot.select(*self.values))

    def save(self, messages: DataFrame, stored: Progress) -> None:
        """Store progress after ``messages``, the old with the new."""
        latest = self._after(stored.latest, messages)
        snapshot = latest.withColumns(
            {"seq": F.lit(stored.seq + 1).cast("bigint"), "batch": F.lit(stored.batch_id)}
        )
        owner = {"layer": stored.layer, "tag": stored.tag}
        self.table.write(snapshot, _slot(stored.seq + 1), owner)

    def _after(self, latest: DataFrame, messages: DataFrame) -> DataFrame:
        new = advance(messages, "", "", by_topic=True).select(*self.values)
        return latest.unionByName(new).groupBy("source", "partition").agg(F.max("offset").alias("offset"))


class RangeTable(WatermarkTable):
    """Loaded ranges of offsets per (layer, tag, topic, partition), stored like the latest offsets."""

    schema = RANGE_SCHEMA
    values = ("source", "partition", "first", "last")

    def read(self, spark: SparkSession, without_batch: str | None = None) -> DataFrame:
        """``(layer, tag, partition, offset, source)``: up to where nothing is missing, so that a topic
        that is read again from there brings what its holes lack."""
        rows = self._known(spark, without_batch)
        by = ["layer", "tag"]
        newest = rows.groupBy(*by).agg(F.max("seq").alias("seq"))
        found = contiguous(rows.join(F.broadcast(newest), [*by, "seq"], "left_semi"), [*by, "partition", "source"])
        return found.select("layer", "tag", "partition", "offset", "source")

    def _after(self, latest: DataFrame, messages: DataFrame) -> DataFrame:
        return merge_ranges(latest.unionByName(offset_ranges(messages).select(*self.values)))
