"""Load progress as ranges of offsets, so that an offset that was set aside or came late is not
taken for loaded because a larger one was.

Ranges are merged by gaps and islands. A topic whose own offsets have gaps, such as those of
transaction markers, keeps a range for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name, quoted
from jsonstrata.operators.skew import DEFAULT_LIMITS, JoinLimits, fits_broadcast

#: Offsets that one task puts together; a partition of any size is divided by them.
CHUNK = 1_000_000
#: Offsets of a partition that messages and ranges are sorted by together.
MEETING_CHUNK = 100_000
#: Ranges up to which every message is compared with each of them.
FEW_RANGES = 100
KEYS = ("source", "partition")


def _chunk(offset: Column, size: int = CHUNK) -> Column:
    return F.floor(offset / F.lit(size)).cast("bigint")


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """``(source, partition, first, last)`` without overlaps and without neighbours that touch."""
    before = Window.partitionBy(*KEYS).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*KEYS).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max("last").over(before)
    starts = (reached.isNull() | (F.col("first") > reached + 1)).cast("int")
    islands = ranges.withColumn("_starts", starts).withColumn("_island", F.sum("_starts").over(upto))
    merged = islands.groupBy(*KEYS, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.select(*KEYS, "first", "last")


def offset_ranges(messages: DataFrame) -> DataFrame:
    """The ranges of the messages' offsets. Runs are found within chunks of offsets first, so what
    comes together for one partition is its chunks and holes, not its messages."""
    source = F.col("source") if "source" in messages.columns else F.lit(None).cast("string")
    offsets = messages.select(source.alias("source"), "partition", "offset").distinct().withColumn("_chunk", _chunk(F.col("offset")))
    rank = F.dense_rank().over(Window.partitionBy(*KEYS, "_chunk").orderBy("offset"))
    runs = offsets.withColumn("_run", F.col("offset") - rank).groupBy(*KEYS, "_chunk", "_run")
    return merge_ranges(runs.agg(F.min("offset").alias("first"), F.max("offset").alias("last")))


def not_covered(messages: DataFrame, ranges: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Messages whose offset lies in none of the ranges. A missing topic equals a missing one.

    A few ranges are broadcast and compared with every message. Otherwise ranges and messages meet by
    chunks of offsets and are sorted there once: a message lies in a range if one that began before it
    reaches it, so the work grows with their sum and not with their product.
    """
    columns = messages.columns
    names = {c: free_name(f"_{c}", columns) for c in (*KEYS, "first", "last", "chunk", "at", "reached")}
    known = ranges.where(F.col("partition").isNotNull()).select(
        F.coalesce("source", F.lit("")).alias(names["source"]), *(F.col(c).alias(names[c]) for c in ("partition", "first", "last"))
    )
    own = F.coalesce("source", F.lit("")) if "source" in columns else F.lit("")
    if known.limit(FEW_RANGES + 1).count() <= FEW_RANGES and fits_broadcast(known, limits):
        inside = (own == F.col(names["source"])) & (F.col("partition") == F.col(names["partition"]))
        inside &= F.col("offset").between(F.col(names["first"]), F.col(names["last"]))
        return messages.join(F.broadcast(known), inside, "left_anti")
    chunks = F.sequence(_chunk(F.col(names["first"]), MEETING_CHUNK), _chunk(F.col(names["last"]), MEETING_CHUNK))
    dealt = known.withColumn(names["chunk"], F.explode(chunks)).withColumnRenamed(names["first"], names["at"])
    keyed = messages.withColumns(
        {
            names["source"]: own,
            names["partition"]: F.col("partition"),
            names["chunk"]: _chunk(F.col("offset"), MEETING_CHUNK),
            names["at"]: F.col("offset"),
        }
    )
    # Ranges come before the messages of their first offset; only these have no end.
    order = [F.col(names["at"]), F.col(names["last"]).isNull()]
    by = [names[c] for c in (*KEYS, "chunk")]
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = keyed.withColumn(names["last"], F.lit(None).cast("bigint")).unionByName(dealt, allowMissingColumns=True)
    met = both.withColumn(names["reached"], F.max(names["last"]).over(upto))
    covered = F.coalesce(F.col(names["reached"]) >= F.col(names["at"]), F.lit(False))
    return met.where(F.col(names["last"]).isNull() & ~covered).select(*map(quoted, columns))


def contiguous(ranges: DataFrame, by: list[str]) -> DataFrame:
    """The offset up to which nothing is missing after a partition's first range began."""
    return ranges.groupBy(*by).agg(F.min_by("last", "first").alias("offset"))
