"""Finding the messages on which user SQL fails, so that the rest can be loaded."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name
from jsonstrata.session import shared_folder

REASON_CHARS = 500
# Classes of SQL states that speak of the data, or were raised by the statement itself.
DATA_STATES = ("21", "22", "23", "P0")
#: Messages that are written together as a part: an attempt at some of them reads their part alone.
PART_ROWS = 4096
#: Parts that are tried together first.
GROUP = 16
AT_ONCE = 16


def of_data(error: PySparkException) -> bool:
    """Whether an error comes from what was read; a lost executor or a full disk does not."""
    return (error.getSqlState() or "").startswith(DATA_STATES)


def isolate(
    messages: DataFrame, attempt: Callable[[DataFrame], object], folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Messages on which ``attempt`` succeeds, and those at fault with a ``reason``.

    The messages are written to ``folder`` once, in parts by a hash of topic, partition and offset, with
    a number in their part; the returned frames read them there. Parts are tried in groups, then alone,
    and one that fails is halved until the faulty messages are found: a part costs its own reading, and
    a faulty message about 18 attempts of up to a part's messages, many of them side by side. Messages
    of equal hash are taken together. An error that does not come from the data is raised. Nothing but
    the numbers of failing parts and messages and their error texts comes to the driver.
    """
    spark = messages.sparkSession
    folder = shared_folder(spark) if folder is None else folder
    part, rank, place = (free_name(n, messages.columns) for n in ("_part", "_rank", "_place"))
    origin = [c for c in ("source", "partition", "offset") if c in messages.columns]
    parts = max(1, -(-messages.count() // PART_ROWS))
    placed = messages.withColumn(place, F.xxhash64(*origin))
    placed = placed.withColumn(part, F.pmod(F.xxhash64(place), F.lit(parts)).cast("int"))
    number = F.dense_rank().over(Window.partitionBy(part).orderBy(place))
    numbered = placed.withColumn(rank, number).drop(place)
    numbered.write.mode("overwrite").partitionBy(part).parquet(folder)
    stored = spark.read.schema(numbered.schema).parquet(folder)

    def trouble(chosen: Column) -> str | None:
        """The error of some of the messages."""
        try:
            attempt(stored.where(chosen).select(*messages.columns))
        except PySparkException as error:
            if not of_data(error):
                raise
            return str(error)[:REASON_CHARS]
        return None

    def some(of: range) -> str | None:
        return trouble(F.col(part).between(of.start, of.stop - 1))

    def between(at: int, first: int, last: int) -> str | None:
        return trouble((F.col(part) == at) & F.col(rank).between(first, last))

    def halved(span: tuple[int, int, int]) -> list[tuple[int, int, int]]:
        """The halves of a failing span that fail. If the first one does not, the second one must."""
        at, first, last = span
        middle = (first + last) // 2
        if between(at, first, middle) is None:
            return [(at, middle + 1, last)]
        if between(at, middle + 1, last) is None:
            return [(at, first, middle)]
        return [(at, first, middle), (at, middle + 1, last)]

    bad = []
    with ThreadPoolExecutor(AT_ONCE) as pool:

        def each(of: Callable, items: list) -> list:
            # The local properties of this thread hold in all others.
            return list(pool.map(inheritable_thread_target(spark)(of), items))

        groups = [range(i, min(i + GROUP, parts)) for i in range(0, parts, GROUP)]
        failing = [g for g, text in zip(groups, each(some, groups), strict=True) if text is not None]
        alone = [range(i, i + 1) for g in failing for i in g]
        # One part was tried as its group.
        tried = alone if parts == 1 else [p for p, text in zip(alone, each(some, alone), strict=True) if text is not None]
        numbers = stored.where(F.col(part).isin([p.start for p in tried])).groupBy(part).agg(F.max(rank).alias("last"))
        spans = [(r[part], 1, r["last"]) for r in numbers.collect()] if tried else []
        while spans:
            single = [s for s in spans if s[1] == s[2]]
            bad += [(at, n, text) for (at, n, _), text in zip(single, each(lambda s: between(*s), single), strict=True) if text is not None]
            spans = [s for found in each(halved, [s for s in spans if s[1] < s[2]]) for s in found]
    # A row for each faulty message, met by its numbers.
    named = spark.createDataFrame(bad, f"{part} int, {rank} int, reason string")
    faulty = stored.join(F.broadcast(named), [part, rank]).select(*messages.columns, "reason")
    return stored.join(F.broadcast(named), [part, rank], "left_anti").select(*messages.columns), faulty
