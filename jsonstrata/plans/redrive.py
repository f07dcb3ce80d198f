"""Driving quarantined messages through a tag again, after its schema or SQL was changed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import GOLD_LAYER, RAW_LAYER, LoadPlan

#: What became of a message when it was last driven: its records are in the tables, it is back in
#: the quarantine, or it is there for the last time.
LOADED, FAILED, GIVEN_UP = "loaded", "failed", "given up"
MESSAGE = ("source", "partition", "offset")


def _same(left: DataFrame, right: DataFrame) -> list:
    return [left[c].eqNullSafe(right[c]) for c in MESSAGE]


def redrive_states(spark: SparkSession, plan: LoadPlan, layer: str, tag: str) -> DataFrame:
    """``(source, partition, offset, attempts, state)`` of every message that was driven again."""
    rows = plan.redrives.read(spark).where((F.col("layer") == layer) & (F.col("tag") == tag))
    newest = rows.groupBy(*MESSAGE).agg(F.max(F.struct("attempts", "state")).alias("last"))
    return newest.select(*MESSAGE, "last.attempts", "last.state")


def open_quarantine(spark: SparkSession, plan: LoadPlan, layer: str, tag: str, max_attempts: int = 3) -> DataFrame:
    """``(source, partition, offset, json, attempts)``: messages of one tag that can be driven again.

    A message that stands in the quarantine several times is one. Those that were loaded since, and
    those that failed ``max_attempts`` times, are left out.
    """
    rows = plan.quarantine.read(spark).where((F.col("layer") == layer) & (F.col("tag") == tag))
    once = rows.groupBy(*MESSAGE).agg(F.max("json").alias("json"))
    states = redrive_states(spark, plan, layer, tag).alias("states")
    joined = once.join(states, _same(once, states), "left")
    tried = F.coalesce(states["attempts"], F.lit(0))
    left = F.coalesce(states["state"], F.lit(FAILED)) == FAILED
    return joined.where(left & (tried < max_attempts)).select(*(once[c] for c in MESSAGE), "json", tried.alias("attempts"))


def redrive(
    spark: SparkSession, plan: LoadPlan, layer: str, tag: str, batch_id: str, max_attempts: int = 3
) -> dict[str, int]:
    """Load a tag's quarantined messages again, as a batch of its own; messages by what became of them.

    ``plan`` has the tag's present schema and SQL; its table keeps its columns. Records, new
    quarantine rows and the messages' states are published together. A message is loaded at most
    once, however often this is called; with nothing to drive no batch is written.
    """
    plan.create(spark)
    if plan.commits.holds(spark, batch_id):
        return {}
    if layer == RAW_LAYER:
        alone = replace(plan, raw_tags=tuple(t for t in plan.raw_tags if t.name == tag), gold_tags=(), insert_only=())
    elif layer == GOLD_LAYER:
        chosen = tuple(t for t in plan.gold_tags if t.name == tag)
        alone = replace(plan, raw_tags=(), gold_tags=chosen, insert_only=sorted(plan.insert_only_tags & {tag}))
    else:
        raise ValueError(f"messages of {layer!r} never reached a tag")
    if not (alone.raw_tags or alone.gold_tags):
        raise ValueError(f"no tag {tag!r} in {layer}")
    waiting = open_quarantine(spark, plan, layer, tag, max_attempts).persist()
    try:
        if waiting.isEmpty():
            return {}
        owner = {"layer": layer, "tag": tag}
        counts: dict[str, int] = {}

        def note() -> None:
            """The messages' states, from the quarantine rows that this batch wrote."""
            bad = plan.quarantine.read(spark, only_batch=batch_id).where((F.col("layer") == layer) & (F.col("tag") == tag))
            bad = bad.select(*MESSAGE).distinct().withColumn("back", F.lit(True)).alias("bad")
            joined = waiting.join(bad, _same(waiting, bad), "left")
            attempts = waiting["attempts"] + 1
            state = F.when(bad["back"].isNull(), LOADED).when(attempts >= max_attempts, GIVEN_UP).otherwise(FAILED)
            rows = joined.select(*(waiting[c] for c in MESSAGE), attempts.cast("int").alias("attempts"), state.alias("state"))
            plan.redrives.write(rows, batch_id, owner)
            written = plan.redrives.read(spark, only_batch=batch_id).groupBy("state").count()
            counts.update({r["state"]: r["count"] for r in written.collect()})

        messages = waiting.select("partition", "offset", "json", "source")
        load_batch(messages, batch_id, alone, keep_progress=False, before_publishing=note)
        return counts
    finally:
        waiting.unpersist()
