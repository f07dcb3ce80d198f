"""Loading one batch of messages into the layers."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.functions.names import quoted, strip_prefix
from jsonstrata.functions.scalars import parse_event_time
from jsonstrata.operators.audit import audit_rows
from jsonstrata.operators.gold import history, insert_only, rows_not_in_buckets
from jsonstrata.operators.membership import id_filter
from jsonstrata.operators.metrics import batch_volume
from jsonstrata.operators.parse import parse_messages, readable, unreadable
from jsonstrata.operators.poison import isolate, of_data
from jsonstrata.operators.progress import after_watermark
from jsonstrata.operators.ranges import not_covered
from jsonstrata.operators.quality import split_null_records, standard_text, standardise
from jsonstrata.operators.sqlflow import transformed
from jsonstrata.operators.variants import DOCUMENT_COLUMN, parse_documents, with_documents
from jsonstrata.plans.spec import (
    GOLD_LAYER,
    INTAKE,
    LOAD_SCHEMA,
    METRICS_SCHEMA,
    RAW_LAYER,
    GoldTag,
    LoadPlan,
    RawTag,
)
from jsonstrata.session import run_all
from jsonstrata.sinks import files
from jsonstrata.sinks.signals import archive_messages, completion_event, quarantine_rows
from jsonstrata.sinks.tables import owner_of
from jsonstrata.sources.dropdir import REJECTED_COLUMN, accepted, few_tasks, rejected
from jsonstrata.sources.envelopes import (
    open_envelopes,
    read_payloads,
    resolve_claim_checks,
    resolved,
    unresolved,
)
from jsonstrata.sources.messages import sample_messages, spread_messages


def _audit_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    # Tags have different keys but share one audit table, so the keys are kept as one JSON text.
    columns = [quoted(k) for k in keys]
    key = F.to_json(F.struct(*columns)) if columns else F.lit(None).cast("string")
    return df.select(key.alias("record_key"))


def _audit(loaded: DataFrame, rejected: DataFrame, tag: str, keys: Iterable[str]) -> DataFrame:
    yes = audit_rows(_audit_keys(loaded, keys), tag, ["record_key"], True)
    no = audit_rows(_audit_keys(rejected, keys), tag, ["record_key"], False)
    return yes.unionByName(no)


@dataclass
class Counts:
    """What became of the messages of one tag: records loaded, records without values, messages
    that can't be read or on which the tag's SQL fails."""

    loaded: int = 0
    rejected: int = 0
    unreadable: int = 0

    @property
    def any(self) -> bool:
        return self.loaded + self.rejected + self.unreadable > 0


def _sql(tag: RawTag | GoldTag):
    return tag.flatten if isinstance(tag, RawTag) else tag.transform


def _parsed(messages: DataFrame, tag: RawTag | GoldTag) -> DataFrame:
    if DOCUMENT_COLUMN in messages.columns:
        return parse_documents(messages, tag.schema, tag.misfits)
    return parse_messages(messages, tag.schema)


def _check(messages: DataFrame, tag: RawTag | GoldTag, plan: LoadPlan) -> None:
    """Run all of the tag's SQL over the messages and throw the result away."""
    parsed = strip_prefix(readable(_parsed(messages, tag)))
    with transformed(_sql(tag), {tag.name: parsed}) as flat:
        if isinstance(tag, GoldTag) or tag.curate is None:
            flat.write.format("noop").mode("overwrite").save()
            return
        records = strip_prefix(flat).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records.write.format("noop").mode("overwrite").save()
            valid, _ = split_null_records(parse_event_time(records, plan.time_column), plan.raw_etl_columns, plan.null_rule)
            with transformed(tag.curate, {f"curate_{tag.name}": valid}) as curated:
                standard_text(curated).write.format("noop").mode("overwrite").save()
        finally:
            records.unpersist()


@contextmanager
def _records(
    messages: DataFrame,
    tag: RawTag | GoldTag,
    plan: LoadPlan,
    owner: dict,
    batch_id: str,
    faulty: DataFrame | None,
    counts: Counts,
) -> Iterator[DataFrame]:
    """The tag's flat records, kept for the writes that follow, after its unreadable messages and
    the ``faulty`` ones have gone to the quarantine. Documents are parsed once and flattened once."""
    sql = _sql(tag)
    parsed = _parsed(messages, tag).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = quarantine_rows(unreadable(parsed))
        if faulty is not None:
            bad = bad.unionByName(quarantine_rows(faulty))
        counts.unreadable = plan.quarantine.write(bad, batch_id, owner)
        with transformed(sql, {tag.name: strip_prefix(readable(parsed))}) as flat:
            records = strip_prefix(flat).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                yield records
            finally:
                records.unpersist()
    finally:
        parsed.unpersist()


def load_raw_tag(
    messages: DataFrame, tag: RawTag, plan: LoadPlan, batch_id: str, faulty: DataFrame | None = None
) -> Counts:
    """RAW, CURATED, audit, quarantine and completion event of one tag; returns what was counted.

    CURATED and the audit's loaded rows read the RAW rows just written, with the columns they need.
    There is no event when no message reached the tag.
    """
    spark = messages.sparkSession
    owner = {"layer": RAW_LAYER, "tag": tag.name}
    counts = Counts()
    with _records(messages, tag, plan, owner, batch_id, faulty, counts) as records:
        valid, rejected = split_null_records(
            parse_event_time(records, plan.time_column), plan.raw_etl_columns, plan.null_rule
        )
        raw = plan.raw(tag.name)
        counts.loaded = raw.write(valid, batch_id, mode=plan.raw_mode)
        loaded = raw.read(spark, only_batch=owner_of(batch_id, plan.raw_mode))
        audit = _audit(loaded, rejected, tag.name, tag.audit_keys)

        def curate() -> None:
            with transformed(tag.curate, {f"curate_{tag.name}": loaded}) as curated:
                plan.curated(tag.name).write(
                    standardise(curated), batch_id, mode=plan.curated_mode
                )

        def audited() -> None:
            rows = plan.raw_audit.write(audit, batch_id, {"tag": tag.name})
            counts.rejected = rows - counts.loaded

        run_all(spark, [curate, audited], plan.parallel_writes)
    if counts.any:
        event = completion_event(
            spark, RAW_LAYER, tag.name, batch_id, counts.loaded, plan.raw_signal_pattern
        )
        plan.load_events.write(event, batch_id, owner)
    return counts


def load_gold_tag(
    messages: DataFrame, tag: GoldTag, plan: LoadPlan, batch_id: str, faulty: DataFrame | None = None
) -> Counts:
    """GOLD rows of one tag, insert-only or as history, with audit and quarantine."""
    spark = messages.sparkSession
    by_id = tag.name in plan.insert_only_tags
    owner = {"layer": GOLD_LAYER, "tag": tag.name}
    counts = Counts()
    with _records(messages, tag, plan, owner, batch_id, faulty, counts) as records:
        valid, rejected = split_null_records(records, plan.gold_etl_columns, plan.null_rule)
        gold = plan.gold(tag.name)
        if by_id:
            timed = parse_event_time(valid, plan.time_column)
            gold.create(spark, timed.schema)
            # What an earlier attempt at the batch left is not published, so it isn't in the target.
            if gold.buckets is None:
                new = insert_only(valid, gold.read(spark), tag.id_column, plan.time_column, plan.limits)
            else:
                filters = plan.id_filters.read(spark).where(F.col("tag") == tag.name) if tag.filter_cells else None
                new = rows_not_in_buckets(
                    timed, lambda some: gold.read(spark, in_buckets=some), gold.buckets, plan.limits, filters, tag.filter_cells
                )
        else:
            new = history(valid, plan.time_column)
        counts.loaded = gold.write(new, batch_id, mode=plan.gold_mode)
        loaded = gold.read(spark, only_batch=owner_of(batch_id, plan.gold_mode))
        if tag.filter_cells:
            plan.id_filters.write(id_filter(loaded, tag.id_column, tag.filter_cells), batch_id, {"tag": tag.name})
        audit = _audit(loaded, rejected, tag.name, tag.audit_keys)
        counts.rejected = plan.gold_audit.write(audit, batch_id, {"tag": tag.name}) - counts.loaded
    if not by_id and counts.any:
        event = completion_event(
            spark, GOLD_LAYER, tag.name, batch_id, counts.loaded, plan.gold_signal_pattern
        )
        plan.load_events.write(event, batch_id, owner)
    return counts


def load_batch(
    messages: DataFrame,
    batch_id: str,
    plan: LoadPlan,
    *,
    keep_progress: bool,
    payload_root: str | None = None,
    sample: int | None = None,
    before_publishing: Callable[[], None] | None = None,
) -> None:
    """Run one batch of messages through RAW and GOLD for every tag.

    ``keep_progress`` is for topic messages: loaded offsets are skipped and then advanced, and the
    payloads are archived. File messages rely on the stream's checkpoint instead. ``payload_root``
    is the folder of claim-checked payloads: messages with a ``payload_ref`` field are replaced by
    the file it names. ``sample`` loads the first
    messages only, without archive and progress. ``before_publishing`` writes what else belongs to
    the batch.

    Every write replaces what an earlier attempt at the same batch left, so a batch that failed
    anywhere can simply be run again. Nothing of it is seen until all of its tables are written:
    one file then publishes it, its progress included. A batch that is published, by itself or
    joined up with others since, is not loaded again.
    """
    spark = messages.sparkSession
    plan.create(spark)
    if plan.commits.holds(spark, batch_id):
        return
    if sample is not None:
        messages = sample_messages(messages, sample)
    if payload_root is not None:
        messages = open_envelopes(messages, root=payload_root)
    documents = None
    if REJECTED_COLUMN in messages.columns:
        messages = few_tasks(messages)
    taken = messages = envelopes = messages.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        refused = rejected(messages)
        if refused is not None:
            plan.quarantine.write(quarantine_rows(refused), batch_id, {"layer": INTAKE, "tag": "files"})
            messages = envelopes = accepted(messages)
        if payload_root is not None:
            payloads = read_payloads(spark, payload_root, envelopes)
            resolving = resolve_claim_checks(envelopes, payloads, plan.limits)
            messages = resolving.persist(StorageLevel.MEMORY_AND_DISK)
        volume = batch_volume(messages).first()
        plan.batch_metrics.write(spark.createDataFrame([volume], METRICS_SCHEMA), batch_id)
        readable_messages = messages
        if payload_root is not None:
            taken.unpersist()
            readable_messages = resolved(messages)
            missing = quarantine_rows(unresolved(messages))
            plan.quarantine.write(missing, batch_id, {"layer": INTAKE, "tag": "all"})
        # Small files make small scan partitions; joined up, they do not become small table files.
        tasks = max(
            spark.sparkContext.defaultParallelism,
            math.ceil(volume["payload_chars"] / plan.chars_per_task),
        )
        readable_messages = spread_messages(readable_messages.coalesce(tasks), volume["payload_chars"], plan.chars_per_task)
        track = keep_progress and sample is None
        if track:
            archive_messages(readable_messages, plan.archive_directory, batch_id)

        if plan.parse_once:
            # Kept while the tags are loaded: each of them reads the parsed documents.
            documents = with_documents(readable_messages).persist(StorageLevel.MEMORY_AND_DISK)
            readable_messages = documents

        metrics: list[tuple] = []

        def job(load, layer: str, tag) -> Callable[[], None]:
            def run() -> None:
                todo = readable_messages
                if track:
                    stored = plan.watermarks.stored(spark, layer, tag.name, batch_id)
                    if stored.seq:
                        unseen = not_covered if plan.progress == "ranges" else after_watermark
                        todo = unseen(todo, stored.latest, plan.limits)
                started = time.monotonic()
                try:
                    counts = load(todo, tag, plan, batch_id)
                except PySparkException as error:
                    if tag.on_error == "fail" or not of_data(error):
                        raise
                    folder = f"{plan.root}/work/_isolated/{layer}-{tag.name}-{batch_id}"
                    try:
                        good, faulty = isolate(todo, lambda part: _check(part, tag, plan), folder)
                        counts = load(good, tag, plan, batch_id, faulty)
                    finally:
                        files.delete(spark, folder)
                elapsed = round(1000 * (time.monotonic() - started))
                metrics.append((layer, tag.name, counts.loaded, counts.rejected, counts.unreadable, elapsed))
                if track:
                    plan.watermarks.save(todo, stored)

            return run

        # The layers do not depend on each other; one thread would take RAW before GOLD.
        jobs = [job(load_raw_tag, RAW_LAYER, tag) for tag in plan.raw_tags]
        jobs += [job(load_gold_tag, GOLD_LAYER, tag) for tag in plan.gold_tags]
        run_all(spark, jobs, plan.parallel_tags)
        plan.load_metrics.write(spark.createDataFrame(sorted(metrics), LOAD_SCHEMA), batch_id)
        if before_publishing is not None:
            before_publishing()
        plan.commits.commit(spark, batch_id)
    finally:
        if documents is not None:
            documents.unpersist()
        messages.unpersist()
        taken.unpersist()
