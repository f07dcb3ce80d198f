"""What to load: tags, their schemas and SQL, and where the layers live."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, StructType

from jsonstrata.functions.names import split_names
from jsonstrata.functions.scalars import EVENT_TIME_COLUMN
from jsonstrata.operators.membership import FILTER_SCHEMA, Buckets, merged
from jsonstrata.operators.skew import DEFAULT_LIMITS, JoinLimits
from jsonstrata.operators.sqlflow import StagedFlow
from jsonstrata.operators.variants import MISFITS
from jsonstrata.session import run_all
from jsonstrata.sinks.commits import CommitLog
from jsonstrata.sinks.progress import RangeTable, WatermarkTable
from jsonstrata.sinks.tables import BatchTable

# Names of the two layers that keep progress.
RAW_LAYER = "RAW_CURPIT"
GOLD_LAYER = "GOLD_PIT"
# Where messages are quarantined that never reach a layer.
INTAKE = "INTAKE"

AUDIT_SCHEMA = "record_key string, data_status string, table_name string"
QUARANTINE_SCHEMA = (
    "source string, partition int, offset bigint, json string, reason string, error_time timestamp"
)
EVENT_SCHEMA = (
    "batch string, rows bigint, completed_at timestamp, signal_name string, signal_text string"
)
METRICS_SCHEMA = "messages bigint, resolved bigint, payload_chars bigint"
LOAD_SCHEMA = (
    "layer string, tag string, loaded bigint, rejected bigint, unreadable bigint, elapsed_ms bigint"
)
REDRIVE_SCHEMA = "source string, partition int, offset bigint, attempts int, state string"
# Files taken by turns without a stream; ``reason`` tells why a file was refused.
INTAKE_SCHEMA = "file_key string, path string, modified timestamp, bytes bigint, reason string"
# How progress is kept: the latest offset of a partition, or all loaded ranges.
PROGRESS = ("latest", "ranges")
# What to do with messages on which a tag's SQL fails.
ON_ERROR = ("fail", "quarantine")


@dataclass(frozen=True)
class RawTag:
    """A table of the RAW and CURATED layers.

    ``flatten`` reads the parsed documents as ``{<name>}``; ``curate`` reads the loaded RAW rows
    as ``{curate_<name>}``. Without SQL the frame passes through. With ``on_error="quarantine"`` the
    messages on which ``flatten`` or ``curate`` fails are looked for and put aside, and the others
    are loaded. With ``misfits="rescue"`` a document whose values don't all fit the schema is loaded
    without these, and the parsed documents have a column ``_rescued`` that tells them.
    """

    name: str
    schema: StructType | ArrayType
    flatten: str | StagedFlow | None = None
    curate: str | StagedFlow | None = None
    audit_keys: tuple[str, ...] = ()
    on_error: str = "fail"
    misfits: str = "quarantine"


@dataclass(frozen=True)
class GoldTag:
    """A table of the GOLD layer. ``transform`` reads the parsed documents as ``{<name>}``.
    ``id_column`` is needed for a tag that is loaded insert-only. ``on_error`` as for a RAW tag.

    With ``buckets`` an insert-only table is divided by a hash of the id, and a batch scans the
    buckets of its ids. With ``filter_cells`` the loaded ids are kept as bitmaps of so many cells
    (about one for 3,000 ids), and only buckets of ids that these may hold are scanned.
    """

    name: str
    schema: StructType | ArrayType
    transform: str | StagedFlow | None = None
    id_column: str | None = None
    audit_keys: tuple[str, ...] = ()
    on_error: str = "fail"
    misfits: str = "quarantine"
    buckets: int = 0
    filter_cells: int = 0


@dataclass(frozen=True)
class LoadPlan:
    """Tags and settings of one load. ``root`` is a folder that all executors share.

    With ``parse_once`` a message is parsed once for all tags, as a VARIANT, instead of once a tag; a
    tag with ``misfits="rescue"`` needs that. With ``progress="ranges"`` a message is skipped if its own
    offset was loaded, not if a larger one was. ``parallel_tags`` tags are loaded at once, each with up to ``parallel_writes`` writes. A batch
    whose scan has more partitions than cores is joined up to about ``chars_per_task`` of payload.
    """

    root: str
    raw_tags: tuple[RawTag, ...] = ()
    gold_tags: tuple[GoldTag, ...] = ()
    insert_only: str | Iterable[str] = ()
    raw_etl_columns: str | Iterable[str] = (EVENT_TIME_COLUMN,)
    gold_etl_columns: str | Iterable[str] = (EVENT_TIME_COLUMN,)
    time_column: str = EVENT_TIME_COLUMN
    null_rule: str = "all"
    raw_mode: str = "append"
    curated_mode: str = "append"
    gold_mode: str = "append"
    raw_signal_pattern: str = ""
    gold_signal_pattern: str = ""
    database_prefix: str = ""
    parse_once: bool = False
    progress: str = "latest"
    parallel_tags: int = 4
    parallel_writes: int = 3
    chars_per_task: int = 128 * 2**20
    limits: JoinLimits = field(default=DEFAULT_LIMITS)

    def __post_init__(self) -> None:
        if self.progress not in PROGRESS:
            raise ValueError(f"progress must be one of {PROGRESS}, not {self.progress!r}")
        unknown = self.insert_only_tags - {t.name for t in self.gold_tags}
        if unknown:
            raise ValueError(f"insert-only tags without a definition: {sorted(unknown)}")
        for tag in (*self.raw_tags, *self.gold_tags):
            if tag.on_error not in ON_ERROR:
                raise ValueError(f"on_error of tag {tag.name!r} must be one of {ON_ERROR}")
            if tag.misfits not in MISFITS:
                raise ValueError(f"misfits of tag {tag.name!r} must be one of {MISFITS}")
            if tag.misfits == "rescue" and not self.parse_once:
                raise ValueError(f"misfits of tag {tag.name!r} are rescued only with parse_once")
        for tag in self.gold_tags:
            if (tag.buckets or tag.filter_cells) and tag.name not in self.insert_only_tags:
                raise ValueError(f"tag {tag.name!r} has buckets or a filter but is not insert-only")
            if tag.filter_cells and not tag.buckets:
                raise ValueError(f"the filter of tag {tag.name!r} needs buckets to choose from")
            if tag.name in self.insert_only_tags and tag.id_column is None:
                raise ValueError(f"insert-only tag {tag.name!r} needs an id column")
        if self.insert_only_tags and self.gold_mode == "overwrite":
            raise ValueError("an insert-only table cannot be overwritten")

    @property
    def insert_only_tags(self) -> set[str]:
        return set(split_names(self.insert_only))

    @property
    def progress_keys(self) -> list[tuple[str, str]]:
        """(layer, tag) of everything that keeps progress."""
        raw = [(RAW_LAYER, tag.name) for tag in self.raw_tags]
        return raw + [(GOLD_LAYER, tag.name) for tag in self.gold_tags]

    def database(self, layer: str) -> str:
        return f"{self.database_prefix}{layer}"

    @property
    def commits(self) -> CommitLog:
        """Names of the published batches."""
        return CommitLog(f"{self.root}/work/_commits")

    def table(self, layer: str, name: str, keys: tuple[str, ...] = (), buckets: Buckets | None = None) -> BatchTable:
        path = f"{self.root}/{layer}/{name}"
        return BatchTable(f"{self.database(layer)}.{name}", path, keys, buckets, self.commits)

    def raw(self, tag: str) -> BatchTable:
        return self.table("raw", tag)

    def curated(self, tag: str) -> BatchTable:
        return self.table("curated", tag)

    def gold(self, tag: str) -> BatchTable:
        if tag not in self.insert_only_tags:
            return self.table("gold_history", tag)
        spec = next(t for t in self.gold_tags if t.name == tag)
        return self.table("gold", tag, buckets=Buckets(spec.id_column, spec.buckets) if spec.buckets else None)

    @property
    def raw_audit(self) -> BatchTable:
        return self.table("work", "raw_audit", ("tag",))

    @property
    def gold_audit(self) -> BatchTable:
        return self.table("work", "gold_audit", ("tag",))

    @property
    def quarantine(self) -> BatchTable:
        return self.table("work", "quarantine", ("layer", "tag"))

    @property
    def load_events(self) -> BatchTable:
        return self.table("work", "load_events", ("layer", "tag"))

    @property
    def batch_metrics(self) -> BatchTable:
        return self.table("work", "batch_metrics")

    @property
    def load_metrics(self) -> BatchTable:
        return self.table("work", "load_metrics")

    @property
    def id_filters(self) -> BatchTable:
        return self.table("work", "id_filters", ("tag",))

    @property
    def redrives(self) -> BatchTable:
        return self.table("work", "redrives", ("layer", "tag"))

    @property
    def intake(self) -> BatchTable:
        """Files taken by turns. Made by the first of these, as streams have their checkpoint."""
        return self.table("work", "intake")

    @property
    def watermarks(self) -> WatermarkTable:
        kind, name = (RangeTable, "ranges") if self.progress == "ranges" else (WatermarkTable, "watermarks")
        return kind.at(f"{self.database('work')}.{name}", f"{self.root}/work/{name}", self.commits)

    @property
    def archive_directory(self) -> str:
        return f"{self.root}/archive"

    def create(self, spark: SparkSession) -> None:
        """Databases, and the tables that tags share: made before tags are loaded side by side.

        The table that is made last tells whether all are known, so a batch asks for one.
        """
        if spark.catalog.tableExists(self.load_metrics.name):
            return
        for layer in ("raw", "curated", "gold", "gold_history", "work"):
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"LOCATION '{self.root}/{layer}'"
            )
        for shared, ddl in [
            (self.raw_audit, AUDIT_SCHEMA),
            (self.gold_audit, AUDIT_SCHEMA),
            (self.quarantine, QUARANTINE_SCHEMA),
            (self.load_events, EVENT_SCHEMA),
            (self.batch_metrics, METRICS_SCHEMA),
            (self.id_filters, FILTER_SCHEMA),
            (self.redrives, REDRIVE_SCHEMA),
        ]:
            shared.create(spark, spark.createDataFrame([], ddl).schema)
        self.watermarks.create(spark)
        self.load_metrics.create(spark, spark.createDataFrame([], LOAD_SCHEMA).schema)

    def compact(self, spark: SparkSession, batches: Iterable[str], into: str) -> None:
        """Join published batches up into one, in all tables, with files of Spark's usual size.

        For batches of a past day, and between two loads. The joined rows are written first, one file
        then publishes them in the place of the batches, and only then the batches' files go; a call
        that failed can be repeated. A batch that is run again afterwards is not loaded again. Tables
        in overwrite mode have no batches to join. Filters of ids are merged.
        """
        batches = sorted(set(batches) - {into})
        parts = self.commits.parts(spark)
        done = into in parts
        missing = [b for b in batches if not done and b not in parts]
        if missing:
            raise ValueError(f"batches that are not published cannot be joined up: {missing}")
        tables = [self.raw_audit, self.gold_audit, self.quarantine, self.load_events, self.batch_metrics]
        tables += [self.load_metrics, self.redrives, self.intake]
        tables += [self.raw(t.name) for t in self.raw_tags if self.raw_mode == "append"]
        tables += [self.curated(t.name) for t in self.raw_tags if self.curated_mode == "append"]
        tables += [self.gold(t.name) for t in self.gold_tags if self.gold_mode == "append"]
        merges = {t.name: None for t in tables if spark.catalog.tableExists(t.name)} | {self.id_filters.name: merged}
        tables = [t for t in (*tables, self.id_filters) if t.name in merges]
        if not done:
            joins = [partial(t.join_up, spark, batches, into, merges[t.name]) for t in tables]
            run_all(spark, joins, self.parallel_tags)
            self.commits.replace(spark, batches, into)
        for table in tables:
            table.forget(spark, batches)
