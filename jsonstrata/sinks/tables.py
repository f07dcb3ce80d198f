"""Layer tables. Each batch owns one directory of a table and rewrites it whole, so a replayed
batch replaces its rows instead of adding to them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jsonstrata.functions.names import quoted, type_ddl
from jsonstrata.operators.membership import BUCKET_COLUMN, Buckets
from jsonstrata.operators.metrics import observed_count
from jsonstrata.sinks import files
from jsonstrata.sinks.commits import SAFE_NAME, CommitLog

BATCH_COLUMN = "_batch_id"
# Folder of a table that names the batches joined up into others; Spark takes it for hidden.
COMPACTED = "_compacted"
# The one directory of a table that is replaced by every batch.
CURRENT = "current"
# Parts of a table up to which they are named in the condition of a scan; beyond, they are joined.
NAMED_PARTS = 500


def owner_of(batch_id: str, mode: str) -> str:
    """The partition that a batch writes."""
    return CURRENT if mode == "overwrite" else batch_id


@dataclass(frozen=True)
class BatchTable:
    """A Parquet table in the catalog, one partition per batch.

    ``keys`` are further partition columns for a table that several tags share; their values and
    the batch id together name the directory that a write owns. With ``buckets`` that directory is
    divided by a hash of a column, so that a scan for some values opens their buckets alone. With
    ``commits`` a read shows published batches only.
    """

    name: str
    path: str
    keys: tuple[str, ...] = ()
    buckets: Buckets | None = None
    commits: CommitLog | None = None

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return (*self.keys, BATCH_COLUMN, *((BUCKET_COLUMN,) if self.buckets else ()))

    def create(self, spark: SparkSession, schema: StructType) -> None:
        """Register the table unless it is known. Data already under the path is picked up."""
        if spark.catalog.tableExists(self.name):
            return
        columns = [f"{quoted(f.name)} {type_ddl(f.dataType)}" for f in schema.fields]
        columns += [f"{quoted(c)} {'int' if c == BUCKET_COLUMN else 'string'}" for c in self.partition_columns]
        ddl = ", ".join(columns)
        new = files.make(spark, self.path)
        partitions = ", ".join(quoted(c) for c in self.partition_columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({ddl}) USING parquet "
            f"PARTITIONED BY ({partitions}) LOCATION '{self.path}'"
        )
        if not new:
            spark.catalog.recoverPartitions(self.name)

    def _directory(self, batch_id: str, values: Mapping[str, str]) -> tuple[str, str]:
        spec = {**{k: values[k] for k in self.keys}, BATCH_COLUMN: batch_id}
        for value in spec.values():
            if not SAFE_NAME.fullmatch(value):
                raise ValueError(f"{value!r} cannot be used as a partition value")
        directory = "/".join([self.path, *[f"{k}={v}" for k, v in spec.items()]])
        return directory, ", ".join(f"{quoted(k)} = '{v}'" for k, v in spec.items())

    def _matched(self, df: DataFrame) -> DataFrame:
        """The frame in the table's column order, by name; types must agree."""
        wanted = [
            f
            for f in df.sparkSession.table(self.name).schema.fields
            if f.name not in self.partition_columns
        ]
        given = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        expected = {f.name: f.dataType.simpleString() for f in wanted}
        if given != expected:
            raise ValueError(f"{self.name} has columns {expected}, the batch has {given}")
        return df.select(*[quoted(f.name) for f in wanted])

    def write(
        self,
        df: DataFrame,
        batch_id: str,
        values: Mapping[str, str] | None = None,
        mode: str = "append",
    ) -> int:
        """Write the batch's rows and return their number, which the write itself counts.

        ``append`` adds the batch to the table. ``overwrite`` makes it the whole content of the
        table, or of the part that ``values`` name: other batches there are dropped once the rows
        are written, also those that were appended.
        """
        if mode not in ("append", "overwrite"):
            raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
        spark = df.sparkSession
        self.create(spark, df.schema)
        directory, spec = self._directory(owner_of(batch_id, mode), values or {})
        if mode == "append" and batch_id in self.compacted(spark):
            # Its rows are in the table already, under the name of what it was joined up into.
            return 0
        rows, seen = observed_count(self._matched(df), f"write {self.name} {directory}")
        self._put(rows, directory, spec)
        if mode == "overwrite":
            self._drop_others(spark, values or {})
        spark.catalog.refreshTable(self.name)
        return seen.get["rows"]

    def _put(self, rows: DataFrame, directory: str, spec: str) -> None:
        """Make the rows the whole content of a directory, and its partitions known."""
        spark = rows.sparkSession
        if self.buckets is None:
            rows.write.mode("overwrite").parquet(directory)
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({spec})")
            return
        dealt = rows.withColumn(BUCKET_COLUMN, self.buckets.of())
        # Dealt by bucket, or every task would add a file to every bucket; large ones are divided.
        dealt.hint("rebalance", BUCKET_COLUMN).write.mode("overwrite").partitionBy(BUCKET_COLUMN).parquet(directory)
        # An attempt before this one may have had other buckets.
        spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
        found = [n.removeprefix(f"{BUCKET_COLUMN}=") for n in files.names(spark, directory) if n.startswith(BUCKET_COLUMN)]
        if found:
            every = " ".join(f"PARTITION ({spec}, {BUCKET_COLUMN} = {n})" for n in found)
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {every}")

    def _drop_others(self, spark: SparkSession, values: Mapping[str, str]) -> None:
        """Remove the partitions and files of all batches but the current one. The catalog names
        them, so the driver sees as many as the table was given batches in the other mode."""
        owned = [f"{k}={values[k]}" for k in self.keys]
        for row in spark.sql(f"SHOW PARTITIONS {self.name}").toLocalIterator():
            parts = row["partition"].split("/")[: len(self.keys) + 1]
            *found, batch = parts
            if found != owned or batch == f"{BATCH_COLUMN}={CURRENT}":
                continue
            self._drop(spark, parts)

    def _drop(self, spark: SparkSession, parts: list[str]) -> None:
        """Remove a batch's partition, as ``SHOW PARTITIONS`` spells it. The table is external, so its
        files are removed apart."""
        spec = ", ".join(f"{quoted(k)} = '{v}'" for k, _, v in (p.partition("=") for p in parts))
        spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
        files.delete(spark, "/".join([self.path, *parts]))

    def compacted(self, spark: SparkSession) -> dict[str, str]:
        """The batches that were joined up, each with the name of what it is part of now. For a
        table with ``commits`` these know, and nothing is looked up here."""
        folder = f"{self.path}/{COMPACTED}"
        if self.commits is not None or not files.exists(spark, folder):
            return {}
        rows = spark.read.schema("batch string, part string").option("recursiveFileLookup", True).json(folder)
        return {r["batch"]: r["part"] for r in rows.toLocalIterator()}

    def join_up(
        self, spark: SparkSession, batches: Iterable[str], into: str, merge: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Write the rows of the batches as ``into``, with files of Spark's usual size; nothing goes yet.
        ``merge`` puts rows together that need not stay apart."""
        rows = self._all(spark).where(F.col(BATCH_COLUMN).isin(sorted(batches)))
        owners = rows.select(*self.keys).distinct().collect() if self.keys else [None]
        for owner in owners:
            values = {k: owner[k] for k in self.keys} if owner else {}
            mine = rows
            for key, value in values.items():
                mine = mine.where(F.col(key) == value)
            directory, spec = self._directory(into, values)
            mine = mine.drop(*self.partition_columns)
            mine = mine if merge is None else merge(mine)
            self._put(mine if self.buckets else mine.hint("rebalance"), directory, spec)

    def forget(self, spark: SparkSession, batches: Iterable[str]) -> None:
        """Remove the partitions and files of batches."""
        gone = {f"{BATCH_COLUMN}={b}" for b in batches}
        spark.catalog.recoverPartitions(self.name)
        found = {tuple(r["partition"].split("/")[: len(self.keys) + 1]) for r in spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        for parts in sorted(p for p in found if p[-1] in gone):
            self._drop(spark, list(parts))
        spark.catalog.refreshTable(self.name)

    def compact(self, spark: SparkSession, batches: Iterable[str], into: str) -> None:
        """Join batches up into one, named ``into``, with files of Spark's usual size.

        For finished batches, such as those of a past day, and between two loads. A batch that is
        run again afterwards adds nothing. A call that failed can be repeated: the joined rows are
        written first, then the names of the batches, and only then their partitions go.
        """
        batches = sorted(set(batches) - {into})
        if self.commits is not None:
            if into not in self.commits.parts(spark, self.name):
                self.join_up(spark, batches, into)
                self.commits.replace(spark, batches, into, self.name)
        elif into not in self.compacted(spark).values():
            self.join_up(spark, batches, into)
            names = spark.createDataFrame([(b, into) for b in batches], "batch string, part string")
            names.coalesce(1).write.mode("overwrite").json(f"{self.path}/{COMPACTED}/{into}")
        self.forget(spark, batches)

    def _all(self, spark: SparkSession) -> DataFrame:
        # Another session, such as a stream's, may have rewritten files since the last listing.
        spark.catalog.refreshTable(self.name)
        return spark.read.table(self.name)

    def read(
        self,
        spark: SparkSession,
        *,
        only_batch: str | None = None,
        without_batch: str | None = None,
        in_buckets: Iterable[int] | None = None,
        with_partitions: bool = False,
    ) -> DataFrame:
        """The table's rows; the conditions on batches and buckets prune directories.

        With ``commits`` these are the rows of published batches, in their joined form where they
        were joined up; a table in overwrite mode shows its last write. ``only_batch`` reads a
        batch's own directory, published or not.
        """
        rows = self._all(spark)
        if only_batch is not None:
            rows = rows.where(F.col(BATCH_COLUMN) == only_batch)
        elif self.commits is not None:
            rows = self._published(rows)
        if without_batch is not None:
            rows = rows.where(F.col(BATCH_COLUMN) != without_batch)
        if in_buckets is not None:
            rows = rows.where(F.col(BUCKET_COLUMN).isin(sorted(in_buckets)))
        if with_partitions:
            return rows
        return rows.drop(BATCH_COLUMN, BUCKET_COLUMN)

    def _published(self, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        parts = [*self.commits.parts(spark, self.name), CURRENT]
        if len(parts) <= NAMED_PARTS:
            return rows.where(F.col(BATCH_COLUMN).isin(parts))
        # One name for each batch not joined up yet, as the driver has just listed them.
        named = spark.createDataFrame([(p,) for p in parts], f"{BATCH_COLUMN} string")
        return rows.join(F.broadcast(named), BATCH_COLUMN, "left_semi")
