"""Which batches are published.

A batch writes many tables, each into a directory of its own. They are drafts until one small file
names the batch; readers of a table see the batches that are named. So all tables show a batch at
the same moment, or none does, and a batch that is published is never loaded again.

Batches that were joined up are named by a file of rows (target, batch, part): from then on the
rows of the batches are those of ``part``, in all tables or in the one that ``target`` names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.sinks import files

COMMIT, JOINED = ".commit", ".joined"
JOINED_SCHEMA = "target string, batch string, part string"
SAFE_NAME = re.compile(r"[A-Za-z0-9_.-]+")


@dataclass(frozen=True)
class CommitLog:
    """The files that name published batches, in the folder ``path``.

    The driver lists one name for each batch that was not joined up yet; the names of joined ones are
    rows that Spark reads.
    """

    path: str

    def _file(self, name: str) -> str:
        if not SAFE_NAME.fullmatch(name):
            raise ValueError(f"{name!r} cannot name a batch")
        return f"{self.path}/{name}"

    def _listed(self, spark: SparkSession) -> tuple[set[str], list[str]]:
        found = files.names(spark, self.path)
        commits = {n.removesuffix(COMMIT) for n in found if n.endswith(COMMIT)}
        return commits, [n for n in found if n.endswith(JOINED)]

    def _joined(self, spark: SparkSession, found: list[str]) -> DataFrame:
        return spark.read.schema(JOINED_SCHEMA).json([f"{self.path}/{n}" for n in found])

    def holds(self, spark: SparkSession, batch: str) -> bool:
        """Whether the batch is published, by itself or as a part of joined ones."""
        if files.exists(spark, self._file(batch + COMMIT)):
            return True
        found = [n for n in files.names(spark, self.path) if n.endswith(JOINED)]
        if not found:
            return False
        return not self._joined(spark, found).where((F.col("target") == "") & (F.col("batch") == batch)).isEmpty()

    def commit(self, spark: SparkSession, batch: str) -> None:
        """Publish a batch; all its tables have been written."""
        files.publish(spark, self._file(batch + COMMIT), batch)

    def parts(self, spark: SparkSession, target: str = "") -> list[str]:
        """The parts of a table that hold its published rows."""
        commits, found = self._listed(spark)
        if not found:
            return sorted(commits)
        joined = self._joined(spark, found).where(F.col("target").isin("", target))
        names = commits | {r["part"] for r in joined.select("part").distinct().collect()}
        listed = spark.createDataFrame([(n,) for n in sorted(names)], "batch string")
        # A joined batch's own directory, and a part that was joined up again, no longer count.
        return sorted(r["batch"] for r in listed.join(joined, "batch", "left_anti").collect())

    def replace(self, spark: SparkSession, batches: Iterable[str], into: str, target: str = "") -> None:
        """Publish ``into`` in the place of the batches, in every table or in one."""
        batches = sorted(set(batches))
        _, found = self._listed(spark)
        rows = spark.createDataFrame([(target, b, into) for b in batches], JOINED_SCHEMA)
        if found:
            # Parts that are joined up again hand on the batches they stand for.
            older = self._joined(spark, found).where((F.col("target") == target) & F.col("part").isin(batches))
            rows = rows.unionByName(older.withColumn("part", F.lit(into)))
        name = into + (f".{target}" if target else "") + JOINED
        draft = self._file("_draft-" + name)
        rows.coalesce(1).write.mode("overwrite").json(draft)
        part = next(n for n in files.names(spark, draft) if n.startswith("part-"))
        files.move(spark, f"{draft}/{part}", self._file(name))
        files.delete(spark, draft)
        if not target:
            for batch in batches:
                files.delete(spark, self._file(batch + COMMIT))
                files.delete(spark, self._file(batch + JOINED))
