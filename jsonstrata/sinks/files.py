"""Small files in the layers' store, through the file system that Spark itself uses."""

from __future__ import annotations

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyarrow import RecordBatch
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in a file system that every process opens by itself, or None in another store."""
    store, at = _at(spark, path)
    at = at.makeQualified(store.getUri(), store.getWorkingDirectory())
    return at.toUri().getPath() if store.getUri().getScheme() == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _at(spark, path)
    return store.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, at = _at(spark, folder)
    if not store.exists(at):
        return []
    return sorted(entry.getPath().getName() for entry in store.listStatus(at))


def make(spark: SparkSession, folder: str) -> bool:
    """Make a folder; whether there was none before."""
    store, at = _at(spark, folder)
    return not store.exists(at) and store.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    store, at = _at(spark, path)
    store.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; a file that has the target's name already is replaced."""
    store, at = _at(spark, source)
    _, to = _at(spark, target)
    store.mkdirs(to.getParent())
    if store.rename(at, to):
        return
    store.delete(to, False)
    if not store.rename(at, to):
        raise OSError(f"{source} cannot be renamed to {target}")


def move_all(spark: SparkSession, moves: DataFrame, folders: list[str], draft: str, at_once: int) -> None:
    """Rename many files, given as ``(source, target)``, between ``folders``. What is to be moved is written to
    ``draft`` first, so that a task that is run again does not look for what it has moved."""

    def moved(batches):
        """Rename files of the local store in a task, with their checksums."""
        number = 0
        for batch in batches:
            for pair in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                source, target = (re.sub(r"^file:(//[^/]*)?(?=/)", "", p) for p in pair)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                for start, end in (("", ""), (".", ".crc")):
                    a, b = (f"{os.path.dirname(p)}/{start}{os.path.basename(p)}{end}" for p in (source, target))
                    try:
                        os.replace(a, b)
                    except FileNotFoundError:
                        # An attempt before this one has moved it.
                        if not start and not os.path.exists(b):
                            raise
                number += 1
        yield RecordBatch.from_pydict({"files": [number]})

    moves.write.mode("overwrite").parquet(draft)
    try:
        written = spark.read.schema(moves.schema).parquet(draft)
        if all(f.startswith(("/", "file:")) and local_path(spark, f) for f in folders):
            spread = written.repartition(spark.sparkContext.defaultParallelism)
            spread.mapInArrow(moved, "files bigint").agg(F.sum("files")).collect()
            return
        path = spark._jvm.org.apache.hadoop.fs.Path
        store, _ = _at(spark, folders[-1])
        for folder in written.select(F.regexp_replace("target", "/[^/]*$", "").alias("folder")).distinct().collect():
            store.mkdirs(path(folder["folder"]))

        def one(row) -> None:
            if not store.rename(path(row["source"]), path(row["target"])):
                move(spark, row["source"], row["target"])

        rows = written.toLocalIterator()
        with ThreadPoolExecutor(at_once) as pool:
            while some := list(islice(rows, 100 * at_once)):
                list(pool.map(one, some))
    finally:
        delete(spark, draft)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole or not at all."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    store, at = _at(spark, draft)
    out = store.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, draft, path)
