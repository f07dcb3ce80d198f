"""The test tables as messages, file listings and documents."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import RecordBatch
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from jsonstrata.sinks import files
from jsonstrata.sources.messages import as_messages

# Spark's name of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Query:
    """A query and the SQL that gives the same rows, if SQL can."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The tables hold local timestamps; everything here treats them as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_time_text(ts: Column, zone: str = "Z") -> Column:
    return F.date_format(ts, f"yyyy-MM-dd HH:mm:ss.SSS'{zone}'")


def local(ts: Column) -> Column:
    """A parsed timestamp in the tables' own type."""
    return ts.cast("timestamp_ntz")


EVENT_SCHEMA = StructType(
    [
        StructField("_extract_event_id", LongType()),
        StructField("_extract_user_id", LongType()),
        StructField("_extract_value", DoubleType()),
        StructField("_extract_event_type", StringType()),
        StructField("EVNT_TS", StringType()),
    ]
)
EVENT_ETL_COLUMNS = "event_id, event_type, EVNT_TS"
# A topic partition per event type; the SQL checks use the same text.
EVENT_PARTITION = (
    "CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2"
    " WHEN 'signup' THEN 3 ELSE 4 END AS INTEGER)"
)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event. Errors carry no business values, views no user, clicks no value."""
    kind = F.col("event_type")
    document = F.struct(
        F.col("event_id").alias("_extract_event_id"),
        F.when(~kind.isin("error", "view"), F.col("user_id")).alias("_extract_user_id"),
        F.when(~kind.isin("error", "click"), F.col("value")).alias("_extract_value"),
        kind.alias("_extract_event_type"),
        event_time_text(F.col("ts")).alias("EVNT_TS"),
    )
    return as_messages(
        table(spark, sf_dir, "events"),
        F.expr(EVENT_PARTITION),
        F.col("event_id"),
        F.to_json(document),
        F.lit("events"),
    )


def event_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of an earlier run: half of each partition's offsets, GOLD further than RAW, and
    nothing yet for views."""
    span = (
        table(spark, sf_dir, "events")
        .where("event_type <> 'view'")
        .groupBy(F.expr(EVENT_PARTITION).alias("partition"))
        .agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    )
    raw = span.select(
        F.lit("RAW_CURPIT").alias("layer"),
        F.lit("events").alias("tag"),
        "partition",
        F.expr("(lo + hi) div 2").alias("offset"),
    )
    gold = span.select(
        F.lit("GOLD_PIT").alias("layer"), F.lit("events").alias("tag"), "partition", F.col("hi").alias("offset")
    )
    return raw.unionByName(gold)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file listing ``(path, modified, bytes)``; error files carry a claim suffix."""
    suffix = F.when(F.col("event_type") == "error", ".json.0a1b2c3d").otherwise(".json")
    path = F.concat(
        F.lit("/drop/incoming/"), F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), suffix
    )
    return table(spark, sf_dir, "events").select(
        path.alias("path"),
        F.col("ts").cast("timestamp").alias("modified"),
        F.length("props").cast("bigint").alias("bytes"),
    )


def one_file_each(rows: DataFrame, folder: str, end: str = "\n", by: str | None = None) -> None:
    """Write the column ``value`` of each row, and ``end``, as a file of its own; with ``by`` into a folder for
    each value of that column, named as Spark names partitions.

    Tasks write to a store that they open themselves without Spark's writer, whose local file system starts
    several processes for each file that it makes. A file appears whole, and an attempt that is run again
    replaces the files of the one before.
    """
    spark, rows = rows.sparkSession, rows.select("value", *([by] if by else []))
    mark, top = uuid.uuid4().hex[:8], files.local_path(spark, folder)
    if top is None:
        # Tasks put their files in place: as many renames by the driver would take most of the time.
        writer = rows.write.mode("append").option("maxRecordsPerFile", 1).option("lineSep", end)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        (writer.partitionBy(by) if by else writer).text(folder)
        return
    files.make(spark, folder)
    part = F.lit("") if by is None else F.concat(F.lit(f"{by}="), F.coalesce(F.col(by).cast("string"), F.lit(NO_VALUE)))

    def put(batches):
        task, number, last = TaskContext.get().partitionId(), 0, end.encode()
        for batch in batches:
            for part, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = os.path.join(top, part)
                if part:
                    os.makedirs(at, exist_ok=True)
                name = f"{mark}-{task}-{number}.txt"
                with open(f"{at}/.{name}", "wb") as file:
                    file.write((value or b"") + last)
                os.replace(f"{at}/.{name}", f"{at}/{name}")
                number += 1
        yield RecordBatch.from_pydict({"files": [number]})

    rows.select(part.alias("part"), F.col("value").cast("binary")).mapInArrow(put, "files bigint").agg(F.sum("files")).collect()
