"""Side tables of a load: completion events and quarantine; and the archive of raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.sinks.tables import BATCH_COLUMN


# Fixed value: the text of a completion signal, after the table's name.
SIGNAL_TEXT = "Table is Loaded"


def completion_event(
    spark: SparkSession, layer: str, tag: str, batch_id: str, rows: int, pattern: str = ""
) -> DataFrame:
    """One row that tells downstream jobs a load is done, with the signal's name and text."""
    now = F.current_timestamp()
    stamp = F.date_format(now, "yyyyMMddHHmmssSSS")
    return spark.range(1).select(
        F.lit(batch_id).alias("batch"),
        F.lit(rows).cast("bigint").alias("rows"),
        now.alias("completed_at"),
        F.concat(F.lit(f"{pattern}{tag}.d"), stamp, F.lit(".trg")).alias("signal_name"),
        F.lit(f"{tag}{SIGNAL_TEXT}").alias("signal_text"),
    )


def quarantine_rows(bad: DataFrame) -> DataFrame:
    """``(source, partition, offset, json, reason, error_time)`` of rows that cannot be loaded."""
    return bad.select(
        "source", "partition", "offset", "json", "reason", F.current_timestamp().alias("error_time")
    )


def archive_messages(messages: DataFrame, directory: str, batch_id: str) -> str:
    """Keep the batch's messages as JSON lines of ``(source, partition, offset, json)``, so that a
    payload with line breaks is read back whole, and return their directory. A replay writes the
    same directory."""
    target = f"{directory}/{BATCH_COLUMN}={batch_id}"
    rows = messages.where(F.col("json").isNotNull()).select("source", "partition", "offset", "json")
    rows.write.mode("overwrite").json(target)
    return target


def read_archive(spark: SparkSession, directory: str) -> DataFrame:
    """The archived messages."""
    schema = "source string, partition int, offset bigint, json string"
    return spark.read.schema(schema).json(directory)


def archive_payloads(messages: DataFrame, directory: str, batch_id: str) -> str:
    """Keep the batch's raw JSON as text under its own directory and return that directory.

    The files are as many as the tasks that write them; a replay writes the same directory.
    """
    target = f"{directory}/{BATCH_COLUMN}={batch_id}"
    rows = messages.where(F.col("json").isNotNull()).select("json")
    rows.write.mode("overwrite").text(target)
    return target
