"""Column expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from jsonstrata.functions.names import quoted

# The event-time column and its text formats, and the claim suffix of file names.
EVENT_TIME_COLUMN = "EVNT_TS"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSX"
EVENT_TIME_FORMAT_COLON_ZONE = "yyyy-MM-dd HH:mm:ss.SSSXXX"
CLAIM_SUFFIX = r"\.[a-f0-9]{8}$"
# Fixed value: what a file message's id starts with.
MESSAGE_PREFIX = "hdfs-"


def event_time(text: Column) -> Column:
    """Timestamp of ``2024-01-01 00:00:07.179Z`` or with an offset; null when it does not parse.

    ``-06:00`` has its colon third from the end, so each value is parsed once, with one pattern.
    """
    return F.when(
        F.substring(text, -3, 1) == ":",
        F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT_COLON_ZONE)),
    ).otherwise(F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)))


def parse_event_time(df: DataFrame, column: str = EVENT_TIME_COLUMN) -> DataFrame:
    """Turn the event-time column into a timestamp; a frame without that column passes through."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, (TimestampType, TimestampNTZType)):
        return df
    return df.withColumn(column, event_time(F.col(quoted(column))))


def upper_trimmed(name: str, data_type: DataType) -> Column:
    """``upper(trim(value))`` as text; nested values are written as JSON first."""
    column = F.col(quoted(name))
    if isinstance(data_type, (StructType, ArrayType, MapType)):
        column = F.to_json(column)
    elif not isinstance(data_type, StringType):
        column = column.cast("string")
    return F.upper(F.trim(column)).alias(name)


def message_base_name(path: Column) -> Column:
    """File name of a path, without the suffix that a claimed file carries."""
    return F.regexp_replace(F.substring_index(path, "/", -1), CLAIM_SUFFIX, "")


def message_id(path: Column, modified: Column) -> Column:
    """``hdfs-<base name>-<millis>``; the file's own time, so that a replay gives the same id."""
    millis = F.unix_millis(modified).cast("string")
    return F.concat(F.lit(MESSAGE_PREFIX), message_base_name(path), F.lit("-"), millis)
