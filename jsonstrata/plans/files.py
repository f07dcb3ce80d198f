"""Tag definitions kept as files: one schema and one SQL text per tag and layer."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, StructType

from jsonstrata.operators.sqlflow import Stage, StagedFlow
from jsonstrata.plans.spec import GoldTag, RawTag

# File names of a tag's definition, after the tag.
RAW_SCHEMA = "_incr"
GOLD_SCHEMA = "_incr_gold"
FLATTEN_SQL = "_incr_raw_spark_sql"
CURATE_SQL = "_curate_sql"
GOLD_SQL = "_incr_gold_sql"


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from any file system that Spark reads."""
    row = spark.read.format("text").option("wholetext", True).load(path).first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return row["value"]


def parse_schema(text: str) -> StructType | ArrayType:
    """A schema from Spark's JSON form or from DDL such as ``id string, items array<int>``."""
    stripped = text.strip()
    if not stripped.startswith("{"):
        return StructType.fromDDL(stripped)
    value = json.loads(stripped)
    return ArrayType.fromJson(value) if value.get("type") == "array" else StructType.fromJson(value)


def read_flow(
    spark: SparkSession, folder: str, stages: list[tuple[str, str]], final: str
) -> StagedFlow:
    """A staged flow from files: ``(view name, file name)`` per stage and the final file."""
    steps = tuple(Stage(view, read_text(spark, f"{folder}/{name}")) for view, name in stages)
    return StagedFlow(read_text(spark, f"{folder}/{final}"), steps)


def raw_tag(
    spark: SparkSession, folder: str, name: str, audit_keys: tuple[str, ...] = ()
) -> RawTag:
    return RawTag(
        name,
        parse_schema(read_text(spark, f"{folder}/{name}{RAW_SCHEMA}")),
        read_text(spark, f"{folder}/{name}{FLATTEN_SQL}"),
        read_text(spark, f"{folder}/{name}{CURATE_SQL}"),
        audit_keys,
    )


def gold_tag(
    spark: SparkSession,
    folder: str,
    name: str,
    id_column: str | None = None,
    audit_keys: tuple[str, ...] = (),
    flows: Mapping[str, StagedFlow] | None = None,
) -> GoldTag:
    """A GOLD tag. A flow registered under the tag's lower-case name replaces its single SQL."""
    flow = (flows or {}).get(name.lower())
    return GoldTag(
        name,
        parse_schema(read_text(spark, f"{folder}/{name}{GOLD_SCHEMA}")),
        flow or read_text(spark, f"{folder}/{name}{GOLD_SQL}"),
        id_column,
        audit_keys,
    )
