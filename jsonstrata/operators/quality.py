"""Record quality: null split, de-duplication, standardising and plain projections."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from jsonstrata.functions.names import free_name, quoted, split_names
from jsonstrata.functions.scalars import upper_trimmed


def business_columns(df: DataFrame, etl_columns: str | Iterable[str]) -> list[str]:
    """All columns that are not load bookkeeping; names are compared exactly."""
    etl = set(split_names(etl_columns))
    return [c for c in df.columns if c not in etl]


def is_valid(columns: list[str], how: str = "all") -> Column:
    """True for rows to keep. ``how="all"`` rejects a row only if every column is null,
    ``how="any"`` as soon as one is."""
    if how not in ("all", "any"):
        raise ValueError(f"how must be 'all' or 'any', not {how!r}")
    if not columns:
        return F.lit(False)
    return reduce(or_ if how == "all" else and_, [F.col(quoted(c)).isNotNull() for c in columns])


def split_null_records(
    df: DataFrame, etl_columns: str | Iterable[str] = (), how: str = "all"
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) over the business columns; the two add up to ``df``."""
    keep = is_valid(business_columns(df, etl_columns), how)
    return df.where(keep), df.where(~keep)


def has_map(data_type: DataType) -> bool:
    if isinstance(data_type, MapType):
        return True
    if isinstance(data_type, ArrayType):
        return has_map(data_type.elementType)
    if isinstance(data_type, StructType):
        return any(has_map(f.dataType) for f in data_type.fields)
    return False


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication. Copies are combined before the shuffle, so a row that is repeated
    very often does not load one task. Columns holding maps are compared through their JSON."""
    maps = [f.name for f in df.schema.fields if has_map(f.dataType)]
    if not maps:
        return df.dropDuplicates()
    keys = {f"_key_{i}": F.to_json(quoted(c)) for i, c in enumerate(maps)}
    plain = [c for c in df.columns if c not in maps]
    return df.withColumns(keys).dropDuplicates([*plain, *keys]).drop(*keys)


def without_repeats(messages: DataFrame, time_column: str, delay: str, keys: Iterable[str] = ("json",)) -> DataFrame:
    """A stream without messages that it has had within ``delay``, across its batches.

    Messages are the same if their ``keys`` are. The state holds a hash and an expiry for each message
    until the stream's time is ``delay`` past it, then forgets it: the state is bounded, and a copy that
    comes later is a message of its own. Messages older than that time are dropped as late.
    """
    name = free_name("_repeat", messages.columns)
    key = F.unhex(F.sha2(F.to_json(F.struct(*map(quoted, keys))), 256))
    known = messages.withColumn(name, key).withWatermark(time_column, delay)
    return known.dropDuplicatesWithinWatermark([name]).drop(name)


def standard_text(df: DataFrame) -> DataFrame:
    """Every column as trimmed upper-case text."""
    return df.select(*[upper_trimmed(f.name, f.dataType) for f in df.schema.fields])


def standardise(df: DataFrame) -> DataFrame:
    """Every column as trimmed upper-case text, then distinct rows."""
    return standard_text(df).dropDuplicates()


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def with_constants(df: DataFrame, **values: str) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
