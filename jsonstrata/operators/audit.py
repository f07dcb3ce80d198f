"""Audit rows and their summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonstrata.functions.names import quoted

# Status of a loaded and of a rejected record.
LOADED = "YES"
REJECTED = "NO"


def audit_rows(
    df: DataFrame, tag: str, key_columns: Iterable[str], loaded: Column | bool
) -> DataFrame:
    """Key columns of each record with its status and table. ``loaded`` may be a condition, so
    that valid and rejected rows come out of one pass over the frame."""
    condition = F.lit(loaded) if isinstance(loaded, bool) else loaded
    return df.select(
        *[quoted(c) for c in key_columns],
        F.when(condition, LOADED).otherwise(REJECTED).alias("data_status"),
        F.lit(tag).alias("table_name"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """Rows per table and status."""
    return audit.groupBy("table_name", "data_status").agg(F.count(F.lit(1)).alias("rows"))
