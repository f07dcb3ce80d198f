"""Batch counts and volumes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and an observation that counts its rows while a write runs, without a new job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def batch_volume(messages: DataFrame, by: Iterable[Column | str] = ()) -> DataFrame:
    """Messages, how many have a payload, and the total payload length; combined map-side.

    With the drop-directory source a message is a file, so ``messages`` is the file count.
    """
    aggregates = [
        F.count(F.lit(1)).alias("messages"),
        F.count("json").alias("resolved"),
        F.coalesce(F.sum(F.length("json")), F.lit(0)).alias("payload_chars"),
    ]
    return messages.groupBy(*by).agg(*aggregates)
