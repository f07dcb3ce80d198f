"""Tag fan-out: each tag reads every message of a batch with its own schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jsonstrata.functions.names import EXTRACT_PREFIX, split_names
from jsonstrata.operators.parse import CORRUPT_COLUMN, parse_messages, typed_document
from jsonstrata.operators.variants import document_struct, parse_documents, with_documents


def fan_out(messages: DataFrame, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """One parsed frame per tag over the same messages, each with a typed read of its own."""
    return {tag: parse_messages(messages, schema) for tag, schema in schemas.items()}


def fan_out_documents(
    messages: DataFrame, schemas: Mapping[str, StructType], misfits: str = "quarantine"
) -> dict[str, DataFrame]:
    """One parsed frame per tag over messages that are parsed once.

    ``messages`` come from :func:`with_documents`, persisted or written if several tags read them.
    """
    return {tag: parse_documents(messages, schema, misfits) for tag, schema in schemas.items()}


def fan_out_counts(
    messages: DataFrame, schemas: Mapping[str, StructType], etl_columns: str | Iterable[str] = (), once: bool = False
) -> DataFrame:
    """Valid, rejected and unreadable messages per tag, for all tags in one scan.

    The counts are combined map-side into a single row, which is then turned into one row per tag.
    ``once`` parses a message once for all tags, as a VARIANT.
    """
    etl = set(split_names(etl_columns))
    tags = list(schemas)
    if once:
        messages = with_documents(messages)
    docs = messages.select(
        *[(document_struct if once else typed_document)("json", schemas[t]).alias(f"d{i}") for i, t in enumerate(tags)]
    )
    counts = []
    for i, tag in enumerate(tags):
        doc = F.col(f"d{i}")
        business = [n for n in schemas[tag].names if n.removeprefix(EXTRACT_PREFIX) not in etl]
        unreadable = doc.getField(CORRUPT_COLUMN).isNotNull()
        filled = reduce(or_, [doc.getField(n).isNotNull() for n in business], F.lit(False))
        counts.append(F.count_if(unreadable).alias(f"u{i}"))
        counts.append(F.count_if(~unreadable & filled).alias(f"v{i}"))
    totals = docs.agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = [
        F.struct(
            F.lit(tag).alias("tag"),
            F.col(f"v{i}").alias("valid"),
            (F.col("n") - F.col(f"v{i}") - F.col(f"u{i}")).alias("rejected"),
            F.col(f"u{i}").alias("unreadable"),
        )
        for i, tag in enumerate(tags)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
