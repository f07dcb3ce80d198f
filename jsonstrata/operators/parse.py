"""Typed JSON reading and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from jsonstrata.functions.names import quoted

CORRUPT_COLUMN = "_corrupt_record"
# Columns of a message that say where it came from; a parsed row keeps those that are present.
ORIGIN_COLUMNS = ("source", "partition", "offset")


def typed_document(json: str, schema: StructType) -> Column:
    """The JSON column as a struct of the schema's fields and ``_corrupt_record``.

    The options are the defaults, but stating them keeps the optimizer from reading only the
    fields a query uses: whether a document fits the schema must not depend on that.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    fields = [*schema.fields, StructField(CORRUPT_COLUMN, StringType())]
    return F.from_json(json, StructType(fields), options)


def parse_messages(messages: DataFrame, schema: StructType | ArrayType) -> DataFrame:
    """Read the ``json`` column with a supplied schema, one ``from_json`` per message.

    The result has the origin columns (prefixed with ``_msg_``), the document's fields, and
    ``_corrupt_record``: the original text where it does not fit the schema, else null. A schema
    that is an array of structs gives one row per element.
    """
    present = [c for c in ORIGIN_COLUMNS if c in messages.columns]
    origin = [F.col(c).alias(f"_msg_{c}") for c in present]
    if isinstance(schema, ArrayType):
        return _array_documents(messages, origin, schema)
    # As a generator the document is read once per message. As a plain expression it would be
    # copied into every filter that is pushed below the projection, and read again there.
    return messages.select(*origin, F.inline_outer(F.array(typed_document("json", schema))))


def _array_documents(
    messages: DataFrame, origin: list[Column], schema: ArrayType
) -> DataFrame:
    document = F.from_json("json", schema, {"mode": "PERMISSIVE"})
    # One entry per message, for the same reason as above; it stays an array for now.
    entry = F.struct(F.col("json").alias("_json"), document.alias("_doc"))
    rows = messages.select(*origin, F.inline_outer(F.array(entry)))
    unread = F.col("_json").isNotNull() & F.col("_doc").isNull()
    kept = [c for c in rows.columns if c not in ("_json", "_doc")]
    marked = rows.select(*kept, "_doc", F.when(unread, F.col("_json")).alias(CORRUPT_COLUMN))
    return marked.select(*kept, CORRUPT_COLUMN, F.inline_outer("_doc")).select(
        *kept, *[quoted(n) for n in schema.elementType.names], CORRUPT_COLUMN
    )


def readable(parsed: DataFrame) -> DataFrame:
    """Rows that fit the schema, with the document's fields only."""
    hidden = {f"_msg_{c}" for c in ORIGIN_COLUMNS} | {CORRUPT_COLUMN}
    fields = [quoted(c) for c in parsed.columns if c not in hidden]
    return parsed.where(F.col(CORRUPT_COLUMN).isNull()).select(*fields)


def unreadable(parsed: DataFrame, reason: str = "JSON does not fit the schema") -> DataFrame:
    """Rows for the quarantine: origin, text and reason."""
    origin = [
        F.col(f"_msg_{c}").alias(c) for c in ORIGIN_COLUMNS if f"_msg_{c}" in parsed.columns
    ]
    return parsed.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        *origin, F.col(CORRUPT_COLUMN).alias("json"), F.lit(reason).alias("reason")
    )


def explode_structs(df: DataFrame, column: str) -> DataFrame:
    """One row per element of an array of structs, the struct's fields beside the other columns.

    A row whose array is empty or null stays, with null fields.
    """
    others = [quoted(c) for c in df.columns if c != column]
    element = df.schema[column].dataType.elementType
    rows = df.select(*others, F.explode_outer(quoted(column)).alias("_item"))
    return rows.select(
        *others, *[F.col("_item").getField(n).alias(n) for n in element.names]
    )
