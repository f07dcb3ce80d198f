"""Documents that are parsed once for all tags, and fields that do not fit a tag's schema.

A message's text becomes a VARIANT once. Every tag takes its fields out of it by their paths, so
further tags cost their own fields only. A value fits a field as the typed JSON read has it: whole
numbers for integers, any number for floating point, anything as text. What doesn't fit can be set
aside with its path, and the other fields of the document are kept.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    VariantType,
)

from jsonstrata.functions.names import quoted, type_ddl
from jsonstrata.operators.parse import CORRUPT_COLUMN, ORIGIN_COLUMNS

#: Column of a message that holds its parsed document.
DOCUMENT_COLUMN = "_document"
#: Column of a record: JSON of what was set aside, from paths to the value's text and the reason.
RESCUED_COLUMN = "_rescued"
#: What becomes of a document with values that don't fit the tag's schema.
MISFITS = ("quarantine", "rescue")
NOT_FITTING, UNKNOWN = "does not fit", "unknown"

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def with_documents(messages: DataFrame) -> DataFrame:
    """The messages with ``_document``: their text as a VARIANT, null where it is not JSON.

    As a generator the text is parsed once, also below filters; a plain expression would be copied
    into each use.
    """
    document = F.struct(F.try_parse_json("json").alias(DOCUMENT_COLUMN))
    kept = [c for c in messages.columns if c != DOCUMENT_COLUMN]
    return messages.select(*map(quoted, kept), F.inline_outer(F.array(document)))


def _text(json: str) -> Column:
    """Whether there is a text; the typed read takes a blank one for a missing one."""
    return F.coalesce(F.trim(F.col(json)) != "", F.lit(False))


def _step(name: str) -> str:
    if "'" in name or "]" in name:
        raise ValueError(f"field {name!r} can't be named in a path")
    return f"$['{name}']"


def _part(value: Column, name: str) -> Column:
    return F.try_variant_get(value, _step(name), "variant")


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def _missing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def fits(value: Column, kind: DataType) -> Column:
    """Whether a VARIANT has the type's form; a missing or null value has every form."""
    typed = lambda: F.try_variant_get(value, "$", type_ddl(kind)).isNotNull()
    if isinstance(kind, (StringType, VariantType)):
        return F.lit(True)
    if isinstance(kind, _INTEGRAL):
        ok = _is(value, "BIGINT") & typed()
    elif isinstance(kind, (FloatType, DoubleType)):
        ok = _is(value, "BIGINT") | _is(value, "DECIMAL") | _is(value, "DOUBLE")
    elif isinstance(kind, DecimalType):
        ok = (_is(value, "BIGINT") | _is(value, "DECIMAL")) & typed()
    elif isinstance(kind, BooleanType):
        ok = _is(value, "BOOLEAN")
    elif isinstance(kind, StructType):
        ok = reduce(and_, [fits(_part(value, f.name), f.dataType) for f in kind.fields], _is(value, "OBJECT"))
    elif isinstance(kind, ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        ok = _is(value, "ARRAY") & F.forall(items, lambda x: fits(x, kind.elementType))
    elif isinstance(kind, MapType):
        entries = F.map_values(F.try_variant_get(value, "$", "map<string,variant>"))
        ok = _is(value, "OBJECT") & F.forall(entries, lambda x: fits(x, kind.valueType))
    else:
        ok = (_is(value, "STRING") if isinstance(kind, DateType) else ~_is(value, "OBJECT")) & typed()
    return _missing(value) | F.coalesce(ok, F.lit(False))


def _typed(value: Column, kind: DataType) -> Column:
    """The value in the type's form, null where it does not fit; a struct keeps the fields that do."""
    if isinstance(kind, VariantType):
        return F.when(~_missing(value), value)
    if isinstance(kind, StructType):
        fields = [_typed(_part(value, f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(~_missing(value) & _is(value, "OBJECT"), F.struct(*fields))
    return F.when(fits(value, kind), F.try_variant_get(value, "$", type_ddl(kind)))


def _set_aside(value: Column, kind: StructType, path: str = "") -> list[Column]:
    """For each place of the schema, and each unknown name beside it, an array of (path, value, reason)."""

    def entry(where: Column, found: Column, reason: str) -> Column:
        return F.struct(where.alias("path"), F.to_json(found).alias("value"), F.lit(reason).alias("reason"))

    none = F.array().cast("array<struct<path:string,value:string,reason:string>>")
    out = []
    for field in kind.fields:
        part, at = _part(value, field.name), path + field.name
        if isinstance(field.dataType, StructType):
            whole = F.when(~_missing(part) & ~_is(part, "OBJECT"), F.array(entry(F.lit(at), part, NOT_FITTING)))
            out += [F.coalesce(whole, none), *_set_aside(part, field.dataType, at + ".")]
        else:
            out.append(F.when(fits(part, field.dataType), none).otherwise(F.array(entry(F.lit(at), part, NOT_FITTING))))
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    others = F.filter(entries, lambda e: ~e["key"].isin(kind.names))
    out.append(F.coalesce(F.transform(others, lambda e: entry(F.concat(F.lit(path), e["key"]), e["value"], UNKNOWN)), none))
    return out


def parse_documents(messages: DataFrame, schema: StructType | ArrayType, misfits: str = "quarantine") -> DataFrame:
    """``parse_messages`` over messages that have their documents: origin, fields, ``_corrupt_record``.

    With ``misfits="quarantine"`` a document with a value that doesn't fit is corrupt as a whole.
    With ``"rescue"`` its other fields are kept, and ``_rescued`` tells by path what was set aside:
    misfits, and values that the schema doesn't name; null if there are none. Arrays and maps are
    kept or set aside whole. Text that is not JSON, or no object, is corrupt either way. A schema
    that is an array of structs gives one row per element.
    """
    if misfits not in MISFITS:
        raise ValueError(f"misfits must be one of {MISFITS}, not {misfits!r}")
    present = [c for c in ORIGIN_COLUMNS if c in messages.columns]
    origin = [F.col(c).alias(f"_msg_{c}") for c in present]
    document = F.col(DOCUMENT_COLUMN)
    rows = messages.select(*origin, F.col("json").alias("_text"), document)
    if isinstance(schema, ArrayType):
        # One document stands for a list of it, as in the typed read.
        listed = F.when(_is(document, "ARRAY"), F.try_variant_get(document, "$", "array<variant>"))
        items = F.when(_is(document, "OBJECT"), F.array(document)).otherwise(listed)
        broken = _text("_text") & items.isNull()
        kind = schema.elementType
        if misfits == "quarantine":
            broken = broken | ~F.forall(items, lambda x: fits(x, kind))
        rows = rows.withColumn("_broken", broken)
        kept = [c for c in rows.columns if c != DOCUMENT_COLUMN]
        rows = rows.select(*kept, F.explode_outer(F.when(~broken, items)).alias(DOCUMENT_COLUMN))
    else:
        kind = schema
        whole = ~document.isNull() & _is(document, "OBJECT")
        if misfits == "quarantine":
            whole = whole & fits(document, kind)
        # A missing message is no corrupt one; it has no fields.
        rows = rows.withColumn("_broken", _text("_text") & ~F.coalesce(whole, F.lit(False)))
    fields = [F.when(~F.col("_broken"), _typed(_part(document, f.name), f.dataType)).alias(f.name) for f in kind.fields]
    text = F.when(F.col("_broken"), F.col("_text")).alias(CORRUPT_COLUMN)
    if misfits == "quarantine":
        return rows.select(*[f"_msg_{c}" for c in present], *fields, text)
    found = F.filter(F.flatten(F.array(*_set_aside(document, kind))), lambda e: e["value"].isNotNull())
    told = F.map_from_entries(F.transform(found, lambda e: F.struct(e["path"], F.struct(e["value"], e["reason"]))))
    rescued = F.when(~F.col("_broken") & (F.size(found) > 0), F.to_json(told)).alias(RESCUED_COLUMN)
    return rows.select(*[f"_msg_{c}" for c in present], *fields, rescued, text)


def document_struct(json: str, schema: StructType) -> Column:
    """``typed_document`` of a message that has its document: the fields and ``_corrupt_record``."""
    document = F.col(DOCUMENT_COLUMN)
    whole = F.coalesce(~document.isNull() & _is(document, "OBJECT") & fits(document, schema), F.lit(False))
    fields = [F.when(whole, _typed(_part(document, f.name), f.dataType)).alias(f.name) for f in schema.fields]
    text = F.when(_text(json) & ~whole, F.col(json)).alias(CORRUPT_COLUMN)
    return F.struct(*fields, text)
