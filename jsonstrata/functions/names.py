"""Column names: prefix removal at every depth, and lists of names from configuration."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

# Fixed value: the prefix that extracted fields carry in the incoming documents.
EXTRACT_PREFIX = "_extract_"


class DuplicateNameError(ValueError):
    """Two fields of one struct have the same name once the prefix is gone."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(base: str, *columns: Iterable[str]) -> str:
    """A column name that none of the given ones equals, whatever their case."""
    taken = {c.lower() for some in columns for c in some}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def split_names(names: str | Iterable[str] | None) -> list[str]:
    """Names from ``"a, 'b'"`` or an iterable; blanks and quotes around an item are dropped."""
    if names is None:
        return []
    items = names.split(",") if isinstance(names, str) else names
    cleaned = [item.strip().strip("\"'").strip() for item in items]
    return [item for item in cleaned if item]


def type_ddl(data_type: DataType) -> str:
    if isinstance(data_type, StructType):
        fields = ", ".join(f"{quoted(f.name)}: {type_ddl(f.dataType)}" for f in data_type.fields)
        return f"struct<{fields}>"
    if isinstance(data_type, ArrayType):
        return f"array<{type_ddl(data_type.elementType)}>"
    if isinstance(data_type, MapType):
        return f"map<{type_ddl(data_type.keyType)}, {type_ddl(data_type.valueType)}>"
    return data_type.simpleString()


def _clean_names(names: list[str], prefix: str, case_sensitive: bool) -> list[str]:
    cleaned = [name.removeprefix(prefix) for name in names]
    seen: dict[str, str] = {}
    for before, after in zip(names, cleaned):
        key = after if case_sensitive else after.lower()
        if not after:
            raise DuplicateNameError(f"field {before!r} has no name without its prefix")
        if key in seen:
            raise DuplicateNameError(f"fields {seen[key]!r} and {before!r} both become {after!r}")
        seen[key] = before
    return cleaned


def clean_type(
    data_type: DataType, prefix: str = EXTRACT_PREFIX, case_sensitive: bool = False
) -> DataType:
    """The type with ``prefix`` removed from every field name inside it."""
    if isinstance(data_type, StructType):
        names = _clean_names(data_type.names, prefix, case_sensitive)
        return StructType(
            [
                StructField(n, clean_type(f.dataType, prefix, case_sensitive), f.nullable, f.metadata)
                for n, f in zip(names, data_type.fields)
            ]
        )
    if isinstance(data_type, ArrayType):
        inner = clean_type(data_type.elementType, prefix, case_sensitive)
        return ArrayType(inner, data_type.containsNull)
    if isinstance(data_type, MapType):
        return MapType(
            clean_type(data_type.keyType, prefix, case_sensitive),
            clean_type(data_type.valueType, prefix, case_sensitive),
            data_type.valueContainsNull,
        )
    return data_type


def _rename_inside(column: Column, before: DataType, after: DataType) -> Column:
    if before == after:
        return column
    if isinstance(before, StructType):
        fields = [
            _rename_inside(column.getField(b.name), b.dataType, a.dataType).alias(a.name)
            for b, a in zip(before.fields, after.fields)
        ]
        # Without the guard a null struct would come back as a struct of nulls.
        return F.when(column.isNotNull(), F.struct(*fields))
    # Inside arrays and maps nothing can be pruned; a cast renames by position in generated code.
    return column.cast(after)


def strip_prefix(df: DataFrame, prefix: str = EXTRACT_PREFIX) -> DataFrame:
    """Remove ``prefix`` from column and nested field names.

    This is one projection, so filters and column pruning still reach the scan below it.
    """
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    before = df.schema
    after = clean_type(before, prefix, case_sensitive)
    if before == after:
        return df
    return df.select(
        *[
            _rename_inside(F.col(quoted(b.name)), b.dataType, a.dataType).alias(a.name)
            for b, a in zip(before.fields, after.fields)
        ]
    )
