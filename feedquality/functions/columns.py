"""Column look-up, type names and join keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from feedquality.errors import ConfigError


def field_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type of a column or of a dotted struct path; ``None`` when it is not there."""
    if path in schema.names:
        return schema[path].dataType
    head, _, rest = path.partition(".")
    if rest and head in schema.names and isinstance(schema[head].dataType, T.StructType):
        return field_type(schema[head].dataType, rest)
    return None


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_at(schema: T.StructType, path: str) -> Column:
    """The column at ``path``, where a name that itself holds a dot wins over a struct path."""
    return F.col(column_text(schema, path))


def column_text(schema: T.StructType, path: str) -> str:
    """The same as SQL text."""
    return quoted(path) if path in schema.names else ".".join(quoted(part) for part in path.split("."))


def parse_type(name: str) -> T.DataType:
    """``bigint``, ``struct<city:string,state:string>`` or ``LongType`` as a data type."""
    text = name.strip().removesuffix("()")
    if text.endswith("Type"):
        cls = getattr(T, text, None)
        if not (isinstance(cls, type) and issubclass(cls, T.DataType)):
            raise ConfigError(f"unknown type name {name!r}")
        try:
            return cls()
        except TypeError as e:
            raise ConfigError(f"{name!r} needs parameters, use a DDL type instead") from e
    return T.DataType.fromDDL(text)


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal as written types; nullability of nested fields plays no part."""
    return a.simpleString() == b.simpleString()


def _leaf(column: Column, data_type: T.DataType) -> Column:
    """A value in a form in which equal values, and only they, are the same text: nested
    values part by part, each text with its length before it, a null unlike any text."""
    if isinstance(data_type, T.StructType):
        parts = [_leaf(column.getField(f.name), f.dataType) for f in data_type.fields]
        text = F.concat(F.lit("("), *parts, F.lit(")"))
    elif isinstance(data_type, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(
            F.transform(column, lambda x: _leaf(x, data_type.elementType)), ""), F.lit("]"))
    elif isinstance(data_type, T.MapType):
        entry = T.StructType([T.StructField("key", data_type.keyType), T.StructField("value", data_type.valueType)])
        entries = F.transform(F.map_entries(column), lambda e: _leaf(e, entry))
        text = F.concat(F.lit("{"), F.array_join(F.array_sort(entries), ""), F.lit("}"))
    else:
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            column = F.when(column == 0, F.lit(0.0).cast(data_type)).otherwise(column)  # 0.0 equals -0.0
        value = F.hex(column) if isinstance(data_type, T.BinaryType) else column.cast("string")
        text = F.concat(F.length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(text, F.lit("~"))


def match_key(column: Column, data_type: T.DataType) -> Column:
    """A short stand-in for a value in groupings and joins, null for null.

    Strings, binaries and nested values can be whole documents, so they travel as their
    32-byte SHA-256 digest; every other type is its own key.
    """
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(column.isNotNull(), F.unhex(F.sha2(_leaf(column, data_type).cast("binary"), 256)))
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(column.cast("binary"), 256))
    return column
