"""Group and aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.errors import ConfigError
from feedquality.functions.columns import column_at, field_type

Names = str | Sequence[str]
Keys = str | Column | Sequence[str | Column]


def _names(columns: Names | None) -> list[str]:
    parts = columns.split(",") if isinstance(columns, str) else list(columns or ())
    return [p.strip() for p in parts]


def _split(text: str) -> list[str]:
    """``text`` at the commas that stand outside parentheses and quotes."""
    parts, depth, quote = [""], 0, ""
    for c in text:
        if c == "," and not depth and not quote:
            parts.append("")
            continue
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        else:
            depth += (c in "([") - (c in ")]")
        parts[-1] += c
    return parts


def _keys(df: DataFrame, keys: Keys) -> list[Column]:
    """``"a,b"`` is two keys, and so is ``"upper(a),b"``; ``"coalesce(a, b)"`` is one."""
    if isinstance(keys, Column):
        return [keys]
    if isinstance(keys, str):
        keys = [keys] if keys in df.columns else _split(keys)
    return [k if isinstance(k, Column)
            else column_at(df.schema, k.strip()) if field_type(df.schema, k.strip()) is not None
            else F.expr(k) for k in keys]


def _numeric(df: DataFrame, name: str) -> Column:
    """Numbers kept as text are read as doubles, and what is not a number counts as null."""
    c = column_at(df.schema, name)
    return c.try_cast("double") if isinstance(field_type(df.schema, name), T.StringType) else c


def group_agg(df: DataFrame, keys: Keys, sum: Names | None = None, avg: Names | None = None,
              min: Names | None = None, max: Names | None = None, count: Names | None = None,
              naming: str = "source") -> DataFrame:
    """Aggregate ``df`` per key: keys first, then the sum, avg, min, max and count columns.

    Keys are columns, struct paths, whole structs or expressions; without any function
    the result is the distinct keys. An aggregate is called like its column
    (``naming="source"``) or ``column_function`` (``naming="suffix"``), which is needed
    as soon as one column goes through two functions. All five functions aggregate
    map-side, so a hot key costs one row per task in the shuffle.
    """
    if naming not in ("source", "suffix"):
        raise ConfigError(f"naming must be 'source' or 'suffix', got {naming!r}")
    key_columns = _keys(df, keys) if keys is not None else []
    if not key_columns:
        raise ConfigError("group_agg needs at least one key")
    blocks = [
        ("sum", _names(sum), lambda n: F.sum(_numeric(df, n))),
        ("avg", _names(avg), lambda n: F.avg(_numeric(df, n))),
        ("min", _names(min), lambda n: F.min(column_at(df.schema, n))),
        ("max", _names(max), lambda n: F.max(column_at(df.schema, n))),
        ("count", _names(count), lambda n: F.count(column_at(df.schema, n))),
    ]
    aggregates, taken = [], df.select(*key_columns).columns
    for function, names, build in blocks:
        for name in names:
            label = name if naming == "source" else f"{name}_{function}"
            if label in taken:
                raise ConfigError(f"two result columns would be called {label!r}; use naming='suffix'")
            taken.append(label)
            aggregates.append(build(name).alias(label))
    if not aggregates:
        return df.select(*key_columns).distinct()
    return df.groupBy(*key_columns).agg(*aggregates)
