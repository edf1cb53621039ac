"""Declared table models."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from os import PathLike, fspath
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, types as T

from feedquality.errors import ConfigError
from feedquality.functions.columns import parse_type


def load_json(source: str | PathLike | Mapping[str, Any]) -> Mapping[str, Any]:
    """A config given either as a mapping or as the path of a JSON file.

    Spark reads the file, so it may lie in any storage the session reaches: a driver in the
    cluster finds it where the feeds are. A path without a scheme is of the default storage.
    """
    if isinstance(source, Mapping):
        return source
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise ConfigError(f"{source}: a file is read by Spark; start a session first")
    try:
        files = spark.read.text(fspath(source), wholetext=True).take(2)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ConfigError(f"{source}: no such file") from e
    if len(files) != 1:
        raise ConfigError(f"{source}: expected one file, found {'none' if not files else 'several'}")
    try:
        return json.loads(files[0]["value"])
    except json.JSONDecodeError as e:
        raise ConfigError(f"{source}: {e}") from e


def _flag(value: Any, where: str) -> bool:
    text = str(value).lower()
    if text not in ("true", "false"):
        raise ConfigError(f"{where}: required must be true or false, got {value!r}")
    return text == "true"


def _required_paths(name: str, descriptor: Mapping[str, Any]) -> list[str]:
    """``name`` itself and its described children, as dotted paths, where required."""
    paths = [name] if _flag(descriptor.get("required", "false"), name) else []
    for child, value in descriptor.items():
        if isinstance(value, Mapping):
            paths += _required_paths(f"{name}.{child}", value)
    return paths


@dataclass(frozen=True)
class TableModel:
    """Columns, types and required paths of one table.

    ``schema`` is the Spark schema (every field nullable, since whether a null is
    acceptable is for the rules to say); ``required`` lists column names and dotted
    paths below struct columns.
    """

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, source: str | PathLike | Mapping[str, Any], name: str = "table") -> TableModel:
        config = load_json(source)
        if not isinstance(config.get("schema"), Mapping):
            raise ConfigError(f"model of {name} has no 'schema' object")
        fields, required = [], []
        for column, descriptor in config["schema"].items():
            if not isinstance(descriptor, Mapping) or not isinstance(descriptor.get("type"), str):
                raise ConfigError(f"model of {name}: column {column} has no type")
            fields.append(T.StructField(column, parse_type(descriptor["type"])))
            required += _required_paths(column, descriptor)
        return cls(name, T.StructType(fields), tuple(required))

    def required_columns(self, nested: bool = True) -> list[str]:
        """Required paths; ``nested=False`` leaves out those below a struct column."""
        return [p for p in self.required if nested or p in self.schema.names]
