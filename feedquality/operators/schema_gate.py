"""Compare a table's schema with its model. Metadata only, no Spark job."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedquality.errors import SchemaMismatchError
from feedquality.functions.columns import same_type
from feedquality.model import TableModel


@dataclass(frozen=True)
class SchemaProblem:
    table: str
    column: str
    expected: str | None
    actual: str | None
    problem: str


@dataclass(frozen=True)
class SchemaReport:
    """Every difference found, not only the first."""

    problems: tuple[SchemaProblem, ...]

    @property
    def ok(self) -> bool:
        return not self.problems

    def require(self) -> None:
        if self.problems:
            raise SchemaMismatchError("; ".join(
                f"{p.table}.{p.column}: {p.problem} (expected {p.expected}, found {p.actual})" for p in self.problems))

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(p.table, p.column, p.expected, p.actual, p.problem) for p in self.problems]
        return spark.createDataFrame(
            rows, "table string, column string, expected string, actual string, problem string")


def check_schema(df: DataFrame, model: TableModel) -> SchemaReport:
    """Column names and types must equal the model's, whatever their order.

    Names are case-sensitive. Nested types are compared whole, so the order of fields
    inside a struct counts.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in model.schema.fields}
    problems = []
    for name, wanted in expected.items():
        if name not in actual:
            problems.append(SchemaProblem(model.name, name, wanted.simpleString(), None, "missing column"))
        elif not same_type(actual[name], wanted):
            problems.append(SchemaProblem(model.name, name, wanted.simpleString(),
                                          actual[name].simpleString(), "type mismatch"))
    for name in df.columns:
        if name not in expected:
            problems.append(SchemaProblem(model.name, name, None, actual[name].simpleString(), "unexpected column"))
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1 and c in expected})
    problems += [SchemaProblem(model.name, c, "one column", f"{df.columns.count(c)} columns", "repeated column")
                 for c in repeated]
    return SchemaReport(tuple(problems))


def check_names(names: Iterable[str], model: TableModel) -> SchemaReport:
    """The names a declared feed uses must be the model's. Case counts."""
    found, problems = set(names), []
    for f in model.schema.fields:
        if f.name not in found:
            problems.append(SchemaProblem(model.name, f.name, f.dataType.simpleString(), None, "missing column"))
    for name in sorted(found - set(model.schema.names)):
        problems.append(SchemaProblem(model.name, name, None, "in the feed", "unexpected column"))
    return SchemaReport(tuple(problems))


def check_tables(tables: Iterable[tuple[DataFrame, TableModel]]) -> SchemaReport:
    """The gate over several tables: one bad table fails them all."""
    return SchemaReport(tuple(p for df, model in tables for p in check_schema(df, model).problems))
