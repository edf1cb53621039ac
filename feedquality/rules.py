"""Declarative data-quality rules and their compilation to column predicates.

A suite is a JSON object::

    {"expectation_suite_name": "...",
     "expectations": [
        {"expectation_name": "ExpectColumnValuesToNotBeNull",
         "args": {"column": "user_id", "mostly": 1},
         "meta": {"discard_row_on_failure": true, "discard_column_on_failure": false}}]}

Three scopes:

* *row* rules compile to a predicate that is true for a good row;
* the *unique* rule needs the whole column, so it has no row predicate of its own;
* *table* rules look at the schema only and start no Spark job.

A null is not evaluated by a rule about values, so it is always good there; finding
nulls is what the not-null rule is for. The two null rules evaluate every row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from decimal import Decimal
from enum import Enum
from functools import reduce
from operator import and_, or_
from os import PathLike
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.errors import ConfigError
from feedquality.functions.columns import column_at, column_text, field_type, parse_type, quoted, same_type
from feedquality.model import TableModel, load_json


# Where a predicate finds its column as SQL text, and its marker, among the arguments.
COLUMN = "column as text"
MARKER = "marker"


class OnFailure(str, Enum):
    NONE = "none"
    DISCARD_ROW = "discard_row"
    DISCARD_COLUMN = "discard_column"


class Scope(str, Enum):
    ROW = "row"
    UNIQUE = "unique"
    TABLE = "table"


def _as_text(c: Column, dt: T.DataType) -> Column:
    return c if isinstance(dt, T.StringType) else c.cast("string")


def _length_equals(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    return F.length(_as_text(c, dt)) == F.lit(a["value"])


def _in_bounds(value: Column, low: Any, high: Any) -> Column:
    """Inclusive range; a bound of ``None`` is open."""
    if low is None and high is None:
        raise ConfigError("a range rule needs at least one bound")
    bounds = []
    if low is not None:
        bounds.append(value >= F.lit(low))
    if high is not None:
        bounds.append(value <= F.lit(high))
    return reduce(and_, bounds)


def _length_between(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    return _in_bounds(F.length(_as_text(c, dt)), a["min_value"], a["max_value"])


# A number written out: a sign, digits, a point, digits. What has an exponent is read as a double.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def _text_bound(c: Column, bound: int | Decimal, low: bool) -> Column:
    """Whether the number that a text writes out is on the right side of ``bound``, to the last digit.

    The point is moved right by as many places as the bound has; then the whole part is
    compared, rounded down for a lower and up for an upper bound.
    """
    sign, digits, exponent = Decimal(bound).as_tuple()
    places = max(0, -exponent)
    limit = int("".join(map(str, digits)) + "0" * max(0, exponent)) * (-1 if sign else 1)
    text = F.trim(c)
    negative = text.startswith("-")
    fraction = F.regexp_extract(text, r"\.(\d*)$", 1)
    moved = F.concat(F.regexp_extract(text, r"^[+-]?(\d*)", 1), F.rpad(F.left(fraction, F.lit(places)), places, "0"))
    moved = F.regexp_replace(moved, "^0+", "")
    size = F.concat(F.lit("0"), moved).try_cast("decimal(38,0)")
    whole = F.when(negative, -size).otherwise(size)
    more = F.substring(fraction, places + 1, 1 << 30).rlike("[1-9]").cast("int")
    if len(str(abs(limit))) > 37:
        raise ConfigError(f"a bound has more digits than a decimal: {bound}")
    limit = F.lit(Decimal(limit))
    inside = (whole - F.when(negative, more).otherwise(0) >= limit if low
              else whole + F.when(negative, 0).otherwise(more) <= limit)
    outside = F.length(moved) > 37  # larger than any bound
    return F.when(outside, negative != F.lit(low)).otherwise(inside)


def _value_between(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    """A text under numeric bounds is read as a number; what can't be read is out of bounds.

    Whole and decimal bounds are compared with the digits as they are written, a bound that is
    a float as a double.
    """
    low, high = a.get("min", a.get("min_value")), a.get("max", a.get("max_value"))
    numbers = any(isinstance(b, (int, float, Decimal)) and not isinstance(b, bool) for b in (low, high))
    if not (isinstance(dt, T.StringType) and numbers):
        return _in_bounds(c, low, high)
    number = c.try_cast("double")
    bounds = []
    for bound, is_low in ((low, True), (high, False)):
        if bound is None:
            continue
        rough = number >= F.lit(float(bound)) if is_low else number <= F.lit(float(bound))
        exact = isinstance(bound, (int, Decimal))
        bounds.append(F.when(F.trim(c).rlike(PLAIN_NUMBER), _text_bound(c, bound, is_low)).otherwise(rough) if exact else rough)
    return F.coalesce(reduce(and_, bounds), F.lit(False))


def _matches(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    return _as_text(c, dt).rlike(a["regex"])


def _matches_list(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    """``any``: one search hits; ``all``: every search hits, each at a place of its own."""
    if not a["regex_list"]:
        raise ConfigError("regex_list is empty")
    joins = {"any": or_, "all": and_}
    if a["match_on"] not in joins:
        raise ConfigError(f"match_on must be 'any' or 'all', got {a['match_on']!r}")
    return reduce(joins[a["match_on"]], [_as_text(c, dt).rlike(r) for r in a["regex_list"]])


def _member(v: Any, dt: T.DataType) -> str | None:
    """A set member as SQL next to a column of type ``dt``, or ``None`` when no value of that type equals it."""
    if isinstance(dt, T.NumericType):
        if isinstance(v, bool) or isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
            return None
        if isinstance(v, int):
            return f"{v}L" if abs(v) < 2 ** 63 else f"{v}BD" if abs(v) < 10 ** 38 else None
        if isinstance(v, float):
            return f"{v!r}D"
    text = v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)
    literal = "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return literal if isinstance(dt, T.StringType) else f"try_cast({literal} as {dt.simpleString()})"


def member_marker(rule_id: str) -> str:
    """The column that says whether a row's value is in a set that is a table."""
    return f"__member({rule_id})"


def _in_set(c: Column, dt: T.DataType, a: Mapping[str, Any]) -> Column:
    """Membership, as one SQL text however long the list; Spark looks up long lists by hash.
    A set that is a table has been joined beforehand."""
    if not isinstance(a["value_set"], (list, tuple, set, frozenset)):
        return F.col(quoted(a[MARKER]))
    members = [m for m in (_member(v, dt) for v in a["value_set"] if v is not None) if m is not None]
    if not members:
        return F.lit(False)
    return F.coalesce(F.expr(f"{a[COLUMN]} in ({', '.join(members)})"), F.lit(False))


@dataclass(frozen=True)
class Kind:
    """What one expectation name means."""

    scope: Scope
    args: tuple[str, ...] = ()
    predicate: Callable[[Column, T.DataType, Mapping[str, Any]], Column] | None = None
    sees_nulls: bool = False


# The expectation names and argument keys that suites are written in.
KINDS: dict[str, Kind] = {
    "ExpectColumnValueLengthsToEqual": Kind(Scope.ROW, ("value",), _length_equals),
    "ExpectColumnValueLengthsToBeBetween": Kind(Scope.ROW, ("min_value", "max_value"), _length_between),
    "ExpectColumnToExist": Kind(Scope.TABLE),
    "ExpectColumnValuesToMatchRegexList": Kind(Scope.ROW, ("regex_list", "match_on"), _matches_list),
    "ExpectColumnValuesToMatchRegex": Kind(Scope.ROW, ("regex",), _matches),
    "ExpectColumnValuesToBeUnique": Kind(Scope.UNIQUE),
    "ExpectColumnValuesToBeOfType": Kind(Scope.TABLE, ("type",)),
    "ExpectColumnValuesToBeNull": Kind(Scope.ROW, (), lambda c, dt, a: c.isNull(), sees_nulls=True),
    "ExpectColumnValuesToBeInSet": Kind(Scope.ROW, ("value_set",), _in_set),
    "ExpectColumnValuesToNotBeNull": Kind(Scope.ROW, (), lambda c, dt, a: c.isNotNull(), sees_nulls=True),
    "ExpectColumnValuesToBeBetween": Kind(Scope.ROW, (), _value_between),
}


@dataclass(frozen=True)
class Rule:
    expectation: str
    column: str
    args: Mapping[str, Any]
    mostly: float = 1.0
    on_failure: OnFailure = OnFailure.NONE
    rule_id: str = ""

    def __post_init__(self) -> None:
        if self.expectation not in KINDS:
            raise ConfigError(f"unknown expectation {self.expectation!r}")
        missing = [k for k in KINDS[self.expectation].args if k not in self.args]
        if missing:
            raise ConfigError(f"{self.expectation} on {self.column}: missing {', '.join(missing)}")
        if not 0.0 <= self.mostly <= 1.0:
            raise ConfigError(f"{self.expectation} on {self.column}: mostly must lie in [0, 1]")
        if self.expectation == "ExpectColumnValuesToBeOfType":
            parse_type_name(self.args["type"])
        if isinstance(self.args.get("value_set"), str):
            raise ConfigError(f"{self.expectation} on {self.column}: value_set is a list, a table, or {{'path': ..., 'column': ...}}")
        if isinstance(self.args.get("value_set"), Mapping) and not {"path", "column"} <= set(self.args["value_set"]):
            raise ConfigError(f"{self.expectation} on {self.column}: a value_set that is stored needs path and column")
        if not self.rule_id:
            object.__setattr__(self, "rule_id", f"{self.expectation}({self.column})")

    @property
    def kind(self) -> Kind:
        return KINDS[self.expectation]

    @property
    def scope(self) -> Scope:
        return self.kind.scope

    @property
    def member_table(self) -> Mapping[str, str] | DataFrame | None:
        """Where the members are, for a set that is a table: a frame of one column, or a path and a column."""
        found = self.args.get("value_set")
        return found if isinstance(found, (Mapping, DataFrame)) else None

    def applies_to(self, schema: T.StructType) -> bool:
        """Whether the column is there to be evaluated."""
        return field_type(schema, self.column) is not None

    def good(self, schema: T.StructType) -> Column:
        """True or false, never null, for each row.

        Written as ``c IS NULL OR p(c)``, which file sources can take as a pushed filter.
        """
        dt = field_type(schema, self.column)
        c = column_at(schema, self.column)
        p = self.kind.predicate(c, dt, {
            **self.args, COLUMN: column_text(schema, self.column), MARKER: member_marker(self.rule_id)})
        return p if self.kind.sees_nulls else c.isNull() | p

    def holds_for(self, schema: T.StructType) -> bool:
        """Verdict of a table rule."""
        actual = field_type(schema, self.column)
        if self.expectation == "ExpectColumnToExist":
            return actual is not None
        return actual is not None and type_matches(actual, self.args["type"])

    @classmethod
    def from_dict(cls, entry: Mapping[str, Any]) -> Rule:
        try:
            name, args = entry["expectation_name"], dict(entry["args"])
            column = args.pop("column")
        except KeyError as e:
            raise ConfigError(f"rule {entry!r} has no {e.args[0]}") from e
        meta = entry.get("meta", {})
        if meta.get("discard_row_on_failure", False):
            action = OnFailure.DISCARD_ROW
        elif meta.get("discard_column_on_failure", False):
            action = OnFailure.DISCARD_COLUMN
        else:
            action = OnFailure.NONE
        mostly = args.pop("mostly", None)
        return cls(name, column, args, 1.0 if mostly is None else float(mostly), action,
                   meta.get("rule_id", ""))


def parse_type_name(name: str) -> T.DataType | type:
    """A class name stands for every parameterisation of it, as ``DecimalType`` does."""
    cls = getattr(T, name, None) if name.endswith("Type") else None
    return cls if isinstance(cls, type) and issubclass(cls, T.DataType) else parse_type(name)


def type_matches(actual: T.DataType, expected: str) -> bool:
    wanted = parse_type_name(expected)
    return isinstance(actual, wanted) if isinstance(wanted, type) else same_type(actual, wanted)


@dataclass(frozen=True)
class RuleSet:
    """Rules in suite order, each with an id of its own."""

    name: str
    rules: tuple[Rule, ...]

    def __post_init__(self) -> None:
        seen: dict[str, int] = {}
        unique = []
        for r in self.rules:
            seen[r.rule_id] = seen.get(r.rule_id, 0) + 1
            n = seen[r.rule_id]
            unique.append(r if n == 1 else replace(r, rule_id=f"{r.rule_id}#{n}"))
        object.__setattr__(self, "rules", tuple(unique))

    def __iter__(self) -> Iterator[Rule]:
        return iter(self.rules)

    def of(self, *scopes: Scope) -> list[Rule]:
        return [r for r in self.rules if r.scope in scopes]

    def with_rules(self, rules: Iterable[Rule]) -> RuleSet:
        return RuleSet(self.name, (*self.rules, *rules))

    @classmethod
    def from_json(cls, source: str | PathLike | Mapping[str, Any]) -> RuleSet:
        """Compile a suite; an unknown name or a missing argument is an error."""
        config = load_json(source)
        if "expectations" not in config:
            raise ConfigError("suite has no 'expectations'")
        return cls(config.get("expectation_suite_name", "suite"),
                   tuple(Rule.from_dict(e) for e in config["expectations"]))


def required_rules(model: TableModel, nested: bool = True,
                   on_failure: OnFailure = OnFailure.DISCARD_ROW) -> RuleSet:
    """One not-null rule per required column of ``model``."""
    return RuleSet(f"{model.name}_required", tuple(
        Rule("ExpectColumnValuesToNotBeNull", path, {}, on_failure=on_failure, rule_id=f"required({path})")
        for path in model.required_columns(nested)))
