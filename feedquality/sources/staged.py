"""Parsing, profiling, measuring and staging a feed in one pass.

The pass that parses a declared feed and writes it to the shared folder also takes, as
aggregates attached to that write, what the gate and the report need: the names and types
that the lines use, how many lines there are and how many can't be parsed, and the counts of
the row rules. The write is one stage, and Spark adds a finished task's aggregates once,
however often the task was tried.

The profile has a fixed size. For each name that the model declares, at any depth, there is a
set of bits for the types that its values have, and for each object the first and the last of
the names that the model doesn't have. So a feed keyed by ids can't fill the driver.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from feedquality.functions.columns import quoted
from feedquality.model import TableModel
from feedquality.operators.quality import FAILED_RULES, rule_metrics, with_members
from feedquality.operators.schema_gate import SchemaProblem, SchemaReport, check_names, check_schema
from feedquality.rules import RuleSet
from feedquality.session import stage
from feedquality.sources.feeds import CORRUPT, RAW_RECORD, SourceSpec, header_names, read_table

# The types of JSON values, each with a bit of its own from 1 on; bit 0 is any other.
KINDS = ("VOID", "STRING", "BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN", "OBJECT", "ARRAY")
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")

# Reader options that are about files and lines, not about what a line holds.
LINE_OPTIONS = ("linesep", "encoding", "charset", "compression", "recursivefilelookup", "pathglobfilter",
                "modifiedbefore", "modifiedafter", "ignorecorruptfiles", "ignoremissingfiles")

# Fixed value: a reader option that would let in texts which strict JSON does not.
LENIENT = "allowunquotedcontrolchars"

# Longer lines are left to the parser, which has limits of its own on the sizes of texts and variants.
ORDINARY_BYTES = 1024 * 1024

# Patterns of the blanks between the parts of a line and of a text.
BLANKS, TEXT = " *+", r'"[^"\\]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\]*+)*+"'

# Encodings besides UTF-8 that Spark decodes in an expression.
ENCODINGS = ("US-ASCII", "ISO-8859-1", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32")


@dataclass(frozen=True)
class Node:
    """A declared name, or the values of an array or a map, and what to look for in a line, as SQL:
    ``kinds`` has a bit for each type met, ``others`` the names of objects that the model lacks."""

    path: str
    type: T.DataType
    kinds: str
    others: str | None
    required: bool
    parent: int | None


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(value: str) -> str:
    """The bit of a value's type; null where there is no value."""
    names = ", ".join(map(_text, KINDS))
    name = f"substring_index(substring_index(schema_of_variant({value}), '<', 1), '(', 1)"
    return f"shiftleft(1L, cast(array_position(array({names}), {name}) as int))"


def _objects(value: str) -> str:
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def _elements(value: str) -> str:
    return f"try_variant_get({value}, '$', 'array<variant>')"


def bit(kind: str) -> int:
    return 1 << (KINDS.index(kind) + 1)


def profile_nodes(schema: T.StructType, record: str) -> list[Node]:
    """What to look for in a line whose JSON is the variant column ``record``."""
    nodes: list[Node] = []

    def visit(path: str, data_type: T.DataType, value: str, many: bool, required: bool, parent: int | None) -> None:
        """``value`` is a variant, or with ``many`` an array of them."""
        def each(f: Callable[[str], str], v: str = value) -> str:
            return f"filter(transform({v}, x -> {f('x')}), x -> x is not null)" if many else f(v)

        def flat(v: str) -> str:
            return f"flatten({v})" if many else v

        # a parsed record is an object, so there is nothing to find out
        kinds = "0L" if parent is None else f"aggregate({each(_kind)}, 0L, (a, k) -> a | k)" if many else _kind(value)
        others, at, maps = None, len(nodes), each(_objects)
        if isinstance(data_type, T.StructType):
            names = f"cast(array({', '.join(map(_text, data_type.names))}) as array<string>)"
            others = flat(each(lambda m: f"array_except(map_keys({m}), {names})", maps))
        nodes.append(Node(path, data_type, kinds, others, required, parent))
        if isinstance(data_type, T.StructType):
            for f in data_type.fields:
                child = each(lambda m, name=f.name: f"try_element_at({m}, {_text(name)})", maps)
                visit(f"{path}.{f.name}" if path else f.name, f.dataType, child, many, True, at)
        elif isinstance(data_type, T.ArrayType):
            visit(f"{path}[]", data_type.elementType, flat(each(_elements)), True, False, at)
        elif isinstance(data_type, T.MapType):
            visit(f"{path}{{}}", data_type.valueType, flat(each(lambda m: f"map_values({m})", maps)), True, False, at)

    visit("", schema, record, False, True, None)
    return nodes


def allowed_kinds(data_type: T.DataType) -> tuple[str, ...]:
    """JSON types that stand for a declared type. Whether a value fits it, a parsed line shows for itself."""
    if isinstance(data_type, T.StructType | T.MapType):
        kinds: tuple[str, ...] = ("OBJECT",)
    elif isinstance(data_type, T.ArrayType):
        kinds = ("ARRAY",)
    elif isinstance(data_type, T.BooleanType):
        kinds = ("BOOLEAN",)
    elif isinstance(data_type, T.FloatType | T.DoubleType):
        kinds = (*NUMBERS, "STRING")  # not-a-number and infinities are texts
    elif isinstance(data_type, T.NumericType):
        kinds = NUMBERS
    elif isinstance(data_type, T.VariantType):
        kinds = KINDS
    else:
        kinds = ("STRING",)  # texts, times and binaries
    return ("VOID", *kinds)


def profile_metrics(nodes: Sequence[Node], among: Column) -> list[Column]:
    """The aggregates that make up a profile, over the lines that ``among`` holds for."""
    columns = []
    for i, node in enumerate(nodes):
        columns.append(F.bit_or(F.when(among, F.col(f"__kinds{i}"))).alias(f"kinds_{i}"))
        if node.others is not None:
            others = F.when(among, F.col(f"__others{i}"))
            columns += [F.min(F.array_min(others)).alias(f"least_{i}"), F.max(F.array_max(others)).alias(f"last_{i}")]
    return columns


def profile_columns(nodes: Sequence[Node]) -> list[Column]:
    """The nodes' expressions, as columns of the line; names that the model lacks only where there are any."""
    return [F.expr(text) for i, node in enumerate(nodes) for text in (
        f"{node.kinds} as __kinds{i}", *([f"nullif({node.others}, array()) as __others{i}"] if node.others is not None else []))]


def profile_problems(nodes: Sequence[Node], model: TableModel, found: Mapping[str, object]) -> Iterator[SchemaProblem]:
    """Where a profile differs from the model: names that no line has, types that don't fit, names it doesn't know."""
    seen = [found.get(f"kinds_{i}") or 0 for i in range(len(nodes))]
    for i, node in enumerate(nodes):
        if node.parent is not None:
            wanted = node.type.simpleString()
            wrong = [k for k in KINDS if seen[i] & bit(k) and k not in allowed_kinds(node.type)]
            wrong += ["other"] * (seen[i] & 1)
            in_use = node.parent == 0 or seen[node.parent] & bit("OBJECT")
            if not seen[i] and node.required and in_use:
                yield SchemaProblem(model.name, node.path, wanted, None, "missing column")
            elif wrong:
                yield SchemaProblem(model.name, node.path, wanted, "|".join(k.lower() for k in wrong), "type mismatch")
        for name in sorted({found.get(f"least_{i}"), found.get(f"last_{i}")} - {None}):
            yield SchemaProblem(model.name, f"{node.path}.{name}".lstrip("."), None, "in the feed", "unexpected column")


@dataclass(frozen=True)
class StagedFeed:
    """A feed as it was staged. ``rows`` are the parsed ones and ``corrupt`` the others, with their text in
    ``raw_record``; ``counts`` are those of :func:`~feedquality.operators.quality.rule_metrics` over all rules."""

    rows: DataFrame
    gate: SchemaReport
    corrupt: DataFrame | None = None
    lines: int | None = None
    bad: int = 0
    counts: Mapping[str, int] | None = field(default=None)


def ordinary_value(data_type: T.DataType) -> tuple[str, str] | None:
    """The type of JSON values that stands for a declared type, and a pattern for its plain form."""
    if isinstance(data_type, T.IntegralType):
        return "BIGINT", "-?(?:0|[1-9][0-9]{0,17}+)"
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN", "(?:true|false)"
    return ("STRING", TEXT) if allowed_kinds(data_type) == ("VOID", "STRING") else None


def ordinary_line(schema: T.StructType) -> str | None:
    """A pattern for lines that need no profile of their own, or ``None`` if the schema has other types than texts,
    whole numbers and truth values.

    Such a line, if ``from_json`` takes it, is a strict JSON object of declared names, none of them twice, each with
    a null or a plain value of its type. The names may come in any order; if it is not the declared one, none
    may follow that a group holds already.
    """
    values = [ordinary_value(f.dataType) for f in schema.fields]
    if not values or None in values or any(re.search(r'["\\\x00-\x1f]', n) for n in schema.names):
        return None
    names = [f'"{re.escape(n)}"' for n in schema.names]
    held = [f"{BLANKS}:{BLANKS}(?:{v}|null){BLANKS}" for _, v in values]
    taken = "|".join(f"\\k<n{i}>" for i in range(len(names)))
    declared = "".join(f'(?:{n}{v}(?:,{BLANKS}(?=")|(?=\\}})))?+' for n, v in zip(names, held))
    members = "|".join(f"(?<n{i}>{n}){v}" for i, (n, v) in enumerate(zip(names, held)))
    another = f'(?:(?:{members})(?:,{BLANKS}(?!{taken})(?=")|(?=\\}})))*+'
    return f"\\A{BLANKS}\\{{{BLANKS}(?:{declared}\\}}|{another}\\}}){BLANKS}\\z"


def ordinary_kinds(field: T.StructField) -> Column:
    """The bit of the type that a name has in an ordinary line. No text holds a whole name in quotes, as its own have an
    escape before them, and one that ends like that has no colon after it."""
    held = F.col("text").contains(f'"{field.name}"') & F.col("text").rlike(f'"{re.escape(field.name)}"{BLANKS}:')
    value = F.col("__row").getField(field.name)
    return F.when(value.isNotNull(), F.lit(bit(ordinary_value(field.dataType)[0]))).when(held, F.lit(bit("VOID"))).cast("bigint")


def json_records(spark: SparkSession, source: SourceSpec, schema: T.StructType) -> DataFrame:
    """The lines of a JSON feed as ``(text, ordinary, record)``, the latter null for what is no JSON and for ordinary
    lines, whose pattern tells what there is to know. Blank lines are none, and a line that is an array is as many
    records as it has elements."""
    about_lines = {k: v for k, v in source.options.items() if k.lower() in LINE_OPTIONS}
    lines = spark.read.options(**about_lines).text(source.path)
    if encoding_of(source) is not None:
        # lines are cut by the encoding, but come as they are
        lines = lines.select(F.decode(F.col("value").cast("binary"), encoding_of(source)).alias("value"))
    pattern = ordinary_line(schema)
    ordinary = F.lit(False) if pattern is None else (F.octet_length("value") <= ORDINARY_BYTES) & F.col("value").rlike(pattern)
    lines = lines.where(F.ltrim("value", F.lit(" \t\n\x0b\f\r")) != "").select("value", ordinary.alias("ordinary"))
    lines = lines.select("value", "ordinary", F.when(~F.col("ordinary"), F.try_parse_json("value")).alias("record"))
    # a line that is no array passes as it is, with no element
    lines = lines.select("value", "ordinary", "record", F.explode_outer(F.expr(_elements("record"))).alias("element"))
    empty = F.col("element").isNull() & F.expr(_elements("record")).isNotNull()
    return lines.where(~empty).select(F.coalesce(F.to_json("element"), "value").alias("text"), "ordinary",
                                      F.coalesce("element", "record").alias("record"))


def encoding_of(source: SourceSpec) -> str | None:
    """The encoding that a source names, in capitals, unless it is Spark's own."""
    named = next((v.upper() for k, v in source.options.items() if k.lower() in ("encoding", "charset")), "UTF-8")
    return None if named in ("UTF-8", "UTF8") else named


def by_lines(source: SourceSpec) -> bool:
    """Whether each line of a JSON feed can be read by itself, as text."""
    several = next((v for k, v in source.options.items() if k.lower() == "multiline"), "false")
    return str(several).lower() != "true" and encoding_of(source) in (None, *ENCODINGS)


def parsed_json(spark: SparkSession, source: SourceSpec, model: TableModel) -> tuple[DataFrame, list[Node]]:
    """The records of a JSON feed with the model's columns, ``_corrupt_record``, and what the profile is made of."""
    nodes = profile_nodes(model.schema, "record")
    options = {k: v for k, v in source.options.items() if k.lower() not in (*LINE_OPTIONS, LENIENT)}
    schema = T.StructType([*model.schema.fields, T.StructField(CORRUPT, T.StringType())])
    row = F.from_json("text", schema, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    unfit = F.when(~F.col("ordinary") & F.expr(f"{_objects('record')} is null"), F.col("text"))
    records = json_records(spark, source, model.schema).select(
        "text", "ordinary", row.alias("__row"), unfit.alias("__unfit"), *profile_columns(nodes))
    kept = [F.col("__row").getField(n).alias(n) for n in model.schema.names]
    corrupt = F.coalesce("__unfit", F.col("__row").getField(CORRUPT)).alias(CORRUPT)
    found = {c: F.col(c) for c in records.columns if c not in ("text", "ordinary", "__row", "__unfit")}
    if ordinary_line(model.schema) is not None:
        # the nodes are the record and its fields
        for i, f in enumerate(model.schema.fields, 1):
            found[f"__kinds{i}"] = F.when(F.col("ordinary"), ordinary_kinds(f)).otherwise(F.col(f"__kinds{i}")).alias(f"__kinds{i}")
    return records.select(*kept, corrupt, *found.values()), nodes


def stage_feed(spark: SparkSession, source: SourceSpec, model: TableModel, rules: RuleSet | None = None,
               columns: Sequence[str] | None = None) -> StagedFeed:
    """Read ``source``; a declared JSON or CSV feed is parsed, profiled, measured and staged in one pass.

    A JSON line is parsed if it is strict JSON (an object, or an array of them, without a name twice)
    and every value fits its declared type; it is judged as a whole, whichever ``columns`` are
    staged. Those default to all. The gate compares with the model what the parsed lines of a JSON
    feed hold, nested names included, the header of a CSV feed, and the schema of Parquet files.
    Objects over several lines, or in an unusual encoding, are read once more for that.
    """
    if source.mode != "declared" or source.format not in ("json", "csv"):
        rows = read_table(spark, source)
        stored = spark.read.options(**source.options).parquet(source.path) if source.format == "parquet" else rows
        return StagedFeed(rows, check_schema(stored, model))
    rules = rules or RuleSet("none", ())
    parsed, nodes = (parsed_json(spark, source, model) if source.format == "json" and by_lines(source)
                     else (read_table(spark, source), []))
    good = F.col(CORRUPT).isNull()
    kept = [F.col(quoted(c)) for c in model.schema.names if columns is None or c in columns]
    observation = Observation(f"feed-{uuid.uuid4().hex}")
    measured = with_members(parsed, rules).observe(
        observation, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("bad"),
        *rule_metrics(model.schema, list(rules), good), *profile_metrics(nodes, good))
    staged = stage(measured.select(*kept, CORRUPT), "parsed")
    found = observation.get

    if nodes:
        gate = SchemaReport(tuple(profile_problems(nodes, model, found)))
    elif source.format == "json":
        gate = _profile_of_objects(spark, source, model)
    else:
        names = header_names(spark, source)
        gate = check_names(names, model) if names is not None else SchemaReport(())
    mark = F.array(F.lit("corrupt_record")).alias(FAILED_RULES)
    return StagedFeed(
        staged.where(good).select(*kept), gate,
        staged.where(~good).select(*kept, F.col(CORRUPT).alias(RAW_RECORD), mark), found["lines"], found["bad"],
        {k: v for k, v in found.items() if k == "n" or k.startswith(("bad_", "null_"))})


def _profile_of_objects(spark: SparkSession, source: SourceSpec, model: TableModel) -> SchemaReport:
    """The gate of a JSON feed that can't be read line by line, from a pass of its own."""
    objects = spark.read.options(**source.options).option("singleVariantColumn", "record").json(source.path)
    objects = objects.select(F.explode(F.coalesce(F.expr(_elements("record")), F.array("record"))).alias("record"))
    nodes = profile_nodes(model.schema, "record")
    profile = objects.select(F.expr(f"{_objects('record')} is not null as __object"), *profile_columns(nodes))
    found = profile.agg(*profile_metrics(nodes, F.col("__object"))).first().asDict()
    return SchemaReport(tuple(profile_problems(nodes, model, found)))
