"""Reading feeds: readiness, formats, declared or inferred schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feedquality.errors import ConfigError, EmptyFeedError, MissingFeedError
from feedquality.functions.columns import quoted
from feedquality.operators.quality import FAILED_RULES
from feedquality.session import stage

# File extensions and the formats they stand for.
FORMATS = {"json": "json", "csv": "csv", "txt": "text", "text": "text", "parquet": "parquet"}

# How CSV is read unless a source says otherwise. Nothing between two commas
# is a null, two quotes are an empty text, and blanks belong to the value.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
       "nullValue": "\x1f", "emptyValue": ""}

CORRUPT = "_corrupt_record"

# What the text of an unparsable line is called once it is set aside; Spark's own name
# for it would be taken for a parse failure when the quarantine is read back.
RAW_RECORD = "raw_record"


def format_of(path: str) -> str:
    """Format by the text after the last dot of ``path``."""
    return source_format(path.rstrip("/").rsplit(".", 1)[-1])


def source_format(name: str) -> str:
    try:
        return FORMATS[name.lower()]
    except KeyError:
        raise ConfigError(f"no reader for {name!r}; known: {', '.join(FORMATS)}") from None


@dataclass(frozen=True)
class SourceSpec:
    """One feed. ``path`` may be a file, a directory or a glob.

    ``mode="declared"`` reads with ``schema``: one pass, and a JSON or CSV line that does
    not fit arrives with its text in ``_corrupt_record``, for :func:`split_corrupt` to set
    aside. ``mode="infer"`` lets
    Spark work the schema out, at the price of a pass over the whole feed, and is the
    mode that notices columns the model does not know.
    """

    path: str
    format: str = ""
    schema: T.StructType | None = None
    mode: str = "declared"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "format", source_format(self.format) if self.format else format_of(self.path))
        if self.mode not in ("declared", "infer"):
            raise ConfigError(f"mode must be 'declared' or 'infer', got {self.mode!r}")
        if self.mode == "declared" and self.schema is None and self.format in ("json", "csv"):
            raise ConfigError(f"{self.path}: declared mode needs a schema")


def sources_from(paths: str, names: Iterable[str], schemas: Mapping[str, T.StructType] | None = None,
                 **options) -> dict[str, SourceSpec]:
    """Sources for a comma-separated list of paths, given to ``names`` in order; ``schemas`` are by name."""
    names, parts = list(names), [p.strip() for p in paths.split(",")]
    if len(parts) != len(names):
        raise ConfigError(f"expected {len(names)} paths ({', '.join(names)}), got {len(parts)}")
    return {name: SourceSpec(path, **options, **({"schema": schemas[name]} if schemas else {}))
            for name, path in zip(names, parts)}


def read_table(spark: SparkSession, source: SourceSpec) -> DataFrame:
    reader = spark.read.options(**source.options)
    declared = source.mode == "declared"
    if source.format == "text":
        return reader.text(source.path)
    if source.format == "parquet":
        if declared and source.schema is not None:
            reader = reader.schema(source.schema)
        return reader.parquet(source.path)
    if declared:
        reader = (reader.schema(T.StructType([*source.schema.fields, T.StructField(CORRUPT, T.StringType())]))
                  .option("columnNameOfCorruptRecord", CORRUPT))
    reader = reader.option("mode", "PERMISSIVE")
    if source.format == "json":
        return reader.json(source.path)
    for name, value in CSV.items():
        reader = reader.option(name, source.options.get(name, value))
    if declared:
        # match the header line against the declared names instead of trusting the order
        return reader.option("enforceSchema", source.options.get("enforceSchema", "false")).csv(source.path)
    return reader.option("inferSchema", "true").csv(source.path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The parsed rows, and the unparsable ones with their text in ``raw_record``.

    Spark parses only the columns a query needs, so on the raw feed a line would count as
    unparsable in one query and as fine in the next. The feed is therefore parsed once,
    whole, into the shared folder, and both frames read that copy.
    """
    if CORRUPT not in df.columns:
        return df, None
    parsed = stage(df, "parsed")
    columns = [F.col(quoted(c)) for c in df.columns if c != CORRUPT]
    good = parsed.where(F.col(CORRUPT).isNull()).select(*columns)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(
        *columns, F.col(CORRUPT).alias(RAW_RECORD), F.array(F.lit("corrupt_record")).alias(FAILED_RULES))
    return good, bad


def header_names(spark: SparkSession, source: SourceSpec) -> list[str] | None:
    """The names in the header of a CSV feed, which may not be those declared; ``None`` without a header."""
    if str(source.options.get("header", CSV["header"])).lower() != "true":
        return None
    return spark.read.options(**{**CSV, **source.options}).csv(source.path).columns


def feed_listing(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``(path, length)`` of the non-empty files below ``paths``, without reading them."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").load(paths)
            .select("path", "length").where(F.col("length") > 0))


def feed_ready(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds at least one non-empty file."""
    try:
        require_feed(spark, path)
    except (MissingFeedError, EmptyFeedError):
        return False
    return True


def require_feed(spark: SparkSession, path: str) -> None:
    """Raise unless ``path`` exists and holds at least one non-empty file."""
    try:
        empty = feed_listing(spark, path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingFeedError(path) from e
    if empty:
        raise EmptyFeedError(path)
