"""Writing results: files, catalog tables and connectors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from feedquality.errors import ConfigError
from feedquality.functions.columns import quoted, same_type
from feedquality.sources.feeds import source_format

FILE_FORMATS = ("json", "csv", "text", "parquet")

# The format word of a table of the session's catalog, and what a new one is stored as.
TABLE, TABLE_PROVIDER = "table", "parquet"

# The create dispositions.
CREATE_IF_NEEDED, CREATE_NEVER = "CREATE_IF_NEEDED", "CREATE_NEVER"

# The partition column that the rows of a run are written under.
RUN = "run_id"

# The write dispositions, which are Spark's save modes.
MODES = ("append", "overwrite", "ignore", "error", "errorifexists", "default")


# A line separator for CSV and text files whose values hold line breaks. Give it to the sink
# and to the source as the option ``lineSep``.
RECORD_SEPARATOR = "\x1e"

# Times are written to the microsecond, and CSV values as they are: blanks
# stay, a quote is doubled, nothing is written for a null and two quotes for an empty text.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIMES = {"timestampFormat": MICROSECONDS + "XXX", "timestampNTZFormat": MICROSECONDS}
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
       "nullValue": "", "emptyValue": '""'}


def save_mode(mode: str) -> str:
    if mode not in MODES:
        raise ConfigError(f"write disposition {mode!r} is not one of {', '.join(MODES)}")
    return mode


def _disposition(word: str) -> str:
    if word.upper() not in (CREATE_IF_NEEDED, CREATE_NEVER):
        raise ConfigError(f"unknown create disposition {word!r}")
    return word.upper()


@dataclass(frozen=True)
class SinkSpec:
    """Where and how to write.

    ``format`` is a file format, ``table`` for a table of the session's catalog, or a connector's
    data source name. ``mode`` defaults to ``errorifexists`` for files and ``append`` for the rest.

    Appending is not idempotent by itself: a job that runs twice writes its rows twice. With a
    ``run_id`` the rows of a file or table sink lie in a partition of that name, and appending under
    a name that is there replaces that run's rows and no other's, in the one commit of the write.

    ``create_disposition`` is for tables: ``create_if_needed``, the default, or ``create_never``,
    which fails where the table is not there and otherwise keeps it as it is.
    """

    format: str
    target: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str | None = None
    run_id: str | None = None
    create_disposition: str | None = None

    def __post_init__(self) -> None:
        if not self.format:
            raise ConfigError("a sink needs a format")
        if self.format.lower() == "txt":
            object.__setattr__(self, "format", "text")
        default = "errorifexists" if self.is_file else "append"
        object.__setattr__(self, "mode", save_mode(self.mode or default))
        if (self.is_file or self.is_table) and not self.target:
            raise ConfigError("a file sink needs a path, a table sink a name")
        if self.run_id is not None and (not (self.is_file or self.is_table) or self.mode != "append" or not self.run_id):
            raise ConfigError("a run id goes with appending to files or tables")
        if self.create_disposition is not None:
            if not self.is_table:
                raise ConfigError("a create disposition goes with a table")
            object.__setattr__(self, "create_disposition", _disposition(self.create_disposition))

    @property
    def is_file(self) -> bool:
        return self.format in FILE_FORMATS

    @property
    def is_table(self) -> bool:
        return self.format == TABLE


def _flat(schema: T.StructType, prefix: str = "", parent: Column | None = None) -> list[Column]:
    """Struct fields as ``struct_field`` columns; arrays and maps as JSON text."""
    out = []
    for f in schema.fields:
        c = F.col(quoted(f.name)) if parent is None else parent.getField(f.name)
        label = prefix + f.name
        if isinstance(f.dataType, T.StructType):
            out += _flat(f.dataType, f"{label}_", c)
        else:
            nested = isinstance(f.dataType, (T.ArrayType, T.MapType))
            out.append((F.to_json(c, {**TIMES}) if nested else c).alias(label))
    return out


def flatten(df: DataFrame) -> DataFrame:
    """A frame without nested columns, as CSV needs it."""
    columns = df.select(*_flat(df.schema))
    if len(set(columns.columns)) < len(columns.columns):
        raise ConfigError(f"flattening gives one name to two columns: {columns.columns}")
    return columns


def as_lines(df: DataFrame) -> DataFrame:
    """One string column: the only column if it is a string, else each row as JSON."""
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.StringType):
        return df.select(F.col(quoted(df.columns[0])).alias("value"))
    return df.select(F.to_json(F.struct("*"), {**TIMES}).alias("value"))


def _single_lines(df: DataFrame, line_sep: str | None) -> DataFrame:
    """``df``, where a text that holds the line separator fails the write."""
    breaks = "[\\r\\n]" if line_sep in (None, "\n", "\r", "\r\n") else f"\\Q{line_sep}\\E"

    def checked(f: T.StructField) -> Column:
        c = F.col(quoted(f.name))
        if not isinstance(f.dataType, T.StringType):
            return c
        message = f"a value of {f.name} holds the line separator; set lineSep to a character that no value holds"
        return F.when(c.rlike(breaks), F.raise_error(F.lit(message)).cast("string")).otherwise(c).alias(f.name)

    return df.select(*[checked(f) for f in df.schema.fields])


def write_table(df: DataFrame, sink: SinkSpec) -> None:
    """Write ``df``; any failure is raised.

    CSV and text files end a row at the line separator, so a text that holds it fails the
    write instead of becoming several rows. In a text file a null is an empty line.
    """
    if sink.is_table:
        write_catalog_table(df, sink)
        return
    if not sink.is_file:
        write_connector(df, sink.format, sink.options, sink.mode, sink.target)
        return
    shaped, options = df, dict(sink.options)
    if sink.format in ("csv", "text"):
        shaped = _single_lines(flatten(df) if sink.format == "csv" else as_lines(df), options.get("lineSep"))
    if sink.format in ("csv", "json"):
        options = {**TIMES, **(CSV if sink.format == "csv" else {}), **options}
    mode = sink.mode
    if sink.run_id is not None:
        if RUN in shaped.columns:
            raise ConfigError(f"a column is called {RUN!r} like the partitions of runs")
        # the commit of a dynamic overwrite replaces the partitions that it has rows for
        options["partitionOverwriteMode"], mode = "dynamic", "overwrite"
        shaped, written = _counted(shaped.withColumn(RUN, F.lit(sink.run_id)))
    writer = shaped.write.format(sink.format).options(**options).mode(mode)
    (writer if sink.run_id is None else writer.partitionBy(RUN)).save(sink.target)
    if sink.run_id is not None and not written.get["n"]:
        _drop_run(df.sparkSession, sink)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the number ``n`` of rows of it that the next action writes."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("n")), written


def _drop_run(spark: SparkSession, sink: SinkSpec) -> None:
    """Delete the partition of a run that, done again, has no rows."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    path = spark._jvm.org.apache.hadoop.fs.Path(sink.target, f"{RUN}={names.escapePathName(sink.run_id)}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_catalog_table(df: DataFrame, sink: SinkSpec) -> None:
    """Write to a table of the session's catalog, columns by name.

    A table that is not there is created, unless the disposition forbids it. One that is there keeps
    its definition: its columns must be those of ``df``, in any order. ``overwrite`` replaces its
    rows; ``errorifexists`` fails and ``ignore`` does nothing if it is there. With a run id the table
    is partitioned by it.
    """
    spark, mode = df.sparkSession, {"error": "errorifexists", "default": "errorifexists"}.get(sink.mode, sink.mode)
    if sink.run_id is not None:
        if RUN in df.columns:
            raise ConfigError(f"a column is called {RUN!r} like the partitions of runs")
        df = df.withColumn(RUN, F.lit(sink.run_id))
    if not spark.catalog.tableExists(sink.target):
        if sink.create_disposition == CREATE_NEVER:
            raise ConfigError(f"table {sink.target} is not there and is not to be created")
        writer = df.writeTo(sink.target).using(TABLE_PROVIDER)
        for name, value in sink.options.items():
            writer = writer.option(name, value)
        (writer if sink.run_id is None else writer.partitionedBy(F.col(RUN))).create()
        return
    if mode == "ignore":
        return
    if mode == "errorifexists":
        raise ConfigError(f"table {sink.target} is there already")
    there = spark.table(sink.target).schema
    names = {f.name: f.dataType for f in df.schema}
    if set(there.names) != set(names) or any(not same_type(f.dataType, names[f.name]) for f in there):
        raise ConfigError(f"table {sink.target} is {there.simpleString()}, and the rows are {df.schema.simpleString()}")
    # by position, so in the table's order; an overwrite of the rows leaves the table as it is
    if sink.run_id is None:
        df.select(*[F.col(quoted(c)) for c in there.names]).write.mode(mode).insertInto(sink.target)
        return
    columns = ", ".join(quoted(c) for c in there.names if c != RUN)
    run = sink.run_id.replace("\\", "\\\\").replace("'", "\\'")
    text = f"insert overwrite table {sink.target} partition ({RUN} = '{run}') select {columns} from "
    spark.sql(text.replace("{", "{{").replace("}", "}}") + "{rows}", rows=df)


def write_connector(df: DataFrame, format: str, options: Mapping[str, str], mode: str = "append",
                    target: str = "") -> None:
    """Write through any data source the session has on its class path."""
    writer = df.write.format(format).options(**options).mode(save_mode(mode))
    writer.save(target) if target else writer.save()


def bigquery_sink(table: str, create_disposition: str | None = None, mode: str | None = None,
                  project: str | None = None) -> SinkSpec:
    """A warehouse table; ``create_disposition`` is ``create_if_needed`` or ``create_never``."""
    options = {"table": table}
    if create_disposition:
        options["createDisposition"] = _disposition(create_disposition)
    if project:
        options["project"] = project
    return SinkSpec("bigquery", options=options, mode=mode)


def mongo_sink(collection: str, connection_uri: str, mode: str | None = None) -> SinkSpec:
    """A document collection, ``database.collection`` appended to the connection URI.
    Struct columns become sub-documents, and a collection is created when it is missing."""
    return SinkSpec("mongodb", options={"spark.mongodb.write.connection.uri": connection_uri + collection}, mode=mode)


def sink_for(kind: str, target: str, file_format: str | None = None, connection_uri: str | None = None,
             write_disposition: str | None = None, create_disposition: str | None = None,
             run_id: str | None = None) -> SinkSpec:
    """A sink by its command-line word: ``file``, ``bq`` or ``mongo`` (fixed values), or ``table``."""
    if kind == "file":
        extension = file_format or target.rstrip("/").rsplit(".", 1)[-1]
        return SinkSpec(source_format(extension), target, mode=write_disposition, run_id=run_id)
    if kind == TABLE:
        return SinkSpec(TABLE, target, mode=write_disposition, run_id=run_id, create_disposition=create_disposition)
    if run_id is not None:
        raise ConfigError(f"a {kind} sink takes no run id")
    if kind == "bq":
        return bigquery_sink(target, create_disposition, write_disposition, connection_uri)
    if kind == "mongo":
        return mongo_sink(target, connection_uri or "", write_disposition)
    raise ConfigError(f"unknown sink {kind!r}; known: file, bq, mongo, table")
