"""The feed job: gate, read, check, clean, total per key, join, total per group, write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedquality.errors import CorruptFeedError
from feedquality.model import TableModel
from feedquality.operators.joins import HOT_KEY_ROWS, is_small, join_tables
from feedquality.operators.quality import REPORT_SCHEMA, CleanResult, clean, log_failures
from feedquality.operators.rollup import group_agg
from feedquality.operators.schema_gate import SchemaReport
from feedquality.rules import RuleSet, Scope
from feedquality.session import stage
from feedquality.sinks.writers import SinkSpec, write_table
from feedquality.sources.feeds import CORRUPT, SourceSpec, require_feed
from feedquality.sources.staged import stage_feed


@dataclass(frozen=True)
class FeedSpec:
    """One feed with the model it must fit and the rules its rows must pass."""

    source: SourceSpec
    model: TableModel
    rules: RuleSet


@dataclass(frozen=True)
class JobSpec:
    """Totals of ``measure`` per ``group``: facts are summed per ``key``, joined to the
    dimension, and summed again.

    A declared JSON or CSV feed is read once: the pass that stages it also profiles and measures
    it, and only the columns that the job needs are staged. An inferred one is staged when
    more than one pass will read it. ``max_corrupt`` is the share of a declared feed's
    lines that may be unparsable; by default none may, unless the feed has a quarantine.
    """

    dimension: FeedSpec
    fact: FeedSpec
    key: str = "user_id"
    measure: str = "Quantity"
    group: str = "user_address"
    mode: str = "predicate"
    sink: SinkSpec | None = None
    reports: SinkSpec | None = None
    quarantine: Mapping[str, SinkSpec] = field(default_factory=dict)
    max_corrupt: float | None = None

    def tolerated(self, name: str) -> float:
        return self.max_corrupt if self.max_corrupt is not None else 1.0 if name in self.quarantine else 0.0

    def needed(self, feed: FeedSpec) -> list[str] | None:
        """The columns of ``feed`` that its rules and the totals read; ``None``, for all, if it has a quarantine."""
        if feed.model.name in self.quarantine:
            return None
        names = feed.model.schema.names
        used = {self.key, self.group if feed is self.dimension else self.measure, *(r.column for r in feed.rules)}
        heads = {c if c in names else c.partition(".")[0] for c in used}
        # an expression as the key or group may read any column
        return [n for n in names if n in heads] if heads <= set(names) else None

    def rereads(self, feed: FeedSpec) -> bool:
        """Whether cleaning ``feed`` takes passes besides the one for the result."""
        measured = any(r.scope is Scope.UNIQUE or r.mostly < 1.0 for r in feed.rules)
        return (measured or self.mode == "by_value" or self.reports is not None
                or feed.model.name in self.quarantine)


@dataclass(frozen=True)
class JobResult:
    result: DataFrame
    cleaned: Mapping[str, CleanResult]
    corrupt: Mapping[str, DataFrame]
    unparsable: Mapping[str, DataFrame] = field(default_factory=dict)

    @property
    def report(self) -> DataFrame:
        """The quality reports of all feeds, with the feed's name in ``feed``; a declared
        feed has a row for its unparsable lines too."""
        parts = [c.report.select(F.lit(name).alias("feed"), "*") for name, c in self.cleaned.items()]
        return reduce(DataFrame.unionByName, [*parts, *self.unparsable.values()])


def unparsable_report(spark: SparkSession, name: str, lines: int, bad: int, mostly: float) -> DataFrame:
    """A report row for the lines of a feed that can't be parsed."""
    row = (name, "corrupt_record", "LinesToParse", CORRUPT, lines, 0, bad, 100.0 * bad / lines if lines else 0.0,
           mostly, bad <= (1 - mostly) * lines, "discard_row")
    return spark.createDataFrame([row], "feed string, " + REPORT_SCHEMA)


def totals(dimension: DataFrame, fact: DataFrame, key: str, measure: str, group: str,
           dimension_rows: int | None = None) -> DataFrame:
    """Sum ``measure`` per ``key``, join, sum per ``group``.

    Summing first means that the join sees each key once on the fact side, however many
    facts one key has. A key that the dimension repeats counts once per repetition, and may be
    a hot one. Adaptive execution cannot split a join that sits directly on an aggregate, so the
    sums, a row for each key, are staged; the join is then planned by their true size too. A
    dimension that Spark would send to every task, or with so few ``dimension_rows`` that
    no key of it can be hot, needs none of that.
    """
    per_key = group_agg(fact, key, sum=measure)
    few = dimension_rows is not None and dimension_rows <= HOT_KEY_ROWS
    if not few and not is_small(dimension):
        per_key = stage(per_key, "totals")
    return group_agg(join_tables(dimension, per_key, key, "inner"), group, sum=measure)


def run_job(spark: SparkSession, spec: JobSpec) -> JobResult:
    """Run the job and write what ``spec`` has sinks for; anything wrong is raised.

    Both feeds pass the gate before either is used: they are there, their schema and the
    names that they themselves use are the model's, and they can be parsed. Failed rules
    are always logged. The result stays lazy, so the write is the only action over the
    full plan.
    """
    feeds = {f.model.name: f for f in (spec.dimension, spec.fact)}
    for f in feeds.values():
        require_feed(spark, f.source.path)
    read = {name: stage_feed(spark, f.source, f.model, f.rules, spec.needed(f)) for name, f in feeds.items()}
    SchemaReport(tuple(p for feed in read.values() for p in feed.gate.problems)).require()
    parsed = {name: feed.rows for name, feed in read.items()}
    corrupt = {name: feed.corrupt for name, feed in read.items() if feed.corrupt is not None}
    unparsable = {}
    for name in corrupt:
        n_bad, n_lines, share = read[name].bad, read[name].lines, spec.tolerated(name)
        if n_bad > share * n_lines:
            raise CorruptFeedError(f"{name}: {n_bad} of {n_lines} lines can't be parsed")
        unparsable[name] = unparsable_report(spark, name, n_lines, n_bad, 1 - share)
    for name, f in feeds.items():
        if f.source.mode == "infer" and f.source.format in ("json", "csv") and spec.rereads(f):
            parsed[name] = stage(parsed[name], name)
    cleaned = {name: clean(parsed[name], f.rules, mode=spec.mode, measured=read[name].counts) for name, f in feeds.items()}
    dimension, fact = spec.dimension.model.name, spec.fact.model.name
    result = JobResult(
        totals(cleaned[dimension].kept, cleaned[fact].kept, spec.key, spec.measure, spec.group, read[dimension].lines),
        cleaned, corrupt, unparsable)
    for name, sink in spec.quarantine.items():
        rejected = cleaned[name].rejected
        if name in corrupt:
            rejected = rejected.unionByName(corrupt[name], allowMissingColumns=True)
        write_table(rejected, sink)
    report = result.report
    # a row per rule: measured once, then logged and written
    report = spark.createDataFrame(report.collect(), report.schema)
    log_failures(report)
    if spec.reports is not None:
        write_table(report, spec.reports)
    if spec.sink is not None:
        write_table(result.result, spec.sink)
    return result
