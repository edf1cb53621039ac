"""Measure a rule suite, enforce it, and explain what it rejected.

Every rule is judged on the same unfiltered input. Row rules share one scan and one
aggregate; a unique rule adds one pruned pass over its column. Enforcement is a plain
filter, so accepted rows keep whatever push-down the source offers.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from feedquality.errors import ConfigError, TableRuleError
from feedquality.functions.columns import column_at, field_type, match_key, quoted
from feedquality.rules import OnFailure, Rule, RuleSet, Scope, member_marker
from feedquality.session import stage

logger = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "rule_id string, expectation string, column string, element_count bigint, "
    "missing_count bigint, unexpected_count bigint, unexpected_percent double, "
    "mostly double, success boolean, on_failure string"
)

FAILED_RULES = "failed_rules"

# Repeated values sent to every task: at most this many 32-byte keys, a few megabytes.
BROADCAST_KEYS = 100_000

# Words of 64 bits in the filter for more repeated values than that, at most; a few dozen
# megabytes in every task. A value has sixteen bits to itself, as long as there are so many.
FILTER_WORDS = 1 << 20
BITS_FOR_A_KEY = 16


# --- measuring -----------------------------------------------------------------


def rule_metrics(schema: T.StructType, rules: Sequence[Rule], among: Column | None = None) -> list[Column]:
    """Row count, bad rows per row rule, nulls per rule that skips nulls; ``among`` limits them to some rows."""
    def those(condition: Column) -> Column:
        return F.count_if(condition if among is None else among & condition)

    columns = [those(F.lit(True)).alias("n")]
    for i, r in enumerate(rules):
        if not r.applies_to(schema) or r.scope is Scope.TABLE:
            continue
        if r.scope is Scope.ROW:
            columns.append(those(~r.good(schema)).alias(f"bad_{i}"))
        if not r.kind.sees_nulls:
            columns.append(those(column_at(schema, r.column).isNull()).alias(f"null_{i}"))
    return columns


def _text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _entry(rule: Rule, n: str = "null", missing: str = "null", bad: str = "null", holds: str = "null") -> str:
    """One rule and the SQL expressions of its counts, as a struct."""
    values = {
        "rule_id": _text(rule.rule_id), "expectation": _text(rule.expectation), "column": _text(rule.column),
        "n": f"cast({n} as bigint)", "missing": f"cast({missing} as bigint)", "bad": f"cast({bad} as bigint)",
        "mostly": f"{rule.mostly!r}D", "on_failure": _text(rule.on_failure.value),
        "holds": f"cast({holds} as boolean)",
    }
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def _schema_entry(rule: Rule, schema: T.StructType) -> str:
    """Verdict without counts: a table rule, or a rule whose column is not there."""
    return _entry(rule, holds=str(rule.scope is Scope.TABLE and rule.holds_for(schema)))


def _report(metrics: DataFrame, entries: list[str]) -> DataFrame:
    """Turn the one row of ``metrics`` into a report row per entry."""
    raw = metrics.select(F.expr(f"inline(array({', '.join(entries)}))"))
    return raw.selectExpr(
        "rule_id", "expectation", "column", "n as element_count", "missing as missing_count",
        "bad as unexpected_count",
        "case when n > missing then 100D * bad / (n - missing) when n = missing then 0D end as unexpected_percent",
        "mostly",
        "coalesce(holds, case when n = missing then true else (n - missing - bad) / (n - missing) >= mostly end)"
        " as success",
        "on_failure")


def _unpivot(metrics: DataFrame, schema: T.StructType, rules: list[Rule], copies: Mapping[str, int],
             without: Sequence[Rule] = ()) -> DataFrame:
    """One report row per rule out of the columns of :func:`rule_metrics`."""
    entries = []
    for i, r in enumerate(rules):
        if r in without:
            continue
        if r.scope is Scope.TABLE or not r.applies_to(schema):
            entries.append(_schema_entry(r, schema))
        else:
            bad = str(copies[r.rule_id]) if r.scope is Scope.UNIQUE else f"bad_{i}"
            entries.append(_entry(r, "n", "0" if r.kind.sees_nulls else f"null_{i}", bad))
    return _report(metrics, entries)


def _one_row(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.range(1).selectExpr(*[f"{v}L as {k}" for k, v in counts.items()])


def _unique_report(df: DataFrame, rule: Rule) -> DataFrame:
    """Counts of a unique rule. Copies are counted map-side before anything is shuffled,
    so a value that fills a third of the table reaches its reducer as one row per task."""
    key = match_key(column_at(df.schema, rule.column), field_type(df.schema, rule.column))
    per_value = df.select(key.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    totals = per_value.selectExpr("c", "if(k is null, c, 0) as empty", "if(k is not null and c > 1, c, 0) as again")
    return _report(totals.agg(F.sum("c").alias("c"), F.sum("empty").alias("empty"), F.sum("again").alias("again")),
                   [_entry(rule, "coalesce(c, 0)", "coalesce(empty, 0)", "coalesce(again, 0)")])


def quality_report(df: DataFrame, ruleset: RuleSet) -> DataFrame:
    """One row per rule (:data:`REPORT_SCHEMA`), lazily.

    All row rules come from one aggregate over one scan. Table rules carry a verdict
    and no counts, and so does a rule whose column the table does not have.
    """
    df, schema = with_members(df, ruleset), df.schema
    counted = [r for r in ruleset if r.scope is Scope.ROW and r.applies_to(schema)]
    unique = [r for r in ruleset if r.scope is Scope.UNIQUE and r.applies_to(schema)]
    rest = [r for r in ruleset if r not in counted and r not in unique]
    parts = [_unique_report(df, r) for r in unique]
    if counted:
        # the schema verdicts ride along with the one row of metrics
        parts.append(_unpivot(df.agg(*rule_metrics(schema, counted)), schema, counted + rest, {}))
    elif rest:
        parts.append(_report(df.sparkSession.range(1), [_schema_entry(r, schema) for r in rest]))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def verdict(report: DataFrame) -> DataFrame:
    """One row, one column ``success``: whether every rule passed."""
    return report.agg(F.coalesce(F.every("success"), F.lit(True)).alias("success"))


def failures(report: DataFrame) -> DataFrame:
    """The rules that failed, for a log or a sink."""
    return report.where(~F.col("success"))


def log_failures(report: DataFrame) -> None:
    """Warn about each failed rule; a report has one row per rule, so few rows are fetched."""
    for r in failures(report).collect():
        logger.warning("rule %s failed on column %s: %s of %s rows", r["rule_id"], r["column"],
                       r["unexpected_count"], r["element_count"])


@dataclass(frozen=True)
class ObservedRules:
    """``df`` counts its rows while some other action reads it; ``report`` waits for that action.

    The counts belong to the run, not to the table: should Spark recompute a stage
    after losing an executor, rows may be counted again. Use :func:`quality_report`
    where a decision hangs on them.
    """

    df: DataFrame
    observation: Observation
    rules: tuple[Rule, ...]
    schema: T.StructType

    def report(self) -> DataFrame:
        return _unpivot(_one_row(self.df.sparkSession, self.observation.get), self.schema, list(self.rules), {})


def observe_rules(df: DataFrame, ruleset: RuleSet, name: str = "quality") -> ObservedRules:
    """Measure the row and table rules in flight, sharing the scan of the next action."""
    if ruleset.of(Scope.UNIQUE):
        raise ConfigError("a unique rule needs a pass of its own and cannot be observed")
    observation = Observation(name)
    rules = list(ruleset)
    observed = with_members(df, rules).observe(observation, *rule_metrics(df.schema, rules)).select(
        *[F.col(quoted(c)) for c in df.columns])
    return ObservedRules(observed, observation, tuple(rules), df.schema)


# --- membership ------------------------------------------------------------------


def member_keys(spark: SparkSession, rule: Rule, data_type: T.DataType) -> DataFrame:
    """The distinct members of ``rule``'s table as :func:`match_key` values ``k`` of ``data_type``, staged.

    A member that is no value of that type, like 3.5 for whole numbers, equals nothing and is left out.
    """
    source = rule.member_table
    if isinstance(source, DataFrame):
        if len(source.columns) != 1:
            raise ConfigError(f"{rule.rule_id}: the set has {len(source.columns)} columns instead of one")
        member = F.col(quoted(source.columns[0]))
        members = source
    else:
        # imported here, as reading feeds builds on this module
        from feedquality.sources.feeds import SourceSpec, read_table
        members = read_table(spark, SourceSpec(source["path"], source.get("format", ""), mode="infer"))
        member = column_at(members.schema, source["column"])
    members = members.select(member.alias("given"))
    if members.schema["given"].dataType != data_type:
        value = F.col("given").try_cast(data_type)
        members = members.where(value == F.col("given")).select(value.alias("given"))
    keys = members.where(F.col("given").isNotNull()).select(match_key(F.col("given"), data_type).alias("k"))
    return stage(keys.distinct(), "members")


def with_members(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``df`` with a boolean column for each rule whose set is a table: this row's value is in it.

    The staged set has a true size, by which Spark sends it to every task or shuffles both
    sides on the key; a hot value is then split, being on the kept side of the join.
    """
    for rule in rules:
        marker = member_marker(rule.rule_id)
        if rule.member_table is None or not rule.applies_to(df.schema) or marker in df.columns:
            continue
        data_type = field_type(df.schema, rule.column)
        k = f"{marker}_key"
        keys = member_keys(df.sparkSession, rule, data_type).withColumnRenamed("k", k)
        df = (df.join(keys, match_key(column_at(df.schema, rule.column), data_type) == F.col(quoted(k)), "left")
              .withColumn(marker, F.col(quoted(k)).isNotNull()).drop(k))
    return df


# --- uniqueness ------------------------------------------------------------------


@dataclass(frozen=True)
class Repeated:
    """The values of a column that more than one row holds, staged as ``(k, n)``: how many
    values there are, and how many rows hold them."""

    values: DataFrame
    keys: int
    rows: int

    @property
    def many(self) -> bool:
        return self.keys > BROADCAST_KEYS


def repeated_values(df: DataFrame, column: str) -> Repeated:
    """Count the non-null values of ``column`` and stage those that repeat.

    ``k`` is the value's :func:`match_key`, so long texts are neither shuffled nor kept.
    """
    key = match_key(column_at(df.schema, column), field_type(df.schema, column))
    counts = df.select(key.alias("k")).where(F.col("k").isNotNull()).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    values = stage(counts.where(F.col("n") > 1), "repeated")
    size = values.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    return Repeated(values, size["keys"], size["rows"] or 0)


def mark_repeated(df: DataFrame, column: str, repeated: Repeated, marker: str) -> DataFrame:
    """Add the boolean ``marker``: this row's value is one of ``repeated``.

    Few repeated values (the count is checked) go to every task and no row moves. Beyond
    that the hot ones do, those with more than their share of the repeated rows, of which
    there are fewer than :data:`BROADCAST_KEYS` by arithmetic, and a bitmap of the hashes of
    all. Rows that the hot ones settle, rows without a value and rows whose bit is not set
    stay where they are; only the others join on their key, and none of those keys is hot.
    The bitmap is bounded by :data:`FILTER_WORDS`: it passes a few per cent of the other rows
    at first, and more once there are tens of millions of repeated values.
    """
    key = match_key(column_at(df.schema, column), field_type(df.schema, column))
    k = f"{marker}_key"
    hits = repeated.values.select(F.col("k").alias(k), "n", F.lit(True).alias(marker))
    flag = F.coalesce(F.col(quoted(marker)), F.lit(False))

    def joined(rows: DataFrame, values: DataFrame) -> DataFrame:
        return (rows.join(values.drop("n"), key == F.col(quoted(k)), "left")
                .withColumn(marker, flag).drop(k))

    if not repeated.many:
        return joined(df, F.broadcast(hits))
    marked = joined(df, F.broadcast(hits.where(F.col("n") > repeated.rows / BROADCAST_KEYS)))
    words = 1 << min(FILTER_WORDS.bit_length() - 1, (repeated.keys * BITS_FOR_A_KEY // 64).bit_length())
    word, bits = f"{marker}_word", f"{marker}_bits"

    def place(k: Column) -> tuple[Column, Column]:
        """The word that a key's bit is in, and that bit."""
        hashed = F.xxhash64(k)
        return F.shiftright(hashed, 6).bitwiseAND(words - 1), F.call_function(
            "shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(63).cast("int"))

    at, bit = place(F.col(quoted(k)))
    bitmap = hits.groupBy(at.alias(word)).agg(F.bit_or(bit).alias(bits))
    at, bit = place(key)
    marked = marked.join(F.broadcast(bitmap), at == F.col(quoted(word)), "left")
    undecided = (~F.col(quoted(marker)) & key.isNotNull()
                 & F.coalesce(F.col(quoted(bits)).bitwiseAND(bit) != 0, F.lit(False)))
    return (marked.where(~undecided).drop(word, bits)
            .unionByName(joined(marked.where(undecided).drop(marker, word, bits), hits)))


def _mark(df: DataFrame, repeated: Mapping[str, tuple[Rule, Repeated]]) -> DataFrame:
    """Mark the repeated values of several rules. Beyond the broadcast bound a mark reads
    its input twice, so from the second such mark on the input is staged."""
    split = False
    for rule, found in repeated.values():
        if found.many and split:
            df = stage(df, "marked")
        split = split or found.many
        df = mark_repeated(df, rule.column, found, _marker(rule))
    return df


# --- enforcing ---------------------------------------------------------------------


class CleanResult:
    """What :func:`clean` found; each frame is built when it is first asked for.

    ``kept`` has the accepted rows, ``rejected`` the others with the ids of the rules
    they broke, ``flagged`` both at once (an empty array marks an accepted row) for
    callers that want a single pass, ``report`` the measures of the unfiltered input.
    """

    def __init__(self, base: DataFrame, columns: list[str], keep: Mapping[str, Column], dropped: list[str],
                 report: Callable[[], DataFrame]) -> None:
        self._base, self._keep, self._dropped, self._build_report = base, dict(keep), dropped, report
        self._columns = [quoted(c) for c in columns]
        self._accepted = reduce(and_, self._keep.values()) if self._keep else F.lit(True)

    def _failed(self) -> Column:
        if not self._keep:
            return F.array().cast("array<string>").alias(FAILED_RULES)
        reasons = [F.when(~p, F.lit(rule_id)) for rule_id, p in self._keep.items()]
        return F.array_compact(F.array(*reasons)).alias(FAILED_RULES)

    @cached_property
    def kept(self) -> DataFrame:
        rows = self._base.where(self._accepted).select(*self._columns)
        return reduce(_drop_path, self._dropped, rows)

    @cached_property
    def rejected(self) -> DataFrame:
        return self._base.where(~self._accepted).select(*self._columns, self._failed())

    @cached_property
    def flagged(self) -> DataFrame:
        return self._base.select(*self._columns, self._failed())

    @cached_property
    def report(self) -> DataFrame:
        return self._build_report()


def _marker(rule: Rule) -> str:
    return f"__repeated({rule.rule_id})"


def _differing(df: DataFrame, keep: Mapping[str, tuple[Rule, Column]]) -> dict[str, Column]:
    """For each rule, ``c <> v`` for every failing value ``v``, where a comparison with null never holds.

    A rule judges each row by its value alone, so a row whose value equals a failing one
    fails itself, and the failing values need not be listed. What is to be known is
    whether there are any, and whether null is one of them: one row of counts for all rules.
    """
    if not keep:
        return {}
    present = {rule_id: column_at(df.schema, rule.column).isNotNull() for rule_id, (rule, _) in keep.items()}
    counts = [F.struct(F.count_if(~good).alias("bad"), F.count_if(~good & ~present[rule_id]).alias("empty")).alias(str(i))
              for i, (rule_id, (_, good)) in enumerate(keep.items())]
    found = df.agg(*counts).first()
    return {rule_id: F.lit(False) if found[i]["empty"] else good & present[rule_id] if found[i]["bad"] else F.lit(True)
            for i, (rule_id, (_, good)) in enumerate(keep.items())}


def _drop_path(df: DataFrame, path: str) -> DataFrame:
    if path in df.columns:
        return df.drop(F.col(quoted(path)))
    head, _, rest = path.partition(".")
    return df.withColumn(head, F.col(quoted(head)).dropFields(rest))


def clean(df: DataFrame, ruleset: RuleSet, mode: str = "predicate", on_table_failure: str = "raise",
          measured: Mapping[str, int] | None = None) -> CleanResult:
    """Apply each failed rule's action to ``df``.

    ``predicate`` drops exactly the rows that break a rule. ``by_value`` keeps the rows
    whose value differs from every failing value, as a comparison in SQL does: all failing
    values count, rows without a value go where there is any, a null among the failing
    values empties the table, and an action on the column counts as one on the rows. A table rule has no
    rows to drop, so its failure raises :class:`TableRuleError`, or is left to the report
    with ``on_table_failure="report"``.

    Rules are measured up front only where the outcome depends on it: a tolerance below
    one, a column to drop, which failing values there are. Otherwise the result is lazy, apart
    from the repeated values of a unique rule, which are staged. ``measured`` has the values of
    :func:`rule_metrics` over all rules of the set, where another pass over ``df`` took them.
    """
    if mode not in ("predicate", "by_value"):
        raise ConfigError(f"mode must be 'predicate' or 'by_value', got {mode!r}")
    if on_table_failure not in ("raise", "report"):
        raise ConfigError(f"on_table_failure must be 'raise' or 'report', got {on_table_failure!r}")
    columns, schema = df.columns, df.schema
    df = with_members(df, ruleset)
    acting = [r for r in ruleset if r.on_failure is not OnFailure.NONE]
    broken = [r for r in acting if (r.scope is Scope.TABLE and not r.holds_for(schema))
              or (r.scope is not Scope.TABLE and not r.applies_to(schema))]
    if broken and on_table_failure == "raise":
        raise TableRuleError("failed on the table's schema: " + ", ".join(r.rule_id for r in broken))
    acting = [r for r in acting if r.scope is not Scope.TABLE and r.applies_to(schema)]

    staged = {r.rule_id: repeated_values(df, r.column) for r in acting if r.scope is Scope.UNIQUE}
    by_row = [r for r in acting if mode == "by_value" or r.on_failure is OnFailure.DISCARD_ROW]
    decisive = [r for r in acting if r.mostly < 1.0 or r not in by_row]

    def report() -> DataFrame:
        return _report_with(df, schema, ruleset, staged, measured)

    if decisive:
        rows = report().collect()  # one row per rule
        passed = {r["rule_id"] for r in rows if r["success"]}
        acting = [r for r in acting if r not in decisive or r.rule_id not in passed]

        def report() -> DataFrame:
            return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)

    discarding = [r for r in acting if r in by_row]
    base = _mark(df, {r.rule_id: (r, staged[r.rule_id]) for r in discarding if r.scope is Scope.UNIQUE})

    def good(r: Rule) -> Column:
        return ~F.col(quoted(_marker(r))) if r.scope is Scope.UNIQUE else r.good(schema)

    keep = {r.rule_id: good(r) for r in discarding}
    if mode == "by_value":
        keep = _differing(base, {r.rule_id: (r, keep[r.rule_id]) for r in discarding})

    dropped = list(dict.fromkeys(r.column for r in acting if r not in by_row))
    return CleanResult(base, columns, keep, dropped, report)


def _report_with(df: DataFrame, schema: T.StructType, ruleset: RuleSet, staged: Mapping[str, Repeated],
                 measured: Mapping[str, int] | None) -> DataFrame:
    """The report, taking the counts of unique rules from their staged values, and those of
    row rules from ``measured`` where they are there."""
    if not staged and measured is None:
        return quality_report(df, ruleset)
    counts = {rule_id: found.rows for rule_id, found in staged.items()}
    rest = [r for r in ruleset if r.scope is Scope.UNIQUE and r.rule_id not in staged and r.applies_to(schema)]
    rules = list(ruleset)
    metrics = df.agg(*rule_metrics(schema, rules)) if measured is None else _one_row(df.sparkSession, measured)
    report = _unpivot(metrics, schema, rules, counts, rest)
    return report.unionByName(quality_report(df, RuleSet(ruleset.name, tuple(rest)))) if rest else report


# --- explaining --------------------------------------------------------------------


# Fixed: ties between failing values go by so many first characters, then by the digest.
TIE_CHARS = 64


def _failing(df: DataFrame, ruleset: RuleSet) -> DataFrame | None:
    """``(rule_id, key, value)`` of every failing row and rule; ``key`` stands for the value."""
    schema = df.schema
    rules = [r for r in ruleset.of(Scope.ROW, Scope.UNIQUE) if r.applies_to(schema)]
    if not rules:
        return None
    base = _mark(with_members(df, rules), {r.rule_id: (r, repeated_values(df, r.column)) for r in rules if r.scope is Scope.UNIQUE})

    def entry(r: Rule) -> Column:
        text = column_at(schema, r.column).cast("string")
        return F.struct(F.lit(r.rule_id).alias("rule_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
                        text.alias("value"))

    found = [F.when(F.col(quoted(_marker(r))) if r.scope is Scope.UNIQUE else ~r.good(schema), entry(r)) for r in rules]
    return base.select(F.inline(F.array_compact(F.array(*found))))


def _ranked(found: DataFrame, n: int | None) -> DataFrame:
    """``(rule_id, key, count, head, long)``, for each rule all of them or the ``n`` most frequent. ``head`` is
    the beginning of the value, and all of it unless the value is ``long``."""
    counts = found.groupBy("rule_id", "key").agg(
        F.count(F.lit(1)).alias("count"), F.min(F.left("value", F.lit(TIE_CHARS))).alias("head"),
        F.max(F.coalesce(F.length("value") > TIE_CHARS, F.lit(False))).alias("long"))
    if n is not None:
        order = Window.partitionBy("rule_id").orderBy(F.desc("count"), F.asc_nulls_first("head"), "key")
        counts = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return counts.select("rule_id", "key", "count", "head", "long")


def failing_values(df: DataFrame, ruleset: RuleSet, n: int | None = None) -> DataFrame:
    """``(rule_id, value, count)``: the failing values of each rule, or its ``n`` most frequent.

    Values, as text, are counted under their digest, so the rows that are counted and
    ranked hold the beginning of a text at most. Short values come with it; only where a long
    one is shown is the input read again, to fetch whole texts, one copy from each task. Ties
    go to the smaller beginning, so the answer does not depend on partitioning.
    """
    found = _failing(df, ruleset)
    if found is None:
        return df.sparkSession.createDataFrame([], "rule_id string, value string, count bigint")
    lengths = Observation()
    ranked = stage(_ranked(found, n).observe(lengths, F.count_if(F.col("long")).alias("long")), "failing")
    short = ranked.where(~F.col("long")).select("rule_id", F.col("head").alias("value"), "count")
    if not lengths.get["long"]:
        return short
    shown = ranked.where("long").alias("s")
    same = (F.col("f.rule_id") == F.col("s.rule_id")) & (F.col("f.key") == F.col("s.key"))
    whole = (found.alias("f").where(F.length("f.value") > TIE_CHARS).join(shown, same)
             .groupBy("s.rule_id", "s.key", "s.count").agg(F.first("f.value").alias("value"))
             .select("rule_id", "value", "count"))
    return short.unionByName(whole)
