"""Check, clean and roll up batch feeds with Spark."""

from feedquality.errors import (ConfigError, CorruptFeedError, EmptyFeedError, FeedQualityError, MissingFeedError,
                                SchemaMismatchError, TableRuleError)
from feedquality.model import TableModel
from feedquality.operators.joins import join_range, join_tables
from feedquality.operators.quality import (CleanResult, clean, failing_values, failures, log_failures,
                                           observe_rules, quality_report, verdict)
from feedquality.operators.rollup import group_agg
from feedquality.operators.schema_gate import SchemaReport, check_names, check_schema, check_tables
from feedquality.plans.job import FeedSpec, JobResult, JobSpec, run_job, totals
from feedquality.rules import OnFailure, Rule, RuleSet, Scope, required_rules
from feedquality.session import session_builder, size_shuffles, stage, staging
from feedquality.sinks.writers import (RECORD_SEPARATOR, SinkSpec, as_lines, bigquery_sink, flatten, mongo_sink, sink_for,
                                       write_connector, write_table)
from feedquality.sources.feeds import (SourceSpec, feed_listing, feed_ready, read_table, require_feed,
                                       sources_from, split_corrupt)
from feedquality.sources.staged import StagedFeed, stage_feed

__all__ = [
    "CleanResult", "ConfigError", "CorruptFeedError", "EmptyFeedError", "FeedQualityError", "FeedSpec", "JobResult", "JobSpec",
    "MissingFeedError", "OnFailure", "RECORD_SEPARATOR", "Rule", "RuleSet", "SchemaMismatchError", "SchemaReport", "Scope",
    "SinkSpec", "SourceSpec", "StagedFeed", "TableModel", "TableRuleError", "as_lines", "bigquery_sink", "check_names", "check_schema",
    "check_tables", "clean", "failing_values", "failures", "feed_listing", "feed_ready", "flatten",
    "group_agg", "join_range", "join_tables", "log_failures", "mongo_sink", "observe_rules", "quality_report", "read_table",
    "require_feed", "required_rules", "run_job", "session_builder", "sink_for", "size_shuffles", "sources_from",
    "split_corrupt", "stage", "stage_feed", "staging", "totals", "verdict", "write_connector", "write_table",
]
