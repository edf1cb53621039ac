"""Typed errors: a failed stage stops the run instead of returning ``None``."""

from __future__ import annotations


class FeedQualityError(Exception):
    """Base class of every error this package raises on purpose."""


class ConfigError(FeedQualityError, ValueError):
    """A model, suite, source or sink description is not usable."""


class EmptyFeedError(FeedQualityError):
    """The path exists but holds no bytes."""


class MissingFeedError(FeedQualityError):
    """The path does not exist."""


class SchemaMismatchError(FeedQualityError):
    """A table does not have the columns and types its model declares."""


class TableRuleError(FeedQualityError):
    """A table-level rule with a discard action failed: there are no rows to discard."""


class CorruptFeedError(FeedQualityError):
    """More lines of a feed can't be parsed than the job tolerates."""
