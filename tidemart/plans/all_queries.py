"""Imports every module that registers queries."""

from . import (  # noqa: F401
    changelog_queries, cleaning_queries, function_queries, join_queries, metric_queries, sink_queries,
    stream_queries, visitor_queries,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
