"""Queries over the given test tables: source-shaped views, Spark queries, and SQL for each."""

from . import feature_queries, operator_queries  # noqa: F401  (they register their queries)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
