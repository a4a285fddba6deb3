"""Queries over the given tables, each with an independent SQL text where SQL can express it."""

from wattlake.catalog import documents, energy, lake, payloads, streams, vectors  # noqa: F401  (they register)
from wattlake.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
