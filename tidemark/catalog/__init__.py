"""Every operator bound to the test tables, each with the plain SQL of the same result."""

from tidemark.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
