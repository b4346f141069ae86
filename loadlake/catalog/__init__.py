"""Runnable queries over the test tables, each with the SQL that gives the same rows."""

from loadlake.catalog import bronze, features, forecasts, models, quality, streams  # noqa: F401
from loadlake.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
