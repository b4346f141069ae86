"""Operators that prepare a text corpus for training, and their queries."""

from loadlake.llm.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
