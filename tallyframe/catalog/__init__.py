"""Registered queries over the star schema tables, each with its SQL where SQL can say it."""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
