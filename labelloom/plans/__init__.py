"""Registered queries over the given tables, each with its SQL counterpart where SQL can say it."""

from labelloom.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
