"""Registered queries: each runs on the given tables and has a SQL counterpart."""

from shiftloom.queries import (  # noqa: F401  (importing registers)
    aggregates,
    attendance,
    basics,
    corrections,
    intervals,
    layouts,
    overlays,
    quarantine,
    reshape,
    ruletables,
    scalars,
    schedule,
    sheets,
    sources,
    timelines,
)
from shiftloom.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
