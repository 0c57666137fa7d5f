"""Ordered business rules as CASE expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftloom.functions.text import col_of


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def decision_list(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The first rule that holds decides; a null condition does not hold."""
    case = None
    for cond, value in rules:
        case = F.when(cond, as_column(value)) if case is None else case.when(cond, as_column(value))
    return as_column(default) if case is None else case.otherwise(as_column(default))


def last_match(rules: Sequence[tuple[Column, object]], current: Column | str) -> Column:
    """A chain of overrides whose conditions do not read ``current``.

    The last rule that holds wins, so the chain is one CASE over the reversed list.
    """
    return decision_list(list(reversed(list(rules))), col_of(current))


def override(current: Column | str, cond: Column, value: object) -> Column:
    """One overriding step: the new value where the condition holds."""
    return F.when(cond, as_column(value)).otherwise(col_of(current))


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def value_map(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Mapped values replaced, all others kept."""
    c = col_of(c)
    return decision_list([(c == F.lit(k), v) for k, v in mapping.items()], c)


def first_present(*cols: Column | str) -> Column:
    """Fallback cascade over feeds."""
    return F.coalesce(*[col_of(c) for c in cols])


def zero_to_null(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit(0))


def sentinel_to_null(c: Column | str, sentinel: str) -> Column:
    return F.nullif(col_of(c), F.lit(sentinel))


def not_equal(a: Column | str, b) -> Column:
    """Inequality that is true when just one side is null."""
    return ~col_of(a).eqNullSafe(as_column(b))


def hours_text(hours: Column | str, code: Column | str, threshold: float = 0.33) -> Column:
    """Worked hours as text above the threshold, else the status code."""
    h = col_of(hours)
    return F.when(h > F.lit(threshold), h.cast("string")).otherwise(col_of(code))


def minutes_to_hours(c: Column | str) -> Column:
    return F.round(col_of(c) / F.lit(60), 2)
