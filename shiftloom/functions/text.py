"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_chain(c: Column | str, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal substring replacements, applied from left to right."""
    out = col_of(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def regex_replace(c: Column | str, pattern: str, value: str) -> Column:
    return F.regexp_replace(col_of(c), pattern, value)


def drop_last(c: Column | str, n: int = 2) -> Column:
    """Everything but the last ``n`` characters, whatever they are."""
    c = col_of(c)
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def strip_float_suffix(c: Column | str) -> Column:
    """Removes the ``.0`` a numeric id gets when it was read as a float."""
    return F.regexp_replace(col_of(c), r"[.]0$", "")


def from_char(c: Column | str, start: int) -> Column:
    """The text from the zero-based position ``start`` on."""
    c = col_of(c)
    return F.substring(c, F.lit(start + 1), F.greatest(F.length(c) - F.lit(start), F.lit(0)))


def rstrip_set(c: Column | str, chars: str = ".0") -> Column:
    """Strips trailing characters that belong to a *set*; eats significant zeros too."""
    return F.rtrim(col_of(c), F.lit(chars))


def starts(c: Column | str, prefix: str) -> Column:
    """``startswith`` that is false, not null, on a null text."""
    return F.coalesce(col_of(c).startswith(prefix), F.lit(False))


def ends(c: Column | str, suffix: str) -> Column:
    return F.coalesce(col_of(c).endswith(suffix), F.lit(False))


def has(c: Column | str, part: str) -> Column:
    """Literal containment that is false on a null text."""
    return F.coalesce(col_of(c).contains(part), F.lit(False))


def has_regex(c: Column | str, pattern: str) -> Column:
    return F.coalesce(col_of(c).rlike(pattern), F.lit(False))


def join_text(*parts: Column | str) -> Column:
    """Concatenation that is null as soon as one part is null."""
    return F.concat(*[col_of(p) for p in parts])
