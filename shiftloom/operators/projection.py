"""Projections and schema operators. Column lists are resolved on names only: no job runs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header replacements, in this order.
HEADER_PAIRS = [(" - ", "_"), (" ", "_"), ("__", "_")]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def q(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def project(cols: Sequence[str]):
    """Final ordered projection."""
    return lambda df: df.select(*[quoted(c) for c in cols])


def rename(mapping: Mapping[str, str]):
    return lambda df: df.withColumnsRenamed(dict(mapping))


def normalize_header(name: str, pairs: Iterable[tuple[str, str]] = HEADER_PAIRS, lower: bool = False) -> str:
    for old, new in pairs:
        name = name.replace(old, new)
    return name.lower() if lower else name


def normalize_headers(pairs: Iterable[tuple[str, str]] = HEADER_PAIRS, lower: bool = False):
    pairs = list(pairs)
    return lambda df: df.toDF(*[normalize_header(c, pairs, lower) for c in df.columns])


def suffix_headers(suffix: str):
    return lambda df: df.toDF(*[c + suffix for c in df.columns])


def drop_columns(cols: Iterable[str], strict: bool = False):
    """Drops the listed columns; the strict form refuses names that are missing."""
    cols = list(cols)

    def op(df: DataFrame) -> DataFrame:
        missing = [c for c in cols if c not in df.columns]
        if strict and missing:
            raise KeyError(f"columns not found: {missing}")
        return df.select(*[quoted(c) for c in df.columns if c not in cols])

    return op


def drop_matching(pattern: str):
    """Drops columns whose name contains a match of the pattern."""
    rx = re.compile(pattern)
    return lambda df: df.select(*[quoted(c) for c in df.columns if not rx.search(c)])


def keep_leading(n: int):
    """Drops every column from position ``n`` on."""
    return lambda df: df.select(*[quoted(c) for c in df.columns[:n]])


def columns_between(df: DataFrame, first: str | None = None, last: str | None = None) -> list[str]:
    """Names from one label to another, both included; open where a label is missing."""
    names = df.columns
    start = names.index(first) if first is not None else 0
    stop = names.index(last) if last is not None else len(names) - 1
    return names[start : stop + 1]


def column_ranges(*ranges: tuple[str | None, str | None]):
    """Several label ranges of one frame, side by side, in a single projection."""
    return lambda df: df.select(*[quoted(c) for lo, hi in ranges for c in columns_between(df, lo, hi)])


def insert_constants(inserts: Sequence[tuple[int | None, str, object]]):
    """Inserts ``(position, name, value)`` one after the other; ``None`` appends."""

    def op(df: DataFrame) -> DataFrame:
        cols: list[tuple[str, Column]] = [(c, q(c)) for c in df.columns]
        for position, name, value in inserts:
            at = len(cols) if position is None else position
            cols.insert(at, (name, F.lit(value).alias(name)))
        return df.select(*[c for _, c in cols])

    return op


def conform_schema(schema: T.StructType):
    """Exactly the schema's columns: leniently cast where present, typed null where not."""

    def op(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                (q(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ]
        )

    return op


def add_missing(fields: Mapping[str, str]):
    """Adds typed null columns for names the frame lacks."""

    def op(df: DataFrame) -> DataFrame:
        return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in fields.items() if c not in df.columns])

    return op


def cast_columns(types: Mapping[str, str], lenient: bool = True):
    """Casts columns in place; the lenient form turns bad values into null."""

    def op(df: DataFrame) -> DataFrame:
        cast = {c: (q(c).try_cast(t) if lenient else q(c).cast(t)) for c, t in types.items()}
        return df.withColumns(cast)

    return op


def stamp(literals: Mapping[str, object] | None = None, copies: Mapping[str, str] | None = None):
    """Adds copies of columns (``{new: old}``) and constant run stamps."""

    def op(df: DataFrame) -> DataFrame:
        new = {n: q(o) for n, o in (copies or {}).items()}
        new.update({n: v if isinstance(v, Column) else F.lit(v) for n, v in (literals or {}).items()})
        return df.withColumns(new)

    return op


def with_all_strings(fn):
    """Applies a column function to every text column."""

    def op(df: DataFrame) -> DataFrame:
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        return df.select(*[fn(q(c)).alias(c) if c in texts else q(c) for c in df.columns])

    return op
