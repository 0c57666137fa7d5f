"""Joins.

Three ways, by what is known of the sides:

* plain joins of two scans are left to Spark: it broadcasts a side whose known or
  measured size is below its threshold, and else splits skewed partitions;
* lists (codes, statuses), whose few values each hold a large part of the fact, are the
  same once they have been :func:`dealt_anew`, whatever their length;
* large sides that come out of an aggregation are joined by :func:`spread_join`: adaptive
  execution does not split skewed partitions of such a join, so the rows of hot keys
  are spread over slices and the one matching row is repeated for each slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.operators.projection import q
from shiftloom.operators.timeline import keep_first


def dealt_anew(side: DataFrame, *keys: str) -> DataFrame:
    """A side that comes out of a window or an aggregation, dealt out once more.

    The join then shuffles it by itself, and where both sides of a join come straight
    from such a shuffle, adaptive execution splits partitions with a hot key. A side
    that Spark finds to be small is broadcast as ever.
    """
    return side.repartition(F.xxhash64(*[q(k) for k in keys]))


def left_join(right: DataFrame, on: Sequence[str], null_safe: bool = False):
    """Left join on columns of equal name, kept once.

    ``null_safe`` lets null keys meet each other.
    """
    if not null_safe:
        return lambda df: df.join(right, list(on), "left")

    def op(df: DataFrame) -> DataFrame:
        keyed = right.withColumnsRenamed({k: f"__r_{k}" for k in on})
        cond = None
        for k in on:
            c = q(k).eqNullSafe(F.col(f"__r_{k}"))
            cond = c if cond is None else cond & c
        return df.join(keyed, cond, "left").drop(*[f"__r_{k}" for k in on])

    return op


def left_join_on(right: DataFrame, keys: Mapping[str, str]):
    """Left join ``{left key: right key}``, both key columns kept."""

    def op(df: DataFrame) -> DataFrame:
        cond = None
        for lk, rk in keys.items():
            c = df[f"`{lk}`"] == right[f"`{rk}`"]
            cond = c if cond is None else cond & c
        return df.join(right, cond, "left")

    return op


def left_join_expr(right: DataFrame, on: Mapping[str, str]):
    """Left join on equal expressions, ``{SQL over the left: SQL over the right}``.

    The expressions become columns of their sides first, so that the join is an
    equality of columns, whatever they are made of.
    """

    def op(df: DataFrame) -> DataFrame:
        names = [f"__on_{i}" for i in range(len(on))]
        left = df.withColumns({n: F.expr(e) for n, e in zip(names, on)})
        side = right.withColumns({n: F.expr(e) for n, e in zip(names, on.values())})
        return left.join(side, names, "left").drop(*names)

    return op


ROWS_PER_SLICE = 2_000_000
KEYLESS_SLICES = 4096
SLICES, SLICE = "__slices", "__slice"


def hot_slices(counts: DataFrame, keys: Sequence[str], rows: str = "__n", per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Keys with more than ``per_slice`` rows and the number of slices they need.

    At most ``all rows / per_slice`` keys, which is what bounds its broadcast.
    """
    return counts.where(F.col(rows) > per_slice).select(*keys, F.ceil(F.col(rows) / per_slice).cast("int").alias(SLICES))


def row_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def spread(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Adds the slice of every row: 0 but for hot keys and rows without a key.

    A slice follows from the number of the reading task: that is the same again if the
    task is repeated, and tells equal rows apart as well as different ones.
    """
    keyless = " OR ".join(f"`{k}` IS NULL" for k in keys)
    slice_sql = f"pmod(spark_partition_id(), CASE WHEN {keyless} THEN {KEYLESS_SLICES} ELSE coalesce({SLICES}, 1) END)"
    return df.join(F.broadcast(hot), list(keys), "left").withColumn(SLICE, F.expr(slice_sql)).drop(SLICES)


def repeat(side: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """One copy of every row for each slice of its key."""
    slices = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SLICES), F.lit(1)) - 1))
    return side.join(F.broadcast(hot), list(keys), "left").withColumn(SLICE, slices).drop(SLICES)


def spread_join(df: DataFrame, side: DataFrame, keys: Sequence[str], counts: DataFrame | None = None,
                per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Left join, on columns of equal name, with a side that has one row per key.

    ``counts`` gives the rows of ``df`` per key (column ``__n``) where the caller has
    aggregated them anyway.
    """
    keys = list(keys)
    hot = hot_slices(row_counts(df, keys) if counts is None else counts, keys, per_slice=per_slice)
    return spread(df, keys, hot).join(repeat(side, keys, hot), [*keys, SLICE], "left").drop(SLICE)


def lookup(table: DataFrame, key: str, lookup_key: str, cols: Mapping[str, str], order: Sequence[str] | None = None):
    """Attributes ``{lookup column: output}`` of a keyed table.

    With ``order`` the table is first cut to one row per key, so that the lookup
    cannot multiply rows.
    """
    unique = dealt_anew(table.transform(keep_first([lookup_key], order)), lookup_key) if order else table
    side = unique.select(q(lookup_key).alias("__lk"), *[q(c).alias(o) for c, o in cols.items()])
    return lambda df: df.join(side, q(key) == F.col("__lk"), "left").drop("__lk")


def member_flag(other: DataFrame, key: str, other_key: str, out: str):
    """1 where the key occurs in another frame's column, else 0."""
    keys = other.select(q(other_key).alias("__mk")).where(F.col("__mk").isNotNull()).distinct()

    def op(df: DataFrame) -> DataFrame:
        joined = spread_join(df.withColumn("__mk", q(key)), keys.withColumn("__hit", F.lit(1)), ["__mk"])
        return joined.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__mk", "__hit")

    return op


def join_back(keys: Sequence[str], aggs: Mapping[str, Column], where: Column | None = None,
              per_slice: int = ROWS_PER_SLICE):
    """Group totals attached to every row.

    Aggregated with map-side combine and joined back, not windowed: a window would
    hold all rows of a key in one task.
    """

    def op(df: DataFrame) -> DataFrame:
        kept = df.dropna("any", subset=list(keys))
        if where is None:
            totals = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[a.alias(c) for c, a in aggs.items()])
            return spread_join(df, totals.drop("__n"), keys, totals.select(*keys, "__n"), per_slice)
        totals = kept.where(where).groupBy(*keys).agg(*[a.alias(c) for c, a in aggs.items()])
        return spread_join(df, totals, keys, per_slice=per_slice)

    return op


def late_fallback(feed: DataFrame, keys: Mapping[str, str], fills: Mapping[str, str]):
    """Fills ``{column: feed column}`` from a later feed, only where still null."""

    def op(df: DataFrame) -> DataFrame:
        side = feed.select(
            *[q(rk).alias(f"__k_{i}") for i, rk in enumerate(keys.values())],
            *[q(fc).alias(f"__f_{i}") for i, fc in enumerate(fills.values())],
        )
        cond = None
        for i, lk in enumerate(keys):
            c = q(lk) == F.col(f"__k_{i}")
            cond = c if cond is None else cond & c
        joined = df.join(side, cond, "left")
        filled = {c: F.coalesce(q(c), F.col(f"__f_{i}")) for i, c in enumerate(fills)}
        return joined.withColumns(filled).select(*[q(c) for c in df.columns])

    return op
