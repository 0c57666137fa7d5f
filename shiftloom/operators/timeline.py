"""Ordered operators per entity (fills, next value, first date) that survive hot keys.

A window partitioned by the entity puts all rows of an entity into one task. That
is fine for a calendar (some hundred days) and fatal for a key that holds a large
part of the data. A :class:`Timeline` therefore cuts the rows of *hot* entities
into consecutive chunks and works in two steps:

1. windows run per ``(entity, chunk)``;
2. what has to cross a chunk border (the last known value, the first value of the
   next chunk, a minimum) is one small row per hot chunk, aggregated with map-side
   combine, and joined back on ``(entity, chunk)`` - the partitioning the windows
   already have, so the rows themselves are shuffled once.

Chunks hold about equally many rows: borders are quantiles of the entity's positions,
and of the tie-break inside a position that alone fills chunks. Entities below
``rows_per_chunk`` rows keep a single chunk, so their plan is the plain window. There are at most ``rows / rows_per_chunk`` hot entities, which is the
proven size of the one side that is broadcast. If no entity is hot, adaptive
execution finds that list empty and drops the second step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 2_000_000
# Quantiles are approximate, and ties sit beside them, so cut finer.
OVERSPLIT = 4
# Chunks of one entity at most: an entity with more than CUTS * ROWS_PER_CHUNK / OVERSPLIT
# rows has chunks of rows / CUTS.
CUTS = 256
STEP = 16  # borders looked at together
WIDE = 1024  # numbers kept free for the chunks inside one position
NULL_KEY_SLICES = 4096

CHUNK = "__chunk"
HOT = "__hot"


@dataclass(frozen=True)
class Timeline:
    """Rows of one entity in a total order.

    ``keys``      entity columns.
    ``order``     order columns, the last ones being the tie-break.
    ``position``  an integer expression that grows (weakly) with ``order``: a day
                  number, microseconds, a week number. Left out where the rows per
                  entity are bounded by construction (one per calendar day): then
                  nothing is cut and the operators are plain windows.
    ``tiebreak``  optional second integer expression that grows with ``order``
                  inside one position, to cut below the grain of ``position``.
    """

    keys: Sequence[str]
    order: Sequence[str]
    position: Column | None = None
    tiebreak: Column | None = None
    rows_per_chunk: int = ROWS_PER_CHUNK

    @property
    def parts(self) -> tuple[str, ...]:
        return () if self.position is None else (HOT, CHUNK)

    # -- chunking ---------------------------------------------------------

    def hot_keys(self, df: DataFrame) -> DataFrame:
        """Entities with more than ``rows_per_chunk`` rows, and where their rows are to be cut.

        The cuts are quantiles of the rows' positions, so one outlier does not matter.
        A position that takes up several of them is heavy: it is cut by quantiles of the
        tie-break. Quantiles are computed for the hot entities only.
        """
        tie = self.tiebreak if self.tiebreak is not None else F.lit(0)
        rows = df.where(self._keys_present()).select(
            *self.keys, self.position.cast("bigint").alias("__p"), tie.cast("bigint").alias("__t"))
        counts = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > self.rows_per_chunk)
        parts = F.least(F.ceil(F.col("__rows") * OVERSPLIT / self.rows_per_chunk), F.lit(CUTS)).cast("int")
        listed = counts.select(*self.keys, parts.alias(HOT))
        steps = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
        cuts = (
            rows.join(F.broadcast(listed), list(self.keys)).groupBy(*self.keys, HOT)
            .agg(*[F.percentile_approx(c, steps, F.lit(CUTS * 64)).alias(f"{c}_q") for c in ("__p", "__t")])
        )

        def chosen(c: str) -> Column:
            quantiles = F.coalesce(F.col(f"{c}_q"), F.array().cast("array<bigint>"))
            place = F.transform(F.sequence(F.lit(1), F.col(HOT)), lambda i: F.floor(i * CUTS / F.col(HOT)).cast("int") - 1)
            return F.filter(F.transform(place, lambda i: F.get(quantiles, i)), lambda x: x.isNotNull())

        picked = cuts.select(*self.keys, HOT, *[chosen(c).alias(c) for c in ("__p", "__t")])
        heavy = F.filter(F.array_distinct("__p"), lambda x: F.size(F.filter("__p", lambda y: y == x)) > 1)
        return picked.select(
            *self.keys, HOT, heavy.alias("__heavy"),
            *[F.array_sort(F.array_distinct(c)).alias(f"{c}_cuts") for c in ("__p", "__t")],
        )

    def split(self, df: DataFrame) -> DataFrame:
        """Adds the chunk columns (none where the rows per entity are bounded)."""
        if self.position is None:
            return df
        hot = F.broadcast(self.hot_keys(df))
        place, tie = self.position.cast("bigint"), F.lit(None).cast("bigint")
        if self.tiebreak is not None:
            tie = self.tiebreak.cast("bigint")
        index, below = _rank("__p_cuts", place), F.coalesce(_rank("__t_cuts", tie), F.lit(0))
        border = F.get(F.col("__p_cuts"), index - 1)
        inside = F.when(~F.array_contains("__heavy", border), F.lit(0)).when(place == border, below).otherwise(F.lit(WIDE - 1))
        cut = F.when(place.isNull(), below - WIDE).otherwise(index * WIDE + F.coalesce(inside, F.lit(0)))
        null_slice = F.lit(-1) - F.pmod(F.xxhash64(*self.order), F.lit(NULL_KEY_SLICES))
        chunk = F.when(~self._keys_present(), null_slice).when(F.col(HOT).isNotNull(), cut).otherwise(F.lit(0))
        return (
            df.join(hot, list(self.keys), "left")
            .withColumn(CHUNK, chunk.cast("bigint"))
            .drop("__heavy", "__p_cuts", "__t_cuts")
        )

    def unsplit(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.parts)

    # -- operators on a split frame ---------------------------------------

    def fill_forward(self, df: DataFrame, cols: Mapping[str, Column | str]) -> DataFrame:
        """``{output: value}``: the latest non-null value at or before each row."""
        return self._fill(df, cols, forward=True)

    def fill_backward(self, df: DataFrame, cols: Mapping[str, Column | str]) -> DataFrame:
        """``{output: value}``: the next non-null value at or after each row."""
        return self._fill(df, cols, forward=False)

    def following(self, df: DataFrame, cols: Mapping[str, Column | str]) -> DataFrame:
        """``{output: value}``: the next non-null value strictly after each row."""
        return self._fill(df, cols, forward=False, exclusive=True)

    def next_or_self(self, df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
        """``{output: column}``: the value of the next row; the own one if that is null or missing."""
        w = Window.partitionBy(*self.keys, *self.parts).orderBy(*self.order)
        nxt = {out: f"__next_{i}" for i, out in enumerate(cols)}
        out = df.select(
            "*",
            *[F.lead(cols[o]).over(w).alias(nxt[o]) for o in cols],
            F.lead(F.lit(True)).over(w).alias("__inner"),
        )
        found = {o: nxt[o] for o in cols}
        if self.parts:
            ordered = F.struct(*self.order)
            over_chunks = Window.partitionBy(*self.keys).orderBy(CHUNK)
            borders = (
                self._hot_rows(df)
                .groupBy(*self.keys, *self.parts)
                .agg(*[F.min_by(F.struct(F.col(cols[o]).alias("v")), ordered).alias(nxt[o]) for o in cols])
                .select(
                    *self.keys, *self.parts,
                    *[F.lead(nxt[o]).over(over_chunks)["v"].alias(f"{nxt[o]}_b") for o in cols],
                )
            )
            out = out.join(borders, [*self.keys, *self.parts], "left")
            found = {o: f"IF(__inner, {nxt[o]}, {nxt[o]}_b)" for o in cols}
        result = {o: self._or_null(f"coalesce({found[o]}, `{cols[o]}`)") for o in cols}
        return out.withColumns(result).drop("__inner", *nxt.values(), *[f"{n}_b" for n in nxt.values()])

    def first_where(self, df: DataFrame, cols: Mapping[str, tuple[Column, str]]) -> DataFrame:
        """``{output: (condition, value)}``: least value among the entity's qualifying rows."""
        picked = {o: F.when(cond, F.col(value)) for o, (cond, value) in cols.items()}
        tmp = {o: f"__first_{i}" for i, o in enumerate(cols)}
        w = Window.partitionBy(*self.keys, *self.parts)
        out = df.select("*", *[F.min(picked[o]).over(w).alias(tmp[o]) for o in cols])
        found = {o: tmp[o] for o in cols}
        if self.parts:
            over_chunks = Window.partitionBy(*self.keys)
            totals = (
                self._hot_rows(df)
                .groupBy(*self.keys, *self.parts)
                .agg(*[F.min(picked[o]).alias(tmp[o]) for o in cols])
                .select(
                    *self.keys, *self.parts,
                    *[F.min(tmp[o]).over(over_chunks).alias(f"{tmp[o]}_b") for o in cols],
                )
            )
            out = out.join(totals, [*self.keys, *self.parts], "left")
            found = {o: f"IF({HOT} IS NOT NULL, {tmp[o]}_b, {tmp[o]})" for o in cols}
        result = {o: self._or_null(found[o]) for o in cols}
        return out.withColumns(result).drop(*tmp.values(), *[f"{t}_b" for t in tmp.values()])

    def running_max(self, df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
        """``{output: column}``: greatest value among the rows strictly before each row."""
        tmp = {o: f"__max_{i}" for i, o in enumerate(cols)}
        before = Window.partitionBy(*self.keys, *self.parts).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, -1)
        out = df.select("*", *[F.max(cols[o]).over(before).alias(tmp[o]) for o in cols])
        found = {o: tmp[o] for o in cols}
        if self.parts:
            chunks = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            borders = (
                self._hot_rows(df)
                .groupBy(*self.keys, *self.parts)
                .agg(*[F.max(cols[o]).alias(tmp[o]) for o in cols])
                .select(*self.keys, *self.parts, *[F.max(tmp[o]).over(chunks).alias(f"{tmp[o]}_b") for o in cols])
            )
            out = out.join(borders, [*self.keys, *self.parts], "left")
            found = {o: f"greatest({tmp[o]}, {tmp[o]}_b)" for o in cols}
        result = {o: self._or_null(found[o]) for o in cols}
        return out.withColumns(result).drop(*tmp.values(), *[f"{t}_b" for t in tmp.values()])

    # -- helpers ----------------------------------------------------------

    def _present_sql(self) -> str:
        return " AND ".join(f"`{k}` IS NOT NULL" for k in self.keys)

    def _keys_present(self) -> Column:
        return F.expr(self._present_sql())

    def _or_null(self, value: str) -> Column:
        """The value, except for rows without a key: they belong to no entity."""
        return F.expr(f"CASE WHEN {self._present_sql()} THEN {value} END")

    def _hot_rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(HOT).isNotNull())

    def _fill(self, df: DataFrame, cols: Mapping[str, Column | str], forward: bool,
              exclusive: bool = False) -> DataFrame:
        values = {o: F.col(f"`{v}`") if isinstance(v, str) else v for o, v in cols.items()}
        tmp = {o: f"__fill_{i}" for i, o in enumerate(cols)}
        # Looking ahead is looking back in reversed order: a frame that ends at the
        # current row is evaluated incrementally, one that starts there is not.
        order = [F.col(c).asc() if forward else F.col(c).desc() for c in self.order]
        rows = (
            Window.partitionBy(*self.keys, *self.parts)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
        )
        local = df.select("*", *[F.last(values[o], ignorenulls=True).over(rows).alias(tmp[o]) for o in cols])
        found = {o: tmp[o] for o in cols}
        if self.parts:
            at_border = F.max_by if forward else F.min_by
            ordered = F.struct(*self.order)
            chunks = (
                Window.partitionBy(*self.keys)
                .orderBy(F.col(CHUNK).asc() if forward else F.col(CHUNK).desc())
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            borders = (
                self._hot_rows(df)
                .groupBy(*self.keys, *self.parts)
                .agg(*[at_border(values[o], F.when(values[o].isNotNull(), ordered)).alias(tmp[o]) for o in cols])
                .select(
                    *self.keys, *self.parts,
                    *[F.last(tmp[o], ignorenulls=True).over(chunks).alias(f"{tmp[o]}_b") for o in cols],
                )
            )
            local = local.join(borders, [*self.keys, *self.parts], "left")
            found = {o: f"coalesce({tmp[o]}, {tmp[o]}_b)" for o in cols}
        result = {o: self._or_null(found[o]) for o in cols}
        return local.withColumns(result).drop(*tmp.values(), *[f"{t}_b" for t in tmp.values()])


def _rank(borders: str, value: Column) -> Column:
    """Number of borders at or below a value; the sorted array is looked at in two steps."""
    whole = F.col(borders)
    heads = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / STEP).cast("int")), lambda i: F.get(whole, i * STEP))
    block = F.size(F.filter(heads, lambda x: x <= value))
    rest = F.size(F.filter(F.slice(whole, (F.greatest(block, F.lit(1)) - 1) * STEP + 1, F.lit(STEP)), lambda x: x <= value))
    return F.when(value.isNotNull(), F.when((F.size(whole) < 1) | (block < 1), F.lit(0)).otherwise((block - 1) * STEP + rest))


# -- one-step forms ----------------------------------------------------------


def forward_fill(line: Timeline, cols: Mapping[str, Column | str]):
    return lambda df: line.unsplit(line.fill_forward(line.split(df), cols))


def backward_fill(line: Timeline, cols: Mapping[str, Column | str]):
    return lambda df: line.unsplit(line.fill_backward(line.split(df), cols))


def next_or_self(line: Timeline, cols: Mapping[str, str]):
    return lambda df: line.unsplit(line.next_or_self(line.split(df), cols))


def first_where(line: Timeline, cols: Mapping[str, tuple[Column, str]]):
    return lambda df: line.unsplit(line.first_where(line.split(df), cols))


def keep_first(keys: Sequence[str], order: Sequence[Column | str]):
    """First row of every key, in a total order.

    ``row_number() = 1`` is cut down to one row per key *before* the shuffle
    (window group limit), so a hot key costs no more than any other.
    """

    def op(df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")

    return op


def keep_last(keys: Sequence[str], order: Sequence[str]):
    """Last row of every key."""
    return keep_first(keys, [F.col(c).desc() for c in order])
