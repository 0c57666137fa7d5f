"""Intervals of days: the general range join, and the union of overlapping intervals.

A day meets every interval that contains it, wherever the interval starts and however many
overlap. The join is an equality on (entity, level, bin): an interval is laid over the bins
of the level that fits its length, at most ``REACH`` + 1 of them, and a day stands in one bin of
every level. Hot bins are spread over slices, so neither an entity nor a week that holds a large part of the
rows ends in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.operators import joins
from shiftloom.operators.projection import q
from shiftloom.operators.timeline import ROWS_PER_CHUNK, Timeline

# Days of a bin by level; an interval goes to the first level of whose bins it covers REACH at most.
LEVELS = (32, 1024, 32_768, 1_048_576)
REACH = 32
LEVEL, BIN = "__level", "__bin"


def _bin(day: Column, width: Column | int) -> Column:
    return F.floor(F.unix_date(day) / width).cast("int")


def valid(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals with both ends, in order; the others contain no day."""
    return intervals.where(q(start) <= q(end))


def binned_intervals(intervals: DataFrame, start: str, end: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """One row per bin that an interval touches."""
    length = F.datediff(q(end), q(start))
    level = F.lit(len(levels) - 1)
    for i in reversed(range(len(levels) - 1)):
        level = F.when(length <= levels[i] * REACH - levels[i], F.lit(i)).otherwise(level)
    rows = valid(intervals, start, end).withColumn(LEVEL, level)
    width = F.element_at(F.array(*[F.lit(w) for w in levels]), F.col(LEVEL) + 1)
    return rows.withColumn(BIN, F.explode(F.sequence(_bin(q(start), width), _bin(q(end), width))))


def binned_days(days: DataFrame, day: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """One row per level and day: the bin in which the day stands."""
    places = [F.struct(F.lit(i).alias(LEVEL), _bin(q(day), w).alias(BIN)) for i, w in enumerate(levels)]
    if len(places) == 1:
        return days.withColumns({LEVEL: F.lit(0), BIN: _bin(q(day), levels[0])})
    return days.select("*", F.inline(F.array(*places)))


def levels_up_to(longest: int | None) -> tuple[int, ...]:
    """The levels needed where no interval is longer than ``longest`` days.

    It saves copies of the days, no more: a longer interval covers more bins of the last level.
    """
    if longest is None:
        return LEVELS
    fitting = [i for i, w in enumerate(LEVELS) if longest <= w * REACH - w]
    return LEVELS[:fitting[0] + 1] if fitting else LEVELS


def range_join(intervals: DataFrame, entity: str, day: str, start: str, end: str, longest: int | None = None,
               per_slice: int = joins.ROWS_PER_SLICE):
    """Every pair of a row and an interval of the same entity that contains the row's day.

    ``entity`` has the same name on both sides and is kept once; other names must differ.
    Rows without an entity or a day, and intervals without an end, meet nothing.
    """
    levels = levels_up_to(longest)
    keys = [entity, LEVEL, BIN]

    def op(df: DataFrame) -> DataFrame:
        rows = binned_days(df.dropna("any", subset=[entity, day]), day, levels)
        bins = binned_intervals(intervals.dropna("any", subset=[entity]), start, end, levels)
        hot = joins.hot_slices(joins.row_counts(rows, keys), keys, per_slice=per_slice)
        on = [*keys, joins.SLICE]
        met = joins.spread(rows, keys, hot).join(joins.repeat(bins, keys, hot), on)
        return met.where(q(day).between(q(start), q(end))).drop(LEVEL, BIN, joins.SLICE)

    return op


def covering(intervals: DataFrame, entity: str, day: str, start: str, end: str, aggs: dict[str, Column],
             longest: int | None = None, per_slice: int = joins.ROWS_PER_SLICE):
    """Aggregates, per row, over all intervals that contain its day; null where there is none.

    The join runs on distinct (entity, day), which the calendar bounds, with one row per
    equal interval and the number of its repeats (``__times``); the results are joined back.
    """

    def op(df: DataFrame) -> DataFrame:
        days = df.select(entity, day).dropna("any").distinct()
        once = valid(intervals, start, end).groupBy(entity, start, end).agg(F.count(F.lit(1)).alias("__times"))
        found = days.transform(range_join(once, entity, day, start, end, longest, per_slice))
        totals = found.groupBy(entity, day).agg(*[a.alias(c) for c, a in aggs.items()])
        return joins.spread_join(df, totals, [entity, day], per_slice=per_slice)

    return op


def covered_flag(intervals: DataFrame, entity: str, day: str, start: str, end: str, out: str, unless: Column | None = None,
                 rows_per_chunk: int = ROWS_PER_CHUNK):
    """1 on days inside any interval of the entity, else null; ``unless`` exempts rows.

    Overlapping intervals are united first, so a day meets one span at most.
    """

    def op(df: DataFrame) -> DataFrame:
        spans = intervals.transform(union(Timeline([entity], [start, end], rows_per_chunk=rows_per_chunk), start, end))
        flagged = df.transform(covering(spans, entity, day, start, end, {out: F.max(F.lit(1))}))
        return flagged if unless is None else flagged.withColumn(out, F.when(~F.coalesce(unless, F.lit(False)), F.col(out)))

    return op


def union(line: Timeline, start: str, end: str, aggs: dict[str, Column] | None = None, gap: int = 1):
    """Overlapping intervals of an entity as one span; spans closer than ``gap`` days apart join too.

    ``line`` names the entity columns. A new span begins where the start lies beyond the
    greatest end before it; chunks of hot entities carry that end over their borders, and a span's
    intervals combine before the shuffle. Gives keys, start, end and ``aggs`` over the
    intervals of the span. Intervals without an end, or that end before they start,
    and rows without a key are left out.
    """
    ordered = replace(line, order=[start, end], position=F.unix_date(q(start)), tiebreak=F.unix_date(q(end)))

    def op(df: DataFrame) -> DataFrame:
        rows = ordered.split(valid(df, start, end).dropna("any", subset=list(line.keys)))
        reached = ordered.running_max(rows, {"__reach": end})
        begins = F.col("__reach").isNull() | (q(start) > F.date_add(F.col("__reach"), gap))
        spans = ordered.fill_forward(reached, {"__begin": F.when(begins, q(start))})
        extra = [a.alias(c) for c, a in (aggs or {}).items()]
        merged = spans.groupBy(*line.keys, "__begin").agg(F.max(end).alias("__end"), *extra)
        return merged.withColumnsRenamed({"__begin": start, "__end": end})

    return op
