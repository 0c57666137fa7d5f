"""Late corrections: a published fact is brought up to date where its feeds changed, not rebuilt.

The fact is divided by week. Changed feed rows give ranges of days per entity whose rows may
differ: one day for feeds that are looked up by day; for carried events all days up to
the next event that settles every column anew. Weeks that touch such a range are built again for
these entities only, from the base rows of the weeks and the events of the entities; rows
of all other entities are taken over from the published weeks. A week is written only if a row in it
came out different.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.dates import week_ending_friday
from shiftloom.operators.overlays import DAY, ENTITY, EventFeed, event_table
from shiftloom.operators.projection import q
from shiftloom.operators.sets import stack
from shiftloom.operators.timeline import Timeline
from shiftloom.session import scratch_path
from shiftloom.sources import published

FIRST, LAST = "__first", "__last"
OLD, NEW = "__old", "__new"
FOREVER = dt.date(9999, 12, 31)
# Weeks end in a year that has one: the range of days beyond it has no week.
LAST_DAY = dt.date(9999, 12, 24)


def differing(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``columns`` of the rows that only one side has, or one side more often.

    Both sides are counted together, with opposite signs, in one shuffle.
    """
    signed = stack(old.withColumn("__sign", F.lit(-1)), new.select(*[q(c) for c in old.columns]).withColumn("__sign", F.lit(1)))
    odd = signed.groupBy(*[q(c) for c in old.columns]).agg(F.sum("__sign").alias("__sign")).where(F.col("__sign") != 0)
    return odd.select(*columns).distinct()


def changed_days(old: DataFrame, new: DataFrame, entity: str, date: str) -> DataFrame:
    """(entity, first, last): the days of changed rows of a feed that is looked up by day."""
    rows = differing(old, new, [entity, date]).dropna("any")
    return rows.select(q(entity).alias(ENTITY), q(date).cast("date").alias(FIRST), q(date).cast("date").alias(LAST))


def changed_events(old: EventFeed, new: EventFeed) -> DataFrame:
    """(entity, first, last): from a changed event to the day before the next one that has all its columns.

    That later event settles the entity's rows on both sides. If it is itself new or
    different it is among the changed ones and has its own range. Both feeds are brought to one row
    per (entity, day) in one pass, so an entity's rows are bounded by the calendar.
    """
    both = event_table([replace(old, name=OLD), replace(new, name=NEW)])
    held = [F.col(side).isNotNull() for side in (OLD, NEW)]
    same = reduce(and_, [F.col(OLD)[o].eqNullSafe(F.col(NEW)[o]) for o in old.payload], held[0] == held[1])
    whole = reduce(and_, [F.col(NEW)[o].isNotNull() for o in new.payload], held[1])
    marks = both.select(ENTITY, DAY, (~same).alias("__dirty"), F.when(whole, F.col(DAY)).alias("__settled"))
    found = Timeline([ENTITY], [DAY]).following(marks, {"__next": "__settled"}).where("__dirty")
    last = F.coalesce(F.date_sub("__next", 1), F.lit(FOREVER))
    return found.select(ENTITY, F.col(DAY).alias(FIRST), last.alias(LAST))


@dataclass(frozen=True)
class WeeklyFact:
    """How a fact is built, and what it is built from.

    ``build(base, entities)`` gives the rows of ``base``, which holds whole weeks of some
    entities; ``entities`` (null for all) is a function that cuts a feed down to these entities:
    ``entities(feed, column)``. A row of the fact may depend on the base rows of its
    entity and week, on feed rows of its entity and day and on the entity's events up
    to the day. ``week`` is a date column of the fact; ``base`` need not have it.
    """

    entity: str
    date: str
    week: str
    build: Callable[[DataFrame, Callable[[DataFrame, str], DataFrame]], DataFrame]

    def with_week(self, base: DataFrame) -> DataFrame:
        return base if self.week in base.columns else base.withColumn(self.week, week_ending_friday(q(self.date)))

    def whole(self, base: DataFrame) -> DataFrame:
        return self.build(self.with_week(base), lambda feed, _: feed)

    def publish(self, base: DataFrame, path: str) -> published.State:
        """Builds everything."""
        return published.publish(self.whole(base).repartition(self.week, self.entity), path, partition_by=self.week)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once: what reads them several times does not make them several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched(pairs: DataFrame, ranges: DataFrame, entity: str, week: str) -> DataFrame:
    """Distinct (entity, week) of ``pairs`` that a range of days of the entity touches.

    A week is touched if the greatest end among the ranges that begin in it or before reaches it.
    One row per entity and week is left before the ordered pass, so the calendar bounds it.
    """
    begins, ends = (week_ending_friday(F.least(c, F.lit(LAST_DAY))) for c in (FIRST, LAST))
    starts = ranges.select(q(ENTITY).alias(entity), begins.alias(week), ends.alias(LAST))
    marks = stack(pairs.dropna("any").withColumn("__row", F.lit(True)), starts.dropna("any"))
    weeks = marks.groupBy(entity, week).agg(F.max(LAST).alias(LAST), F.max("__row").alias("__row"))
    reached = Timeline([entity], [week]).running_max(weeks, {"__reach": LAST})
    return reached.where(F.col("__row") & (F.greatest(LAST, "__reach") >= q(week))).select(entity, week)


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: weeks looked at, weeks written, and the state it left."""

    weeks: list[dt.date]
    written: list[dt.date]
    state: published.State


def refresh(fact: WeeklyFact, base: DataFrame, path: str, changes: Sequence[DataFrame]) -> Refresh:
    """Brings the fact at ``path`` up to date; afterwards it equals a full build.

    ``base`` and the feeds behind ``fact.build`` are the new ones; ``changes`` come from
    :func:`changed_days` and :func:`changed_events`, over every feed and ``base`` itself.
    The driver sees the bounds of the changes and the weeks concerned, which the calendar
    bounds; scratch tables hold the dirty (entity, week) pairs and their new rows. Fact
    rows without an entity or a day belong to no range and stay as they are.
    """
    spark = base.sparkSession
    before = published.state(spark, path)
    if before is None:
        raise ValueError(f"nothing is published at {path}")
    ranges = stored(stack(*changes).dropna("any"), "changed")
    low, high = ranges.agg(F.min(FIRST), F.max(LAST)).first()
    if low is None:
        return Refresh([], [], before)
    inside = [p.value for p in before.parts if p.value is not None and str(low) <= p.value and dt.date.fromisoformat(p.value) - dt.timedelta(6) <= high]
    entity, week = fact.entity, fact.week
    rows = fact.with_week(base)
    standing = published._frame(spark, path, before, inside)
    near = rows.where(q(week).between(week_ending_friday(F.lit(low)), week_ending_friday(F.least(F.lit(high), F.lit(LAST_DAY)))))
    dirty = stored(touched(stack(near.select(entity, week), standing.select(entity, week)), ranges, entity, week), "dirty")
    weeks = sorted(r[0] for r in dirty.select(week).distinct().collect())
    if not weeks:
        return Refresh([], [], before)
    people = dirty.select(entity).distinct()

    def of_them(feed: DataFrame, column: str) -> DataFrame:
        return feed.join(people.select(q(entity).alias("__who")), q(column) == F.col("__who"), "left_semi")

    on = [entity, week]
    new = stored(fact.build(near.where(q(week).isin(weeks)).join(dirty, on, "left_semi"), of_them).select(*[q(c) for c in before.schema.names]), "rebuilt")
    old = published._frame(spark, path, before, weeks)
    changed = differing(old.join(dirty, on, "left_semi"), new, [week])
    written = sorted(r[0] for r in changed.collect())
    if not written:
        return Refresh(weeks, [], before)
    kept = published._frame(spark, path, before, written).join(dirty, on, "left_anti")
    both = stack(kept, new.where(q(week).isin(written))).select(*[q(c) for c in before.schema.names]).repartition(week, entity)
    return Refresh(weeks, written, published.publish(both, path, week, written, since=before))
