"""Effective-dated overlays: dated events carried forward over an entity's days.

An event applies from the day it meets in the fact on. The payload columns of an
event are carried independently of each other unless ``atomic`` is set: an event
with a null payload column leaves the older value of that column in force.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import rules
from shiftloom.operators.joins import SLICE, repeat
from shiftloom.operators.projection import q
from shiftloom.operators.sets import stack
from shiftloom.operators.timeline import Timeline

ENTITY, DAY = "__entity", "__day"


@dataclass(frozen=True)
class EventFeed:
    """Dated events of one kind.

    ``payload`` maps output names to feed columns; ``order`` breaks the tie between
    several events of one entity on one day (the least one is kept). Feeds that are
    told apart by ``where``, a SQL condition, on the same frame are read in one scan.
    """

    name: str
    df: DataFrame
    entity: str
    date: str
    payload: Mapping[str, str]
    order: Sequence[str] = ()
    where: str = "TRUE"

    @property
    def tie(self) -> str:
        return f"__tie_{self.name}"

    def condition(self) -> str:
        return f"({self.where}) AND `{self.entity}` IS NOT NULL AND `{self.date}` IS NOT NULL"

    def key_sql(self) -> str:
        return f"'{ENTITY}', `{self.entity}`, '{DAY}', CAST(`{self.date}` AS DATE)"

    def event_sql(self, present: bool = True) -> str:
        """Payload and tie-break, or typed nulls for an event of another kind."""
        payload = ", ".join(f"'{o}', `{c}`" for o, c in self.payload.items())
        tie = ", ".join(f"'o{i}', `{c}`" for i, c in enumerate([*self.order, *self.payload.values()]))
        columns = {self.name: f"named_struct({payload})", self.tie: f"named_struct({tie})"}
        return ", ".join(f"'{n}', IF({present}, {v}, NULL)" for n, v in columns.items())


def _one_scan(feeds: Sequence[EventFeed]) -> DataFrame:
    """All events of feeds that share a frame: every row gives one event per feed it matches."""
    events = [
        f"IF({f.condition()}, named_struct({f.key_sql()}, {', '.join(g.event_sql(g is f) for g in feeds)}), NULL)"
        for f in feeds
    ]
    some = " OR ".join(f"({f.condition()})" for f in feeds)
    return feeds[0].df.where(some).selectExpr(f"inline(filter(array({', '.join(events)}), e -> e IS NOT NULL))")


def event_table(feeds: Sequence[EventFeed]) -> DataFrame:
    """One row per (entity, day) with a struct per kind of event, null where there is none.

    All feeds are aggregated in one pass, so that a fact is joined once and not once
    per feed.
    """
    by_frame: dict[int, list[EventFeed]] = {}
    for f in feeds:
        by_frame.setdefault(id(f.df), []).append(f)
    together = stack(*[_one_scan(group) for group in by_frame.values()])
    return together.groupBy(ENTITY, DAY).agg(*[F.min_by(f.name, f.tie).alias(f.name) for f in feeds])


def attach_events(feeds: Sequence[EventFeed], entity: str, date: str, hot: DataFrame | None = None):
    """Adds the struct column of every feed on the days that have an event.

    ``hot`` is for facts that may repeat an (entity, day) without bound and have been
    :func:`~shiftloom.operators.joins.spread`: the slices of their entities.
    """
    events = event_table(feeds).withColumnsRenamed({ENTITY: entity, DAY: date})
    on = [entity, date]
    if hot is not None:
        events, on = repeat(events, [entity], hot), [*on, SLICE]
    return lambda df: df.join(events, on, "left")


def payload_of(feed: EventFeed, atomic: bool = False) -> dict[str, Column]:
    """The columns to carry forward for a feed."""
    if atomic:
        return {f"__whole_{feed.name}": F.col(feed.name)}
    return {o: F.col(f"{feed.name}.{o}") for o in feed.payload}


def effective_overlay(line: Timeline, feeds: Sequence[EventFeed], entity: str, date: str,
                      carry_in: bool = False, atomic: bool = False):
    """Payload columns of the latest event at or before each day.

    By default an event must fall on a day the entity has in the fact; with
    ``carry_in`` events between or before its days count as well.
    """

    def op(df: DataFrame) -> DataFrame:
        if carry_in:
            marks = event_table(feeds).select(
                F.col(ENTITY).alias(entity), F.col(DAY).alias(date),
                *[f.name for f in feeds], F.lit(0).alias("__src"),
            )
            rows = stack(df.withColumn("__src", F.lit(1)), marks)
            run = replace(line, order=[date, "__src", *[c for c in line.order if c != date]])
        else:
            rows, run = df.transform(attach_events(feeds, entity, date)), line
        carried = {k: v for f in feeds for k, v in payload_of(f, atomic).items()}
        filled = run.unsplit(run.fill_forward(run.split(rows), carried))
        if carry_in:
            filled = filled.where(F.col("__src") == 1).drop("__src")
        if atomic:
            whole = {o: F.col(f"__whole_{f.name}")[o] for f in feeds for o in f.payload}
            filled = filled.withColumns(whole).drop(*[f"__whole_{f.name}" for f in feeds])
        return filled.drop(*[f.name for f in feeds])

    return op


def interval_overlay(line: Timeline, feed: EventFeed, entity: str, date: str, start: str, end: str,
                     out: str, unless: Column | None = None):
    """1 on days inside the latest event's [start, end], else null.

    ``start`` and ``end`` are payload names; ``unless`` exempts rows.
    """

    def op(df: DataFrame) -> DataFrame:
        filled = df.transform(effective_overlay(line, [feed], entity, date))
        hit = q(date).between(F.col(start), F.col(end))
        if unless is not None:
            hit = hit & ~F.coalesce(unless, F.lit(False))
        return filled.withColumn(out, F.when(hit, F.lit(1))).drop(start, end)

    return op


def from_date_on(date: str, effective: str, column: str, new: str):
    """One overriding step: the carried value from its effective date on, even a null one."""
    return lambda df: df.withColumn(column, rules.override(column, q(date) >= F.col(effective), F.col(new)))
