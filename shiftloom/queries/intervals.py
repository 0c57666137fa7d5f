"""Intervals that overlap, and that start on days the fact lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.operators import intervals
from shiftloom.operators.timeline import Timeline
from shiftloom.queries.registry import USER_DAYS_SQL, Tables, query, user_days

# A ticket lasts a number of days that follows from its id: most some days, every 40th over a year, some without an end.
_LENGTH = "CASE WHEN event_id % 40 = 7 THEN 400 WHEN event_id % 40 = 8 THEN NULL ELSE event_id % 9 END"
_TICKETS_SQL = f"""
tickets AS (SELECT event_id AS ticket, user_id, event_type AS kind, CAST(ts AS DATE) AS lo,
    CAST(ts AS DATE) + CAST({_LENGTH} AS INTEGER) AS hi FROM events WHERE event_type IN ('signup', 'purchase'))"""


def tickets(t: Tables) -> DataFrame:
    rows = t.events.where(F.col("event_type").isin("signup", "purchase"))
    day = F.col("ts").cast("date")
    return rows.select(F.col("event_id").alias("ticket"), "user_id", F.col("event_type").alias("kind"), day.alias("lo"),
                       F.date_add(day, F.expr(_LENGTH).cast("int")).alias("hi"))


@query(
    "range_join",
    f"""
    WITH {_TICKETS_SQL}
    SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS day, ticket, kind, lo, hi FROM events e
    JOIN tickets i ON e.user_id = i.user_id AND CAST(e.ts AS DATE) BETWEEN lo AND hi WHERE e.event_type = 'error'
    """,
)
def range_join(t: Tables) -> DataFrame:
    """Every error with every ticket that was open on its day."""
    errors = t.events.where(F.col("event_type") == "error").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    return errors.transform(intervals.range_join(tickets(t), "user_id", "day", "lo", "hi"))


@query(
    "interval_cover",
    f"""
    WITH {USER_DAYS_SQL}, {_TICKETS_SQL}
    SELECT d.user_id, d.day, d.value, count(ticket) AS n_open, min(lo) AS since, max(hi) AS until
    FROM user_days d LEFT JOIN tickets i ON d.user_id = i.user_id AND d.day BETWEEN lo AND hi GROUP BY ALL
    """,
)
def interval_cover(t: Tables) -> DataFrame:
    """Per day of the fact: how many tickets are open, since when and until when."""
    fact = user_days(t).select("user_id", "day", "value")
    aggs = {"n_open": F.sum("__times"), "since": F.min("lo"), "until": F.max("hi")}
    covered = fact.transform(intervals.covering(tickets(t), "user_id", "day", "lo", "hi", aggs))
    return covered.withColumn("n_open", F.coalesce("n_open", F.lit(0)))


_UNION_SQL = f"""{_TICKETS_SQL},
reach AS (SELECT *, max(hi) OVER (PARTITION BY user_id, kind ORDER BY lo, hi, ticket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM tickets WHERE lo <= hi),
islands AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before + 1 THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id, kind ORDER BY lo, hi, ticket ROWS UNBOUNDED PRECEDING) AS island FROM reach),
spans AS (SELECT user_id, kind, min(lo) AS lo, max(hi) AS hi, count(*) AS tickets FROM islands GROUP BY user_id, kind, island)"""


@query("interval_union", f"WITH {_UNION_SQL} SELECT user_id, kind, lo, hi, tickets, hi - lo + 1 AS days FROM spans")
def interval_union(t: Tables) -> DataFrame:
    """Tickets of a user and kind as disjoint spans, with the days they cover."""
    spans = tickets(t).transform(
        intervals.union(Timeline(["user_id", "kind"], []), "lo", "hi", {"tickets": F.count(F.lit(1))}))
    return spans.withColumn("days", (F.datediff("hi", "lo") + 1).cast("long"))


@query(
    "interval_flag",
    f"""
    WITH {USER_DAYS_SQL}, {_TICKETS_SQL}
    SELECT user_id, day, value, CASE WHEN value NOT IN ('L1', 'L2') AND EXISTS (
      SELECT 1 FROM tickets i WHERE i.user_id = d.user_id AND d.day BETWEEN lo AND hi) THEN 1 END AS abs_fcst FROM user_days d
    """,
)
def interval_flag(t: Tables) -> DataFrame:
    """Forecast absence from all tickets and not from the latest one only."""
    fact = user_days(t).select("user_id", "day", "value")
    return fact.transform(intervals.covered_flag(tickets(t), "user_id", "day", "lo", "hi", "abs_fcst",
                                                 unless=F.col("value").isin("L1", "L2")))
