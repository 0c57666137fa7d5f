"""Published tables and a fact that is kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import rules
from shiftloom.functions.dates import week_ending_friday
from shiftloom.operators import joins, overlays
from shiftloom.operators.overlays import EventFeed
from shiftloom.plans import corrections as C
from shiftloom.plans import schedule as S
from shiftloom.queries.overlays import dated, dated_sql
from shiftloom.queries.registry import DAY_LINE, USER_DAYS_SQL, Tables, query, user_days, week_sql
from shiftloom.queries.schedule import coefficient_sql
from shiftloom.session import scratch_path
from shiftloom.sources.published import publish, read_published


@query("publish_latest", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def publish_latest(t: Tables) -> DataFrame:
    """The latest state after a job has replaced the table that it reads."""
    path = scratch_path(t.spark, "published")
    publish(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), path)
    mine = read_published(t.spark, path)
    doubled = mine.where(F.col("o_orderstatus") != "P").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    publish(doubled.drop("o_orderstatus"), path)
    return read_published(t.spark, path)


@query(
    "publish_partitions",
    "SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN value + 1 ELSE value END AS value "
    "FROM events WHERE event_type <> 'signup'",
)
def publish_partitions(t: Tables) -> DataFrame:
    """Three of the partitions replaced, one of them by nothing; the others stay where they are."""
    path, kinds = scratch_path(t.spark, "partitions"), ["click", "view", "signup"]
    publish(t.events.select("event_id", "event_type", "value"), path, "event_type")
    some = read_published(t.spark, path, only=kinds).where(F.col("event_type") != "signup")
    publish(some.withColumn("value", F.col("value") + 1), path, "event_type", replace=kinds)
    return read_published(t.spark, path)


def _feed(events: DataFrame) -> EventFeed:
    return EventFeed("ev", events, "who", "eff", {"unit": "unit", "flow": "flow"}, ["event_id"])


_UNIT = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'unit ' || event_id % 3 END"
_FLOW = "'flow ' || event_id % 4"
_CARRY = "last_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day, src ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"


@query(
    "late_corrections",
    f"""
    WITH {USER_DAYS_SQL}, {dated_sql('moves', 'purchase', f'{_UNIT} AS unit, {_FLOW} AS flow')},
    {dated_sql('late', 'signup', 'CAST(event_id % 3 AS INTEGER) AS status')},
    marks AS (SELECT user_id, day, kind, 1 AS src, NULL AS unit, NULL AS flow FROM user_days
      UNION ALL SELECT who, eff, NULL, 0, unit, flow FROM moves),
    carried AS (SELECT user_id, day, kind, src, {_CARRY.format(c='unit')}, {_CARRY.format(c='flow')} FROM marks),
    rows AS (SELECT c.user_id, c.day, {week_sql('c.day')} AS week, unit, flow,
        coalesce(CASE WHEN kind = 'error' THEN 1 WHEN kind = 'view' THEN 0 END, status) AS status
      FROM carried c LEFT JOIN late ON c.user_id = late.who AND c.day = late.eff WHERE src = 1),
    flags AS (SELECT *, CASE WHEN status = 1 THEN 0 ELSE 1 END AS s, CASE WHEN status = 1 THEN 1 ELSE 0 END AS l FROM rows),
    weeks AS (SELECT *, sum(s) OVER w AS d, sum(s + l) OVER w AS t FROM flags WINDOW w AS (PARTITION BY user_id, week)),
    marked AS (SELECT *, max(CASE WHEN dayofweek(day) = 5 AND l = 1 AND d = 4 THEN 1 END) OVER (PARTITION BY user_id, week) AS m FROM weeks)
    SELECT user_id, day, week, unit, flow, status, {coefficient_sql('t', 'd', 'm', 's', 'l', 'dayofweek(day) = 5')} AS wsc FROM marked
    """,
)
def late_corrections(t: Tables) -> DataFrame:
    """A fact built from feeds that lack rows and hold wrong ones, then corrected."""
    path = scratch_path(t.spark, "fact")
    kind = F.col("kind")
    base = user_days(t).select("user_id", "day", F.when(kind == "error", F.lit(1)).when(kind == "view", F.lit(0)).alias("status"))
    moves = dated(t, "purchase").select("who", "eff", "event_id", F.expr(_UNIT).alias("unit"), F.expr(_FLOW).alias("flow"))
    late = dated(t, "signup").groupBy("who", "eff").agg((F.min("event_id") % 3).cast("int").alias("status"))
    base, moves, late = (C.stored(df, label) for df, label in ((base, "base"), (moves, "moves"), (late, "late")))
    wrong = moves.where(F.col("event_id") % 13 != 0).withColumn("flow", F.when(F.col("event_id") % 17 == 0, F.lit("wrong")).otherwise(F.col("flow")))
    early = late.where(F.col("eff") < "2024-01-12")
    status_fact(wrong, early).publish(base, path)
    changes = [C.changed_events(_feed(wrong), _feed(moves)), C.changed_days(early, late, "who", "eff")]
    C.refresh(status_fact(moves, late), base, path, changes)
    return read_published(t.spark, path)


def status_fact(moves: DataFrame, late: DataFrame) -> C.WeeklyFact:
    """Unit and flow carried from events, a status with a late feed behind it, and the week's coefficient.

    All windows come after the join, so that they share the partitioning by user.
    """

    def build(base: DataFrame, entities) -> DataFrame:
        filled = base.transform(joins.late_fallback(entities(late, "who"), {"user_id": "who", "day": "eff"}, {"status": "status"}))
        carried = filled.transform(overlays.effective_overlay(DAY_LINE, [_feed(entities(moves, "who"))], "user_id", "day", carry_in=True))
        absent = F.col("status") == 1
        flagged = carried.withColumns({"week": week_ending_friday("day"), "l": rules.flag(absent), "s": F.lit(1) - rules.flag(absent)})
        weighed = flagged.transform(S.weekly_coefficient("user_id", "week", "day", "s", "l", out="wsc", bounded=True))
        return weighed.select("user_id", "day", "week", "unit", "flow", "status", "wsc")

    return C.WeeklyFact("user_id", "day", "week", build)
