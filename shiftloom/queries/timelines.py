"""Ordered operators: fills, next values, deduplication, first dates, week totals."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules
from shiftloom.operators import timeline
from shiftloom.plans import schedule as S
from shiftloom.queries.registry import DAY_LINE, USER_DAYS_SQL, Tables, event_line, query, user_days, week_sql


def readings(t: Tables) -> DataFrame:
    """Events whose errors carry no value."""
    return t.events.select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )


_READINGS_SQL = "readings AS (SELECT user_id, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"


@query(
    "forward_fill",
    f"WITH {_READINGS_SQL} SELECT user_id, ts, event_id, v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM readings",
)
def forward_fill(t: Tables) -> DataFrame:
    return readings(t).transform(timeline.forward_fill(event_line(), {"filled": "v"}))


@query(
    "backward_fill",
    f"WITH {_READINGS_SQL}, weeks AS (SELECT *, {week_sql('CAST(ts AS DATE)')} AS week_ending FROM readings) "
    "SELECT user_id, week_ending, event_id, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id, week_ending "
    "ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM weeks",
)
def backward_fill(t: Tables) -> DataFrame:
    rows = readings(t).withColumn("week_ending", dates.week_ending_friday(F.col("ts").cast("date")))
    line = replace(event_line(), keys=["user_id", "week_ending"])
    return rows.transform(timeline.backward_fill(line, {"filled": "v"})).drop("v", "ts")


@query(
    "lead_default_self",
    "SELECT event_id, user_id, event_type, coalesce(lead(nullif(event_type, 'view')) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id), nullif(event_type, 'view')) AS next_type FROM events",
)
def lead_default_self(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts", "user_id", "event_type", rules.sentinel_to_null("event_type", "view").alias("k"))
    return rows.transform(timeline.next_or_self(event_line(), {"next_type": "k"})).drop("k", "ts")


_KEPT = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders " \
        "QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey{desc}) = 1"


def dated_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_totalprice")


@query("dedupe_first", _KEPT.format(desc=""))
def dedupe_first(t: Tables) -> DataFrame:
    return dated_orders(t).transform(timeline.keep_first(["o_custkey", "day"], ["o_orderkey"]))


@query("dedupe_last", _KEPT.format(desc=" DESC"))
def dedupe_last(t: Tables) -> DataFrame:
    return dated_orders(t).transform(timeline.keep_last(["o_custkey", "day"], ["o_orderkey"]))


@query(
    "first_qualifying_date",
    f"""
    WITH {USER_DAYS_SQL},
    people AS (SELECT user_id, day, value, CASE WHEN user_id % 3 = 0 THEN 'Trainee' WHEN user_id % 3 = 1 THEN 'Analyst' END AS role,
      CASE WHEN user_id % 7 > 0 THEN 'Active' ELSE 'Gone' END AS status, 'non-billable' AS billable FROM user_days),
    promoted AS (SELECT * EXCLUDE (role), CASE WHEN role = 'Trainee' AND day >= min(CASE WHEN value IN ('M', 'E') AND role = 'Trainee'
      THEN day END) OVER (PARTITION BY user_id) THEN 'Analyst' ELSE role END AS role FROM people)
    SELECT user_id, day, role, CASE WHEN role = 'Analyst' AND status = 'Active' AND day >= min(CASE WHEN value IN ('M', 'E')
      AND role = 'Analyst' AND billable = 'non-billable' THEN day END) OVER (PARTITION BY user_id)
      THEN 'billable' ELSE billable END AS billable FROM promoted
    """,
)
def first_qualifying_date(t: Tables) -> DataFrame:
    user = F.col("user_id")
    people = user_days(t).select(
        "user_id", "day", "value",
        F.when(user % 3 == 0, F.lit("Trainee")).when(user % 3 == 1, F.lit("Analyst")).alias("role"),
        F.when(user % 7 > 0, F.lit("Active")).otherwise(F.lit("Gone")).alias("status"),
        F.lit("non-billable").alias("billable"),
    )
    working = F.col("value").isin("M", "E")
    return (
        people.transform(S.promote_trainees(DAY_LINE, "role", "day", working))
        .transform(S.promote_billable(DAY_LINE, "role", "status", "billable", "day", working))
        .select("user_id", "day", "role", "billable")
    )


@query(
    "week_totals",
    f"""
    WITH {USER_DAYS_SQL}, weeks AS (SELECT user_id, day, n, {week_sql('day')} AS week_ending FROM user_days)
    SELECT user_id, day, week_ending, n, sum(n) OVER (PARTITION BY user_id, week_ending)::BIGINT AS week_n FROM weeks
    """,
)
def week_totals(t: Tables) -> DataFrame:
    days = user_days(t).select("user_id", "day", "n", dates.week_ending_friday("day").alias("week_ending"))
    # at most seven rows per (user, week), as user_days has one per day
    return days.withColumn("week_n", F.sum("n").over(Window.partitionBy("user_id", "week_ending")))


_ATTRIBUTES = {
    "role": "CASE WHEN n = 4 THEN NULL WHEN n > 2 THEN 'Analyst' ELSE 'Trainee' END",
    "unit": "CASE WHEN kind = 'view' THEN NULL WHEN hours > 150 THEN 'CUSTOMER_SUPPORT' ELSE 'COMMUNITY_OPS' END",
    "flow": "CASE WHEN hours < 5 THEN NULL WHEN kind = 'click' THEN 'MISREPRESENTATION' ELSE 'Content Moderation' END",
    "market": "CASE WHEN hours BETWEEN 60 AND 70 THEN NULL WHEN kind = 'error' THEN 'PT' ELSE 'ES' END",
}


def _shorten(sql: str) -> str:
    for old, new in (("CUSTOMER_SUPPORT", "CS"), ("COMMUNITY_OPS", "CO"), ("MISREPRESENTATION", "MISREP"), ("Content Moderation", "CM")):
        sql = f"replace({sql}, '{old}', '{new}')"
    return sql


_NEXT = "coalesce(lead({c}) OVER (PARTITION BY user_id ORDER BY day), {c}) AS next_{c}"
_CHANGE = _shorten("unit || '_' || flow || '_' || market || ' to ' || next_unit || '_' || next_flow || '_' || next_market")


@query(
    "attribute_change",
    f"""
    WITH {USER_DAYS_SQL},
    people AS (SELECT user_id, day, {', '.join(f'{sql} AS {c}' for c, sql in _ATTRIBUTES.items())} FROM user_days),
    s1 AS (SELECT *, {_NEXT.format(c='role')} FROM people WHERE role IS NOT NULL),
    s2 AS (SELECT *, {_NEXT.format(c='unit')} FROM s1 WHERE unit IS NOT NULL),
    s3 AS (SELECT *, {_NEXT.format(c='flow')} FROM s2 WHERE flow IS NOT NULL),
    s4 AS (SELECT *, {_NEXT.format(c='market')} FROM s3 WHERE market IS NOT NULL)
    SELECT user_id, day, role, unit, flow, market,
      CASE WHEN role <> next_role THEN role || ' to ' || next_role END AS role_change,
      CASE WHEN unit <> next_unit OR flow <> next_flow OR market <> next_market THEN {_CHANGE} END AS cross_change
    FROM s4
    """,
)
def attribute_change(t: Tables) -> DataFrame:
    people = user_days(t).select("user_id", "day", *[F.expr(sql).alias(c) for c, sql in _ATTRIBUTES.items()])
    return people.transform(S.attribute_change(DAY_LINE, "role", "unit", "flow", "market"))
