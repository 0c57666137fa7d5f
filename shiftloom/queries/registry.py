"""The catalog of queries and what the substrates have in common."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.functions import rules
from shiftloom.operators.timeline import Timeline
from shiftloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

RUN_DATE = dt.date(2024, 1, 15)


class Tables:
    """The Parquet tables of one scale factor, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None):
    """Registers ``fn(tables) -> DataFrame`` with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# -- substrates -------------------------------------------------------------------
# entity = user or customer, day = date of the event or order, cell = a code derived
# from the kinds of events on the day

CELL_OF_KIND = {"click": "M", "error": "L1", "purchase": "V", "signup": "E", "view": "L2"}
CELL_SQL = (
    "CASE min(event_type) WHEN 'click' THEN 'M' WHEN 'error' THEN 'L1' WHEN 'purchase' THEN 'V' "
    "WHEN 'signup' THEN 'E' WHEN 'view' THEN 'L2' END"
)


def user_days(t: Tables) -> DataFrame:
    """One row per (user, day): events combine before the shuffle, whoever has them.

    The alphabetically first kind of the day is found from one number per kind and not
    as the minimum of a text, which could not be aggregated by hashing.
    """
    seen = {k: F.max(F.when(F.col("event_type") == k, F.lit(1))).alias(f"has_{k}") for k in sorted(CELL_OF_KIND)}
    days = (
        t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type", "value")
        .groupBy("user_id", "day")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("hours"), *seen.values())
    )
    kind = rules.decision_list([(F.col(f"has_{k}") == 1, k) for k in seen], F.lit(None).cast("string"))
    days = days.select("user_id", "day", "n", "hours", kind.alias("kind"))
    return days.withColumn("value", rules.value_map("kind", CELL_OF_KIND))


USER_DAYS_SQL = f"""
user_days AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 2) AS hours,
         min(event_type) AS kind, {CELL_SQL} AS value
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

# One row per (user, day): an entity's rows are bounded by the calendar.
DAY_LINE = Timeline(["user_id"], ["day"])


def event_line() -> Timeline:
    """Raw events of a user in reading order: any number of rows, so cut where hot."""
    return Timeline(
        ["user_id"], ["ts", "event_id"],
        position=F.unix_micros(F.col("ts").cast("timestamp")), tiebreak=F.col("event_id"),
    )


WEEK_SQL = "({d} + CAST((12 - dayofweek({d})) % 7 AS INTEGER))"


def week_sql(d: str) -> str:
    """Friday that closes the week of a date expression."""
    return f"CAST({WEEK_SQL.format(d=d)} AS DATE)"
