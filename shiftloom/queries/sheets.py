"""Sheets of several periods, and storage in which daily joins find their rows in place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates
from shiftloom.operators.overlays import EventFeed, event_table
from shiftloom.queries.overlays import carry, dated, dated_sql
from shiftloom.queries.registry import DAY_LINE, USER_DAYS_SQL, Tables, query, user_days
from shiftloom.session import scratch_path
from shiftloom.sources import bucketed, sheets


def landed_weeks(t: Tables) -> str:
    """One CSV sheet per week: users who were seen in it, and the week's own day columns.

    Headers are serials in one week and texts in the next; the ids stand first or last.
    """
    days = user_days(t).select("user_id", "day", "value", F.date_trunc("week", "day").cast("date").alias("week"))
    odd = F.pmod(F.datediff("week", F.lit("1970-01-05").cast("date")) / 7, F.lit(2)) == 1
    columns = days.select("week", "day").distinct().groupBy("week").agg(F.sort_array(F.collect_list("day")).alias("days"))  # a week has seven
    people = days.groupBy("user_id", "week").agg(F.map_from_entries(F.collect_list(F.struct("day", "value"))).alias("cells"))
    name = F.transform("days", lambda d: F.when(odd, F.date_format(d, "M/d/yyyy")).otherwise(F.datediff(d, F.lit(dates.SERIAL_EPOCH)).cast("string")))
    ids = F.concat(F.lit("U"), F.col("user_id").cast("string")), F.concat(F.lit('"n, '), F.col("user_id").cast("string"), F.lit('"'))

    def line(left, cells, right):
        return F.when(odd, F.concat_ws(",", *cells, *left, *right)).otherwise(F.concat_ws(",", *left, *right, *cells))

    heads = columns.select("week", F.lit(None).cast("bigint").alias("user_id"), line([F.lit("EID")], [name], [F.lit("NAME")]).alias("value"))
    given = F.transform("days", lambda d: F.coalesce(F.try_element_at("cells", d), F.lit("")))
    body = people.join(columns, "week").select("week", "user_id", line([ids[0]], [given], [ids[1]]).alias("value"))
    path = scratch_path(t.spark, "weeks-csv")
    (
        heads.unionByName(body).repartition("week").sortWithinPartitions("week", F.col("user_id").asc_nulls_first()).drop("user_id")
        .write.partitionBy("week").text(path)
    )
    return path


@query(
    "sheets_of_periods",
    f"""
    WITH {USER_DAYS_SQL}, cells AS (SELECT *, date_trunc('week', day)::DATE AS week FROM user_days)
    SELECT 'U' || p.user_id AS "EID", 'n, ' || p.user_id AS "NAME", d.day AS date, c.value
    FROM (SELECT DISTINCT user_id, week FROM cells) p JOIN (SELECT DISTINCT week, day FROM cells) d USING (week)
    LEFT JOIN cells c ON c.user_id = p.user_id AND c.day = d.day
    """,
)
def sheets_of_periods(t: Tables) -> DataFrame:
    """All weeks' sheets in one scan, unpivoted by position."""
    long = sheets.read_sheets(t.spark, landed_weeks(t), ["EID", "NAME"])
    return long.select("EID", "NAME", dates.header_to_date("header").alias("date"), "value")


@query(
    "bucketed_fact",
    f"""
    WITH {USER_DAYS_SQL}, {dated_sql('feed', 'purchase', 'event_id AS ref')},
    roster AS (SELECT user_id, min(day) AS first_day, count(*) AS n_days FROM user_days GROUP BY user_id)
    SELECT user_id, day, value, first_day, n_days, {carry('ref')} AS ref
    FROM user_days JOIN roster USING (user_id) LEFT JOIN feed ON user_id = who AND day = eff
    """,
)
def bucketed_fact(t: Tables) -> DataFrame:
    """Fact, roster and events joined and filled forward; only writing the tables deals rows out."""
    run, days = uuid.uuid4().hex, user_days(t).select("user_id", "day", "value")
    roster = days.groupBy("user_id").agg(F.min("day").alias("first_day"), F.count(F.lit(1)).alias("n_days"))
    feed = EventFeed("ev", dated(t, "purchase"), "who", "eff", {"ref": "event_id"}, ["event_id"])
    events = event_table([feed]).select(F.col("__entity").alias("user_id"), F.col("__day").alias("day"), F.col("ev.ref").alias("ref"))
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df, order in (("fact", days, ["day"]), ("roster", roster, []), ("feed", events, ["day"])):
        bucketed.save_bucketed(df, f"{name}_{run}", scratch_path(t.spark, name), "user_id", order, buckets)
    spark = bucketed.colocated(t.spark)
    fact, people, feed_rows = (spark.table(f"{n}_{run}") for n in ("fact", "roster", "feed"))
    joined = fact.join(people, "user_id").join(feed_rows, ["user_id", "day"], "left")
    return DAY_LINE.fill_forward(joined, {"ref": "ref"})
