"""Aggregations, joins and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates
from shiftloom.operators import aggregates, checks, joins
from shiftloom.plans.roster import adjusted_hours as adjust
from shiftloom.queries.registry import USER_DAYS_SQL, Tables, query, user_days
from shiftloom.session import scratch_path

# -- joins ------------------------------------------------------------------------


@query(
    "left_join_composite",
    f"""
    WITH {USER_DAYS_SQL},
    errors AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1, 2)
    SELECT user_id, day, n, errors FROM user_days LEFT JOIN errors USING (user_id, day)
    """,
)
def left_join_composite(t: Tables) -> DataFrame:
    errors = (
        t.events.where(F.col("event_type") == "error")
        .groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("errors"))
    )
    return user_days(t).select("user_id", "day", "n").transform(joins.left_join(errors, ["user_id", "day"]))


@query("left_join_renamed", "SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders LEFT JOIN customer "
                            "ON o_custkey = c_custkey")
def left_join_renamed(t: Tables) -> DataFrame:
    named = t.customer.select("c_custkey", "c_name")
    return t.orders.select("o_orderkey", "o_custkey").transform(joins.left_join_on(named, {"o_custkey": "c_custkey"}))


@query("lookup_join", "SELECT c_custkey, c_nationkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def lookup_join(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_nationkey").transform(
        joins.lookup(t.nation, "c_nationkey", "n_nationkey", {"n_name": "nation"}, order=["n_name"])
    )


@query(
    "join_on_expr",
    """
    WITH shipped AS (SELECT l_orderkey, strftime(l_shipdate, '%m-%d-%Y') AS ship_txt, count(*) AS lines
      FROM lineitem GROUP BY 1, 2)
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, ship_txt, lines FROM orders
    LEFT JOIN shipped ON o_orderkey = l_orderkey
      AND strftime(o_orderdate, '%m-%Y') = left(ship_txt, 2) || '-' || right(ship_txt, 4)
    """,
)
def join_on_expr(t: Tables) -> DataFrame:
    """Equality of formatted texts: month of the order and month in the text of the shipment."""
    lines = t.lineitem.select("l_orderkey", dates.date_text("l_shipdate", "MM-dd-yyyy").alias("ship_txt"))
    shipped = lines.groupBy("l_orderkey", "ship_txt").agg(F.count(F.lit(1)).alias("lines"))
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    month = {"o_orderkey": "l_orderkey", "date_format(day, 'MM-yyyy')": "concat(left(ship_txt, 2), '-', right(ship_txt, 4))"}
    return orders.transform(joins.left_join_expr(shipped, month)).select("o_orderkey", "day", "ship_txt", "lines")


@query(
    "agg_join_back",
    """
    WITH totals AS (SELECT user_id, count(*) AS user_events, round(sum(value), 2) AS user_value FROM events GROUP BY user_id)
    SELECT event_id, user_id, user_events, user_value FROM events LEFT JOIN totals USING (user_id)
    """,
)
def agg_join_back(t: Tables) -> DataFrame:
    totals = {"user_events": F.count(F.lit(1)), "user_value": F.round(F.sum("value"), 2)}
    return t.events.select("event_id", "user_id", "value").transform(joins.join_back(["user_id"], totals)).drop("value")


@query(
    "semi_join_flag",
    "SELECT c_custkey, CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000) AS INTEGER) AS big "
    "FROM customer",
)
def semi_join_flag(t: Tables) -> DataFrame:
    big = t.orders.where(F.col("o_totalprice") > 480000)
    return t.customer.select("c_custkey").transform(joins.member_flag(big, "c_custkey", "o_custkey", "big"))


@query(
    "late_fallback",
    f"""
    WITH {USER_DAYS_SQL},
    feed AS (SELECT user_id AS u, CAST(ts AS DATE) AS d, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT user_id, day, coalesce(CASE WHEN kind <> 'error' THEN hours END, v) AS hours
    FROM user_days LEFT JOIN feed ON user_id = u AND day = d
    """,
)
def late_fallback(t: Tables) -> DataFrame:
    feed = (
        t.events.where(F.col("event_type") == "purchase")
        .groupBy(F.col("user_id").alias("u"), F.col("ts").cast("date").alias("d")).agg(F.max("value").alias("v"))
    )
    rows = user_days(t).select("user_id", "day", F.when(F.col("kind") != "error", F.col("hours")).alias("hours"))
    return rows.transform(joins.late_fallback(feed, {"user_id": "u", "day": "d"}, {"hours": "v"}))


# -- aggregations -------------------------------------------------------------------


@query(
    "group_sum",
    "SELECT user_id, coalesce(sum(CASE WHEN event_type = 'error' THEN event_id END), 0)::BIGINT AS errors, "
    "sum(event_id)::BIGINT AS ids FROM events WHERE event_type <> 'view' GROUP BY user_id",
)
def group_sum(t: Tables) -> DataFrame:
    rows = t.events.select(
        "user_id", "event_type", F.when(F.col("event_type") == "error", F.col("event_id")).alias("errors"), F.col("event_id").alias("ids")
    )
    return rows.transform(aggregates.group_sum(["user_id"], ["errors", "ids"], where=F.col("event_type") != "view"))


@query(
    "adjusted_hours",
    """
    WITH extract AS (
      SELECT event_id AS ingest_seq, user_id, CAST(ts AS DATE) AS day, nullif(event_id % 3, 0) AS hc,
        event_id % 4 AS srtf_date, CASE WHEN event_id % 5 > 0 THEN round(value, 2) END AS hours, 7.5 AS ts_hours FROM events),
    adj AS (SELECT user_id, day, coalesce(round(sum(hours), 2), 0) AS adj FROM extract
      WHERE hc IS DISTINCT FROM 1 GROUP BY 1, 2),
    first_rows AS (SELECT * FROM extract
      QUALIFY row_number() OVER (PARTITION BY user_id, day, srtf_date ORDER BY ingest_seq) = 1)
    SELECT ingest_seq, user_id, day, srtf_date,
      round(coalesce(nullif(coalesce(adj, hours), 0), ts_hours), 2) AS hours
    FROM first_rows LEFT JOIN adj USING (user_id, day)
    """,
)
def adjusted_hours(t: Tables) -> DataFrame:
    extract = t.events.select(
        F.col("event_id").alias("ingest_seq"), "user_id", F.col("ts").cast("date").alias("day"),
        F.nullif(F.col("event_id") % 3, F.lit(0)).alias("hc"), (F.col("event_id") % 4).alias("srtf_date"),
        F.when(F.col("event_id") % 5 > 0, F.round("value", 2)).alias("hours"), F.lit(7.5).alias("ts_hours"),
    )
    done = extract.transform(adjust(["user_id", "day"], measures={"hours": "ts_hours"}))
    return done.select("ingest_seq", "user_id", "day", "srtf_date", F.round("hours", 2).alias("hours"))


@query("first_date_per_key", "SELECT user_id, min(CAST(ts AS DATE)) AS first_purchase FROM events "
                             "WHERE event_type = 'purchase' GROUP BY user_id")
def first_date_per_key(t: Tables) -> DataFrame:
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    return rows.transform(aggregates.first_date("user_id", "day", "first_purchase", F.col("event_type") == "purchase"))


@query(
    "distinct_then_group",
    "SELECT user_id, event_type, sum(minutes)::BIGINT AS minutes FROM (SELECT DISTINCT user_id, event_type, "
    "CAST(ts AS DATE) AS day, CAST(floor(value / 20) AS BIGINT) AS minutes FROM events) GROUP BY 1, 2",
)
def distinct_then_group(t: Tables) -> DataFrame:
    rows = t.events.select(
        "user_id", "event_type", F.col("ts").cast("date").alias("day"), F.floor(F.col("value") / 20).alias("minutes")
    )
    return rows.transform(
        aggregates.distinct_then_group(["user_id", "event_type", "day", "minutes"], ["user_id", "event_type"], "minutes", "minutes")
    )


_SPENT = {"available": "view", "coaching": "click", "meal": "purchase", "break": "signup", "unavailable": "error"}


@query(
    "time_in_status",
    """
    WITH rows AS (SELECT DISTINCT CAST(ts AS DATE) AS reporting_ds, user_id AS actor_id, event_type AS status,
      CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS mins FROM events),
    sums AS (SELECT reporting_ds, actor_id, """
    + ", ".join(f"sum(CAST(mins AS DOUBLE)) FILTER (WHERE status = '{s}') AS \"{c}\"" for c, s in _SPENT.items())
    + """ FROM rows GROUP BY 1, 2)
    SELECT *, round((coalesce(available, 0.0) + coalesce(coaching, 0.0)) / 60, 2) AS ts_total_hours,
      round((coalesce(available, 0.0) + coalesce(coaching, 0.0) + coalesce(meal, 0.0) + coalesce("break", 0.0)) / 60, 2)
        AS ts_completed_time FROM sums
    """,
)
def time_in_status(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("ts").cast("date").alias("reporting_ds"), F.col("user_id").alias("actor_id"),
        F.col("event_type").alias("status"), F.floor(F.col("value") / 10).cast("string").alias("mins"),
    )
    return rows.transform(
        aggregates.time_in_status(
            "reporting_ds", "actor_id", "status", "mins", statuses=_SPENT,
            total_parts=["available", "coaching"], completed_parts=["available", "coaching", "meal", "break"],
        )
    )


# -- checks ---------------------------------------------------------------------------


@query("dup_check", "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS size FROM orders "
                    "GROUP BY 1, 2 HAVING count(*) <> 1")
def dup_check(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows.transform(checks.duplicate_keys(["o_custkey", "day"]))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(t: Tables) -> DataFrame:
    return t.orders.transform(checks.distinct_values("o_orderpriority"))


@query(
    "exit_check",
    """
    SELECT DISTINCT c_name AS "EID" FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING'
      AND c_name NOT IN ('Customer#000000010', 'Customer#000000100')
    """,
)
def exit_check(t: Tables) -> DataFrame:
    people = t.customer.select("c_custkey", F.col("c_name").alias("EID"), "c_mktsegment")
    fact = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "EID",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Analyst")).alias("ROLE"),
        F.when(F.col("o_orderstatus") == "F", F.lit("-")).alias("value"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Work")).alias("rta_status"),
    )
    return fact.transform(checks.exit_check(["Customer#000000010", "Customer#000000100"]))


@query(
    "write_report",
    f"""
    WITH {USER_DAYS_SQL}
    SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM user_days
    UNION ALL SELECT 'keyless', NULL, count(*) FILTER (WHERE user_id IS NULL OR day IS NULL) FROM user_days
    UNION ALL SELECT 'long days', NULL, count(*) FILTER (WHERE hours > 100) FROM user_days
    UNION ALL SELECT 'kind', kind, count(*) FROM user_days GROUP BY kind
    """,
)
def write_report(t: Tables) -> DataFrame:
    """Checks taken while the days are written; nothing reads them again."""
    watch = checks.Watch(["user_id", "day"], {"long days": F.col("hours") > 100}, ["kind"])
    watch.over(user_days(t)).write.parquet(scratch_path(t.spark, "watched"))
    counts = [("rows", None, watch.rows), ("keyless", None, watch.keyless), ("long days", None, watch.count("long days"))]
    kinds = [("kind", kind, n) for kind, n in watch.values("kind").items()]
    return t.spark.createDataFrame(counts + kinds, "metric string, item string, n long")
