"""Effective-dated overlays on the (user, day) fact; events of one kind are the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates
from shiftloom.operators import overlays
from shiftloom.operators.overlays import EventFeed
from shiftloom.operators.timeline import keep_first
from shiftloom.plans import schedule as S
from shiftloom.queries.registry import DAY_LINE, RUN_DATE, USER_DAYS_SQL, Tables, query, user_days

_CARRY = "last_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def carry(c: str) -> str:
    return _CARRY.format(c=c)


def dated(t: Tables, kind: str) -> DataFrame:
    """Events of one kind with their day."""
    return t.events.where(F.col("event_type") == kind).select(
        "event_id", F.col("user_id").alias("who"), F.col("ts").cast("date").alias("eff"), "value"
    )


def dated_sql(name: str, kind: str, cols: str, where: str = "TRUE") -> str:
    """First event of a kind per (user, day)."""
    return (
        f"{name} AS (SELECT user_id AS who, CAST(ts AS DATE) AS eff, {cols} FROM events "
        f"WHERE event_type = '{kind}' AND {where} "
        "QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) = 1)"
    )


_CROSS_UNIT = "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'CUSTOMER_SUPPORT' ELSE 'COMMUNITY_OPS' END"
_CROSS_FLOW = "CASE event_id % 3 WHEN 0 THEN 'OBJECTS/IGPR' WHEN 1 THEN 'MESSENGER' ELSE 'GTM' END"
_CROSS_SEED = dated_sql("feed", "purchase", f"CAST(ts AS DATE) AS x_eff, {_CROSS_UNIT} AS x_unit, {_CROSS_FLOW} AS x_flow")


def cross_feed(t: Tables) -> EventFeed:
    trainings = dated(t, "purchase").select(
        "who", "eff", "event_id", F.expr(_CROSS_UNIT).alias("x_unit"), F.expr(_CROSS_FLOW).alias("x_flow")
    )
    return EventFeed("ev", trainings, "who", "eff", {"x_eff": "eff", "x_unit": "x_unit", "x_flow": "x_flow"}, ["event_id"])


@query(
    "effective_overlay",
    f"""
    WITH {USER_DAYS_SQL}, {_CROSS_SEED},
    carried AS (SELECT user_id, day, kind, value, {carry('x_eff')} AS x_eff, {carry('x_unit')} AS x_unit, {carry('x_flow')} AS x_flow
      FROM user_days LEFT JOIN feed ON user_id = who AND day = eff),
    due AS (SELECT *, day >= x_eff AND x_eff > DATE '2024-01-13' AS due FROM carried)
    SELECT user_id, day, CASE WHEN due THEN x_unit ELSE kind END AS unit,
      replace(replace(CASE WHEN due THEN x_flow ELSE value END, 'OBJECTS/IGPR', 'Objects/IGPR'), 'MESSENGER', 'Messenger') AS flow
    FROM due
    """,
)
def effective_overlay(t: Tables) -> DataFrame:
    fact = user_days(t).select("user_id", "day", F.col("kind").alias("unit"), F.col("value").alias("flow"))
    carried = fact.transform(overlays.effective_overlay(DAY_LINE, [cross_feed(t)], "user_id", "day"))
    return carried.transform(
        S.apply_cross_skill("unit", "flow", "day", "x_eff", "x_unit", "x_flow", RUN_DATE)
    ).drop("x_eff", "x_unit", "x_flow")


@query(
    "effective_overlay_asof",
    f"""
    WITH {USER_DAYS_SQL}, {dated_sql('feed', 'purchase', 'event_id AS ref')},
    work AS (SELECT user_id, day FROM user_days WHERE kind <> 'purchase')
    SELECT user_id, day, (SELECT max_by(ref, eff) FROM feed WHERE who = user_id AND eff <= day) AS ref FROM work
    """,
)
def effective_overlay_asof(t: Tables) -> DataFrame:
    """Events on days the fact lacks count as well."""
    fact = user_days(t).where(F.col("kind") != "purchase").select("user_id", "day")
    feed = EventFeed("ev", dated(t, "purchase"), "who", "eff", {"ref": "event_id"}, ["event_id"])
    return fact.transform(overlays.effective_overlay(DAY_LINE, [feed], "user_id", "day", carry_in=True))


@query(
    "interval_overlay",
    f"""
    WITH {USER_DAYS_SQL},
    {dated_sql('feed', 'signup', 'CAST(ts AS DATE) AS lo, CAST(ts AS DATE) + CAST(event_id % 6 AS INTEGER) AS hi')},
    carried AS (SELECT user_id, day, value, {carry('lo')} AS lo, {carry('hi')} AS hi
      FROM user_days LEFT JOIN feed ON user_id = who AND day = eff)
    SELECT user_id, day, value, CASE WHEN day BETWEEN lo AND hi AND value NOT IN ('L1', 'L2') THEN 1 END AS abs_fcst FROM carried
    """,
)
def interval_overlay(t: Tables) -> DataFrame:
    leaves = dated(t, "signup").withColumn("hi", F.date_add("eff", (F.col("event_id") % 6).cast("int")))
    feed = EventFeed("ev", leaves, "who", "eff", {"lo": "eff", "hi": "hi"}, ["event_id"])
    fact = user_days(t).select("user_id", "day", "value")
    return fact.transform(
        overlays.interval_overlay(
            DAY_LINE, feed, "user_id", "day", "lo", "hi", "abs_fcst", unless=F.col("value").isin("L1", "L2")
        )
    )


@query(
    "forecast_overlay",
    f"""
    WITH {USER_DAYS_SQL},
    {dated_sql('absences', 'signup', 'CAST(ts AS DATE) AS a_lo, CAST(ts AS DATE) + 2 AS a_hi')},
    {dated_sql('leaves', 'view', 'CAST(ts AS DATE) AS l_lo, CAST(ts AS DATE) + 4 AS l_hi')},
    {dated_sql('leavers', 'error', 'CAST(ts AS DATE) AS gone')},
    {dated_sql('moves', 'click', "CAST(ts AS DATE) AS mv_eff, 'Market ' || event_id % 3 AS mv_market")},
    carried AS (SELECT user_id, day, CASE WHEN n = 1 THEN '-' ELSE value END AS value, kind,
        {', '.join(f'{carry(c)} AS {c}' for c in ('a_lo', 'a_hi', 'l_lo', 'l_hi', 'gone', 'mv_eff', 'mv_market'))}
      FROM user_days
      LEFT JOIN absences a ON user_id = a.who AND day = a.eff LEFT JOIN leaves l ON user_id = l.who AND day = l.eff
      LEFT JOIN leavers g ON user_id = g.who AND day = g.eff LEFT JOIN moves m ON user_id = m.who AND day = m.eff)
    SELECT user_id, day, value,
      CASE WHEN (day BETWEEN a_lo AND a_hi OR day BETWEEN l_lo AND l_hi) AND value NOT IN ('L1', 'L2') THEN 1
           WHEN day > gone AND value <> '-' THEN 1 END AS abs_fcst,
      CASE WHEN day >= mv_eff THEN mv_market ELSE kind END AS market FROM carried
    """,
)
def forecast_overlay(t: Tables) -> DataFrame:
    order = ["event_id"]
    absences = dated(t, "signup").withColumn("hi", F.date_add("eff", 2))
    leaves = dated(t, "view").withColumn("hi", F.date_add("eff", 4))
    moves = dated(t, "click").withColumn(
        "to", F.concat(F.lit("Market "), (F.col("event_id") % 3).cast("string"))
    )
    feeds = [
        EventFeed("ev_abs", absences, "who", "eff", {"a_lo": "eff", "a_hi": "hi"}, order),
        EventFeed("ev_loa", leaves, "who", "eff", {"l_lo": "eff", "l_hi": "hi"}, order),
        EventFeed("ev_attr", dated(t, "error"), "who", "eff", {"gone": "eff"}, order),
        EventFeed("ev_move", moves, "who", "eff", {"mv_eff": "eff", "mv_market": "to"}, order),
    ]
    fact = user_days(t).select(
        "user_id", "day", F.when(F.col("n") == 1, F.lit("-")).otherwise(F.col("value")).alias("value"),
        F.col("kind").alias("market"),
    )
    carried = fact.transform(overlays.effective_overlay(DAY_LINE, feeds, "user_id", "day"))
    return (
        carried.transform(S.apply_forecasts("abs_fcst", "value", "day", [("a_lo", "a_hi"), ("l_lo", "l_hi")], "gone"))
        .transform(overlays.from_date_on("day", "mv_eff", "market", "mv_market"))
        .select("user_id", "day", "value", "abs_fcst", "market")
    )


@query(
    "exit_overlay",
    f"""
    WITH {USER_DAYS_SQL},
    exits AS (SELECT * FROM (SELECT user_id AS who, CAST(ts AS DATE) AS eff FROM events WHERE event_type = 'error'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE eff > DATE '2024-01-13'),
    {dated_sql('early', 'view', 'CAST(ts AS DATE) AS gone', "CAST(ts AS DATE) > DATE '2024-01-13'")},
    carried AS (SELECT user_id, day, value, CASE WHEN user_id % 5 = 0 THEN 45300 WHEN user_id % 5 = 1 THEN NULL ELSE 0 END AS off,
        {carry('x.eff')} AS ended, {carry('gone')} AS gone
      FROM user_days LEFT JOIN exits x ON user_id = x.who AND day = x.eff LEFT JOIN early e ON user_id = e.who AND day = e.eff),
    first_pass AS (SELECT user_id, day, gone,
      CASE WHEN day > ended AND coalesce(off, 0) = 0 THEN '-' ELSE value END AS value,
      CASE WHEN day = ended AND coalesce(off, 0) = 0 THEN 'roll_off' END AS mark FROM carried)
    SELECT user_id, day, CASE WHEN day > gone THEN '-' ELSE value END AS value,
      CASE WHEN day = gone THEN 'roll_off' ELSE mark END AS mark FROM first_pass
    """,
)
def exit_overlay(t: Tables) -> DataFrame:
    exits = (
        dated(t, "error")
        .transform(keep_first(["who"], [F.col("event_id").desc()]))
        .where(dates.after_horizon("eff", RUN_DATE, 2))
    )
    early = dated(t, "view").where(dates.after_horizon("eff", RUN_DATE, 2))
    feeds = [
        EventFeed("ev_exit", exits, "who", "eff", {"ended": "eff"}),
        EventFeed("ev_early", early, "who", "eff", {"gone": "eff"}, ["event_id"]),
    ]
    user = F.col("user_id")
    fact = user_days(t).select(
        "user_id", "day", "value", F.lit(None).cast("string").alias("mark"),
        F.when(user % 5 == 0, F.lit(45300)).when(user % 5 != 1, F.lit(0)).alias("off"),
    )
    return (
        fact.transform(overlays.effective_overlay(DAY_LINE, feeds, "user_id", "day"))
        .transform(S.apply_exit("value", "mark", "day", "ended", "off"))
        .transform(S.apply_exit("value", "mark", "day", "gone"))
        .select("user_id", "day", "value", "mark")
    )


@query(
    "changelog_overlay",
    f"""
    WITH {USER_DAYS_SQL},
    {dated_sql('units', 'click', "CAST(ts AS DATE) AS u_eff, CASE event_id % 3 WHEN 0 THEN 'LERT' WHEN 1 THEN 'COMMUNITY_OPS' ELSE 'CUSTOMER_SUPPORT' END AS u_new", "CAST(ts AS DATE) >= DATE '2024-01-08'")},
    {dated_sql('flows', 'view', "CAST(ts AS DATE) AS f_eff, CASE event_id % 4 WHEN 0 THEN 'LERT' WHEN 1 THEN 'Policy' WHEN 2 THEN 'GTM' ELSE 'IDVAAS' END AS f_new", "CAST(ts AS DATE) >= DATE '2024-01-08'")},
    carried AS (SELECT user_id, day, kind,
        {', '.join(f'{carry(c)} AS {c}' for c in ('u_eff', 'u_new', 'f_eff', 'f_new'))},
        count(f_eff) OVER (PARTITION BY user_id) > 0 AS changed
      FROM user_days LEFT JOIN units u ON user_id = u.who AND day = u.eff LEFT JOIN flows f ON user_id = f.who AND day = f.eff),
    applied AS (SELECT user_id, day, changed, 'CO - Start' AS lob,
      CASE WHEN day >= u_eff THEN u_new ELSE 'COMMUNITY_OPS' END AS unit,
      CASE WHEN day >= f_eff THEN f_new WHEN kind = 'error' THEN 'Training' ELSE 'Messenger' END AS flow FROM carried),
    lobs AS (SELECT user_id, day, changed, unit, flow, CASE WHEN unit = 'LERT' AND flow = 'LERT' THEN 'LERT'
      WHEN unit = 'CUSTOMER_SUPPORT' THEN 'CO - Customer Support'
      WHEN unit = 'COMMUNITY_OPS' AND flow = 'Messenger' THEN 'CO - Content Moderation'
      WHEN unit = 'COMMUNITY_OPS' AND flow = 'GTM' THEN 'CO - GTM'
      WHEN unit = 'COMMUNITY_OPS' AND flow = 'IDVAAS' THEN 'CO - Graph Integrity' ELSE lob END AS lob FROM applied),
    settled AS (SELECT user_id, day, changed, unit, lob,
      CASE WHEN lob = 'CO - Customer Support' THEN 'IDVAAS' ELSE flow END AS flow FROM lobs)
    SELECT user_id, day, unit, flow,
      CASE WHEN flow IN ('Policy', 'Training') AND changed THEN 'CO - PTQ' ELSE lob END AS lob FROM settled
    """,
)
def changelog_overlay(t: Tables) -> DataFrame:
    def log(kind: str, new: str) -> DataFrame:
        rows = dated(t, kind).where(dates.after_horizon("eff", RUN_DATE, 7, inclusive=True))
        return rows.withColumn("new", F.expr(new))

    units = log("click", "CASE event_id % 3 WHEN 0 THEN 'LERT' WHEN 1 THEN 'COMMUNITY_OPS' ELSE 'CUSTOMER_SUPPORT' END")
    flows = log("view", "CASE event_id % 4 WHEN 0 THEN 'LERT' WHEN 1 THEN 'Policy' WHEN 2 THEN 'GTM' ELSE 'IDVAAS' END")
    feeds = [
        EventFeed("ev_unit", units, "who", "eff", {"u_eff": "eff", "u_new": "new"}, ["event_id"]),
        EventFeed("ev_flow", flows, "who", "eff", {"f_eff": "eff", "f_new": "new"}, ["event_id"]),
    ]
    fact = user_days(t).select(
        "user_id", "day", F.lit("COMMUNITY_OPS").alias("unit"), F.lit("CO - Start").alias("lob"),
        F.when(F.col("kind") == "error", F.lit("Training")).otherwise(F.lit("Messenger")).alias("flow"),
    )
    attached = fact.transform(overlays.attach_events(feeds, "user_id", "day"))
    carried = DAY_LINE.fill_forward(attached, {o: c for f in feeds for o, c in overlays.payload_of(f).items()})
    carried = DAY_LINE.first_where(carried, {"changed": (F.col("ev_flow").isNotNull(), "day")})
    return (
        carried.transform(overlays.from_date_on("day", "u_eff", "unit", "u_new"))
        .transform(overlays.from_date_on("day", "f_eff", "flow", "f_new"))
        .transform(S.settle_lob("unit", "flow", "lob", F.col("changed").isNotNull()))
        .select("user_id", "day", "unit", "flow", "lob")
    )


@query(
    "roll_off_status",
    f"""
    WITH {USER_DAYS_SQL},
    people AS (SELECT user_id, day, CASE WHEN user_id % 4 = 0 THEN DATE '1900-01-01'
        ELSE DATE '2024-01-10' + CAST(user_id % 15 AS INTEGER) END AS roll_off,
      CASE WHEN user_id % 3 = 0 THEN 'Active' WHEN user_id % 3 = 1 THEN 'On Leave' END AS status FROM user_days)
    SELECT user_id, day, roll_off, CASE WHEN coalesce(status, 'Active') = 'Active' AND day > roll_off
        AND roll_off <> DATE '1900-01-01' THEN 'Rolled-Off' ELSE status END AS status,
      CASE WHEN day = roll_off THEN 'roll_off' END AS mark FROM people
    """,
)
def roll_off_status(t: Tables) -> DataFrame:
    user = F.col("user_id")
    serial = F.when(user % 4 == 0, F.lit(0)).otherwise(F.lit(45301) + (user % 15))
    people = user_days(t).select(
        "user_id", "day", dates.serial_or_sentinel(serial).alias("roll_off"),
        F.when(user % 3 == 0, F.lit("Active")).when(user % 3 == 1, F.lit("On Leave")).alias("status"),
        F.lit(None).cast("string").alias("mark"),
    )
    return people.transform(S.roll_off_status("status", "day", "roll_off", "mark"))
