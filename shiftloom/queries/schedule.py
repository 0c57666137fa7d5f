"""Schedule rules and the whole schedule fact, on a sheet of users by days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules
from shiftloom.operators.joins import join_back
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule as S
from shiftloom.plans import schedule_fact as SF
from shiftloom.queries.overlays import carry, dated_sql
from shiftloom.queries.registry import DAY_LINE, RUN_DATE, USER_DAYS_SQL, Tables, query, user_days, week_sql
from shiftloom.session import scratch_path

# -- single rules -----------------------------------------------------------------


@query(
    "absence_flag",
    f"""
    WITH {USER_DAYS_SQL}, f AS (SELECT user_id, day, CAST(kind IN ('click', 'signup') AS INTEGER) AS wd,
      CAST(kind <> 'click' AS INTEGER) AS sched, CASE WHEN n < 3 THEN 'Abs' WHEN n < 5 THEN 'Work' END AS rta,
      CASE WHEN hours > 40 THEN hours / 100 END AS hrs, CASE WHEN user_id % 4 = 0 THEN 1 END AS fcst,
      CASE WHEN n % 2 = 0 THEN 'here' END AS att FROM user_days)
    SELECT user_id, day,
      CAST(coalesce(wd = 1 AND rta = 'Abs' AND (hrs < 1 OR hrs IS NULL), FALSE) OR coalesce(fcst = 1 AND att IS NULL, FALSE) AS INTEGER) AS abs_main,
      CAST(coalesce(wd = 1 AND rta = 'Abs', FALSE) OR coalesce(fcst = 1 AND att IS NULL, FALSE) AS INTEGER) AS abs_wfh,
      CAST(coalesce(wd = 1 AND rta = 'Abs' AND (hrs < 1 OR hrs IS NULL), FALSE) AS INTEGER) AS abs_2022,
      CAST((wd = 1 AND sched < 1) OR coalesce(fcst = 1, FALSE) AS INTEGER) AS abs_2024 FROM f
    """,
)
def absence_flag(t: Tables) -> DataFrame:
    kind, n = F.col("kind"), F.col("n")
    rows = user_days(t).select(
        "user_id", "day", rules.flag(kind.isin("click", "signup")).alias("WD"), rules.flag(kind != "click").alias("Schedule"),
        F.when(n < 3, F.lit("Abs")).when(n < 5, F.lit("Work")).alias("rta_status"),
        F.when(F.col("hours") > 40, F.col("hours") / 100).alias("srtf_total_hrs"),
        F.when(F.col("user_id") % 4 == 0, F.lit(1)).alias("ABS_FCST"), F.when(n % 2 == 0, F.lit("here")).alias("iw_attendance_status"),
    )
    return rows.select("user_id", "day", *[S.absence_flag(m).alias(f"abs_{m}") for m in S.ABSENCE_MODES])


@query(
    "tenure_class",
    f"""
    WITH {USER_DAYS_SQL}, p AS (SELECT user_id, day, CASE WHEN user_id % 3 > 0 THEN DATE '2024-01-05' + CAST(user_id % 9 AS INTEGER) END AS dep,
      CASE WHEN user_id % 3 = 1 THEN DATE '2024-01-15' + CAST(user_id % 7 AS INTEGER) END AS grad,
      CASE WHEN user_id % 2 = 0 THEN 44000 ELSE 45280 + CAST(user_id % 11 AS INTEGER) END AS rin, CASE WHEN n < 4 THEN 'Active' END AS status FROM user_days),
    c AS (SELECT user_id, day, CASE WHEN day < dep THEN 'Trainee' WHEN day >= dep AND day < grad THEN 'DMR' WHEN day >= grad THEN 'Tenured'
      WHEN dep IS NULL AND rin < 44927 THEN 'Tenured'
      WHEN dep IS NULL AND status = 'Active' AND day > DATE '1899-12-30' + rin + 19 THEN 'Tenured'
      WHEN dep IS NULL AND status = 'Active' AND day <= DATE '1899-12-30' + rin + 19 THEN 'Trainee' END AS tenure FROM p)
    SELECT user_id, day, {carry('tenure')} AS tenure FROM c
    """,
)
def tenure_class(t: Tables) -> DataFrame:
    user = F.col("user_id")
    people = user_days(t).select(
        "user_id", "day",
        F.when(user % 3 > 0, F.date_add(F.lit("2024-01-05").cast("date"), (user % 9).cast("int"))).alias("dep"),
        F.when(user % 3 == 1, F.date_add(F.lit("2024-01-15").cast("date"), (user % 7).cast("int"))).alias("grad"),
        F.when(user % 2 == 0, F.lit(44000)).otherwise(F.lit(45280) + user % 11).alias("rin"),
        F.when(F.col("n") < 4, F.lit("Active")).alias("status"),
    )
    classed = people.withColumn("tenure", S.tenure_class("day", "dep", "grad", "rin", "status"))
    return DAY_LINE.fill_forward(classed, {"tenure": "tenure"}).select("user_id", "day", "tenure")


def coefficient_sql(total: str, days: str, mark: str, sched: str, leave: str, friday: str) -> str:
    return f"""CASE WHEN {total} = 7 AND {days} = 6 THEN 5.0::DOUBLE / 7
      WHEN {total} = 7 AND {mark} = 1 AND ({sched} = 1 OR {friday}) AND {days} <= 4 THEN 1.0
      WHEN {total} = 7 AND {mark} IS NULL AND {sched} = 1 AND {days} = 5 THEN 1.0
      WHEN {total} = 7 AND {mark} IS NULL AND ({sched} = 1 OR {leave} = 1) AND {days} IN (3, 4) THEN 5.0::DOUBLE / 7
      WHEN {total} < 7 AND {sched} = 1 THEN 1.0 ELSE 0.0 END"""


@query(
    "weekly_coefficient",
    f"""
    WITH rows AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, {week_sql('CAST(ts AS DATE)')} AS week,
      CASE WHEN row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS f, event_type FROM events),
    cells AS (SELECT event_id, user_id, day, week, CASE WHEN f = 1 AND event_type <> 'error' THEN 1 ELSE 0 END AS s,
      CASE WHEN f = 1 AND event_type = 'error' THEN 1 ELSE 0 END AS l FROM rows),
    daily AS (SELECT user_id, week, day, sum(s) AS s, sum(l) AS l FROM cells GROUP BY 1, 2, 3),
    weeks AS (SELECT *, sum(s) OVER w AS d, sum(s + l) OVER w AS t FROM daily WINDOW w AS (PARTITION BY user_id, week)),
    marked AS (SELECT *, max(CASE WHEN dayofweek(day) = 5 AND l = 1 AND d = 4 THEN 1 END) OVER (PARTITION BY user_id, week) AS m FROM weeks)
    SELECT event_id, user_id, day, {coefficient_sql('t', 'd', 'm', 'marked.s', 'marked.l', 'dayofweek(day) = 5')} AS wsc
    FROM cells JOIN marked USING (user_id, day)
    """,
)
def weekly_coefficient(t: Tables) -> DataFrame:
    """On raw events: the first event of a day decides whether it counts as work or leave."""
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type")
    marked = rows.transform(join_back(["user_id", "day"], {"first_id": F.min("event_id")}))
    marked = marked.withColumn("week", dates.week_ending_friday("day"))
    first, leave = F.col("event_id") == F.col("first_id"), F.col("event_type") == "error"
    cells = marked.withColumns({"s": rules.flag(first & ~leave), "l": rules.flag(first & leave)})
    weighed = cells.transform(S.weekly_coefficient("user_id", "week", "day", "s", "l", out="wsc"))
    return weighed.select("event_id", "user_id", "day", "wsc")


# -- the sheet --------------------------------------------------------------------


def landed_sheet(t: Tables) -> DataFrame:
    """A wide schedule sheet, a row per user and a column per day, as it would be landed.

    The driver learns the day headers, nothing else; they are bounded by the calendar.
    """
    days = user_days(t).select("user_id", F.datediff("day", F.lit(dates.SERIAL_EPOCH)).cast("string").alias("serial"), "value")
    headers = sorted(r["serial"] for r in days.select("serial").distinct().toLocalIterator())
    wide = days.groupBy("user_id").pivot("serial", headers).agg(F.first("value"))
    user = F.col("user_id")
    text = user.cast("string")
    sheet = wide.select(
        F.concat(F.lit("U"), text).alias("EID"), F.lit("Analyst").alias("ROLE"),
        F.when(user % 50 == 7, F.lit(R.ERROR_MARKER)).otherwise(F.concat(F.lit("n"), text)).alias("NAME"),
        F.concat(text, F.lit(".0")).alias("SRT ID"), (user % 4).alias("WAVE"), F.lit("Active").alias("STATUS"),
        F.lit(44000).alias("ROLL IN DATE"),
        F.when(user % 5 == 0, F.lit(45310) + (user % 7).cast("int")).otherwise(F.lit(0)).alias("ROLL OFF DATE"),
        *[F.lit("x").alias(c) for c in ("SUPERVISOR CURRENT", "OPS", "MARKET", "Flow Skills", "SLOB", "LOB", "SupportRole", "SAP ID", "SHIFT BLOCK")],
        *[F.col(h) for h in headers], F.lit(0).alias("WW01"), F.lit("total").alias("WD"),
    )
    path = scratch_path(t.spark, "sheet")
    sheet.write.parquet(path)
    return t.spark.read.parquet(path)


def code_sheet(t: Tables) -> DataFrame:
    """The codes in use, under the sheet name that counts."""
    return user_days(t).select(F.lit("MF").alias("indice"), F.col("value").alias("code"), F.lit("").alias("description")).distinct()


_GRID_SQL = f"""
    {USER_DAYS_SQL},
    days AS (SELECT DISTINCT day AS date FROM user_days),
    people AS (SELECT DISTINCT user_id FROM user_days WHERE user_id % 50 <> 7),
    grid AS (SELECT p.user_id, 'u' || p.user_id AS eid, d.date, {week_sql('d.date')} AS week_ending, coalesce(u.value, '-') AS value
      FROM people p CROSS JOIN days d LEFT JOIN user_days u ON u.user_id = p.user_id AND u.day = d.date)"""
_FLAGS_SQL = """CAST(value NOT IN ('L1', 'L2', '-') AS INTEGER) AS "Schedule", CAST(value IN ('M', 'E') AS INTEGER) AS "WD",
      0 AS "LOA", CAST(value = 'V' AS INTEGER) AS "PTO", CAST(value IN ('L1', 'L2') AS INTEGER) AS "Leave\""""
_WSC_SQL = """weeks AS (SELECT *, sum("Schedule") OVER w AS d, sum("Schedule" + "Leave") OVER w AS t FROM {source}
      WINDOW w AS (PARTITION BY user_id, week_ending)),
    marked AS (SELECT *, max(CASE WHEN dayofweek(date) = 5 AND "Leave" = 1 AND d = 4 THEN 1 END) OVER (PARTITION BY user_id, week_ending) AS m FROM weeks)"""
_WSC = coefficient_sql("t", "d", "m", '"Schedule"', '"Leave"', "dayofweek(date) = 5")
_SHIFT_SQL = "CASE value WHEN 'E' THEN 'Evening' WHEN 'M' THEN 'Morning' ELSE '-' END"


@query(
    "weekly_schedule",
    f"""
    WITH {_GRID_SQL}, flags AS (SELECT *, {_FLAGS_SQL} FROM grid), {_WSC_SQL.format(source='flags')}
    SELECT eid AS "EID", date, week_ending, value, "Schedule", "WD", "LOA", "PTO", "Leave", {_WSC} AS "WSC", {_SHIFT_SQL} AS shift FROM marked
    """,
)
def weekly_schedule(t: Tables) -> DataFrame:
    """Sheet to long fact with flags, weekly coefficient and shift: the least whole job."""
    long = SF.unpivot_sheet(landed_sheet(t), noise=["WD"])
    long = long.withColumn("value", F.coalesce(F.col("value"), F.lit(R.NO_SHIFT)))
    fact = long.transform(S.schedule_flags(code_sheet(t).transform(S.classify_codes())))
    fact = fact.transform(S.weekly_coefficient_in_place(SF.LINE.keys)).withColumn("shift", S.shift_bucket("value"))
    return fact.select("EID", "date", "week_ending", "value", "Schedule", "WD", "LOA", "PTO", "Leave", "WSC", "shift")


# -- the whole fact ------------------------------------------------------------------

# Roster of a user on the days that do not start with a view: every column has gaps.
_ROSTER = {
    "workflow": "CASE kind WHEN 'click' THEN 'CO - Customer Support' WHEN 'error' THEN 'CO - GTM' WHEN 'purchase' THEN 'Non-Rec' ELSE 'CO - Start' END",
    "current_workflow": "CASE n WHEN 1 THEN 'Messenger' WHEN 2 THEN 'GTM' WHEN 3 THEN NULL ELSE 'IDVAAS' END",
    "role": "CASE WHEN user_id % 3 = 0 THEN 'Trainee' WHEN hours > 120 THEN 'Team Lead' ELSE 'Analyst' END",
    "employee_status": "CASE WHEN user_id % 4 > 0 THEN 'Active' END",
    "cluster": "CASE WHEN hours < 20 THEN 'pt' WHEN hours < 30 THEN 'GTM_ITALIAN' WHEN hours > 150 THEN 'PDO_VACCINE_HESITANCY' ELSE 'es' END",
    "team_lead": "CASE WHEN n > 1 THEN kind END",
    "ops_lead_eid": "kind",
    "skills": "CASE WHEN n <> 2 THEN value END",
    "billable": "CASE WHEN user_id % 2 = 0 THEN 'billable' ELSE 'non-billable' END",
    "iw_highlevel_status": "kind",
    "iw_attendance_status": "CASE WHEN n <> 2 THEN kind END",
    "status_final_AL": "CASE WHEN n > 1 THEN kind END",
    "rta_status": "CASE kind WHEN 'click' THEN 'Abs' WHEN 'purchase' THEN NULL ELSE 'Work' END",
    "rta_status_code": "CASE WHEN n > 2 THEN 'c1' END",
    "srtf_total_hrs": "CASE WHEN n > 1 THEN hours / 100 END",
    "srtf_completed_time": "hours",
    "iw_actual_time": "hours",
    "WH": "kind",
}
_CARRIED = ["workflow", "current_workflow", "role", "employee_status", "cluster", "team_lead", "ops_lead_eid", "skills", "billable"]
_OWN_DAY = [c for c in _ROSTER if c not in _CARRIED]
_TICKET_KIND = "CASE event_id % 4 WHEN 0 THEN 'Absenteeism' WHEN 1 THEN 'LOA' WHEN 2 THEN 'Managed Attrition' ELSE 'Movement' END"
_CH_PBU = "CASE event_id % 3 WHEN 0 THEN 'LERT' WHEN 1 THEN 'COMMUNITY_OPS' ELSE 'CUSTOMER_SUPPORT' END"
_CH_SLOB = "CASE event_id % 4 WHEN 0 THEN 'LERT' WHEN 1 THEN 'Policy' WHEN 2 THEN 'GTM' ELSE 'IDVAAS' END"
_X_UNIT = "CASE event_id % 3 WHEN 0 THEN 'CUSTOMER_SUPPORT' ELSE 'COMMUNITY_OPS' END"
_X_FLOW = "CASE event_id % 3 WHEN 0 THEN 'OBJECTS/IGPR' WHEN 1 THEN 'MESSENGER' ELSE 'MISREPRESENTATION' END"


def _inputs(t: Tables) -> SF.ScheduleInputs:
    who = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    day, kind, seq = F.col("ts").cast("date"), F.col("event_type"), F.col("event_id").alias("ingest_seq")
    ev = t.events

    def dated(k: str) -> DataFrame:
        return ev.where(kind == k)

    roster = user_days(t).where(F.col("kind") != "view").select(
        who.alias("enterprise_id"), F.col("day").alias("roster_date"), *[F.expr(sql).alias(c) for c, sql in _ROSTER.items()]
    )
    exits = dated("error").select(
        who.alias("Enterprise ID"), F.datediff(day, F.lit(dates.SERIAL_EPOCH)).cast("string").alias("Employment End Date"), seq
    )
    early = dated("view").select(who.alias("e_id"), day.alias("exit_date"), seq)
    cross = dated("purchase").select(
        F.expr(_X_UNIT).alias("Business Unit"), F.expr(_X_FLOW).alias("Training FLOW"), who.alias("EID"),
        F.date_sub(day, 1).alias("End date"), seq,
    )
    other = F.concat(F.lit("@"), F.rpad(F.lit("#"), 16, "."), F.lit("7#u"), (F.col("user_id") + 1).cast("string"))
    tickets = dated("signup").select(
        F.col("event_id").alias("ID"), F.concat(who, F.when(F.col("event_id") % 8 < 4, other).otherwise(F.lit(""))).alias("EID"),
        F.when(F.col("event_id") % 5 > 0, F.lit("Consider in Forecast")).otherwise(F.lit("Reject")).alias("Ticket decision"),
        F.expr(_TICKET_KIND).alias("Forecasted Change"), day.alias("Start Date"), F.date_add(day, 3).alias("End Date"),
        day.alias("Managed attrition DATE FORECASTED"), day.alias("Movement Effective Date"),
        F.when(F.col("event_id") % 3 > 0, F.lit("GTM")).alias("To Slob"),
        F.concat(F.lit("mk"), (F.col("event_id") % 2).cast("string")).alias("To Market"),
    )

    def change(k: str, name: str, new: str) -> DataFrame:
        return dated(k).select(who.alias("e_id"), F.lit(name).alias("Change_Type"), F.expr(new).alias("New"),
                                      day.alias("Effective_Date"), seq)

    log = change("click", "PBU", _CH_PBU).unionByName(change("view", "SLOB", _CH_SLOB))
    log = log.unionByName(change("signup", "Role", "'Coach'")).unionByName(change("error", "Market", "'GTM_ITALIAN'"))
    daily = user_days(t).where(F.col("kind") == "purchase").select(
        who.alias("User_Name_daily"), F.col("day").alias("Date_daily"), F.lit("daily").alias("status_final"),
        F.lit("Work").alias("status_daily"), F.lit("D1").alias("status_code_daily"),
    )
    return SF.ScheduleInputs(
        sheet=landed_sheet(t), codes=code_sheet(t), roster=roster, exits=exits, early_exits=early, tickets=tickets,
        cross_skilling=cross, change_log=log, daily=daily, noise=["WD"],
    )


def _ticket_sql(name: str, kind: str, cols: str) -> str:
    return (
        f"{name} AS (SELECT who, day, {cols} FROM tickets WHERE change = '{kind}' "
        "QUALIFY row_number() OVER (PARTITION BY who, day ORDER BY event_id) = 1)"
    )


_AFTER = "CAST(ts AS DATE) > DATE '2024-01-13'"
_RECENT = "CAST(ts AS DATE) >= DATE '2024-01-08'"
_DAY = "CAST(ts AS DATE)"
_EVENT_COLUMNS = ["exit_end", "early_end", "abs_from", "abs_to", "loa_from", "loa_to", "attr_from", "mv_eff", "mv_flow",
                  "mv_market", "x_unit", "x_flow", "x_eff", "pbu_eff", "pbu_new", "slob_eff", "slob_new", "role_eff",
                  "role_new", "market_eff", "market_new"]
_EVENT_TABLES = ["exits", "early", "t_abs", "t_loa", "t_attr", "t_mov", "cross_skill", "ch_pbu", "ch_slob", "ch_role", "ch_market"]


def _lob_rules(customer: str) -> str:
    flows = " ".join(f"WHEN pbu = 'COMMUNITY_OPS' AND slob = '{k}' THEN '{v}'" for k, v in R.COMMUNITY_FLOWS.items())
    return f"CASE WHEN pbu = 'LERT' AND slob = 'LERT' THEN 'LERT' WHEN {customer} THEN 'CO - Customer Support' {flows} ELSE lob END"


def _next(c: str) -> str:
    return f"coalesce(lead({c}) OVER (PARTITION BY user_id ORDER BY date), {c}) AS n_{c}"


def _short(sql: str) -> str:
    for old, new in R.CHANGE_ABBREVIATIONS:
        sql = f"replace({sql}, '{old}', '{new}')"
    return sql


SCHEDULE_FACT_SQL = f"""
    WITH {_GRID_SQL},
    roster AS (SELECT user_id AS r_id, day AS r_day, {', '.join(f'{sql} AS "{c}"' for c, sql in _ROSTER.items())}
      FROM user_days WHERE kind <> 'view'),
    exits AS (SELECT * FROM (SELECT user_id AS who, {_DAY} AS day, {_DAY} AS exit_end FROM events WHERE event_type = 'error'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1) WHERE day > DATE '2024-01-13'),
    {dated_sql('early', 'view', f'{_DAY} AS day, {_DAY} AS early_end', f'{_AFTER}')},
    {dated_sql('cross_skill', 'purchase', f'{_DAY} AS day, {_DAY} AS x_eff, {_X_UNIT} AS x_unit, {_X_FLOW} AS x_flow', f'{_DAY} - 1 > DATE ' + "'2024-01-13'")},
    {dated_sql('ch_pbu', 'click', f'{_DAY} AS day, {_DAY} AS pbu_eff, {_CH_PBU} AS pbu_new', f'{_RECENT}')},
    {dated_sql('ch_slob', 'view', f'{_DAY} AS day, {_DAY} AS slob_eff, {_CH_SLOB} AS slob_new', f'{_RECENT}')},
    {dated_sql('ch_role', 'signup', f"{_DAY} AS day, {_DAY} AS role_eff, 'Coach' AS role_new", f'{_RECENT}')},
    {dated_sql('ch_market', 'error', f"{_DAY} AS day, {_DAY} AS market_eff, 'GTM_ITALIAN' AS market_new", f'{_RECENT}')},
    asked AS (SELECT event_id, user_id, {_DAY} AS day, {_TICKET_KIND} AS change FROM events WHERE event_type = 'signup' AND event_id % 5 > 0),
    tickets AS (SELECT event_id, user_id AS who, day, change FROM asked UNION ALL
      SELECT event_id, user_id + 1, day, change FROM asked WHERE event_id % 8 < 4),
    {_ticket_sql('t_abs', 'Absenteeism', 'day AS abs_from, day + 3 AS abs_to')},
    {_ticket_sql('t_loa', 'LOA', 'day AS loa_from, day + 3 AS loa_to')},
    {_ticket_sql('t_attr', 'Managed Attrition', 'day AS attr_from')},
    {_ticket_sql('t_mov', 'Movement', "day AS mv_eff, CASE WHEN event_id % 3 > 0 THEN 'GTM' END AS mv_flow, 'mk' || event_id % 2 AS mv_market")},
    joined AS (SELECT g.user_id, g.eid, g.date, g.date AS day, g.week_ending, g.value, roster.* EXCLUDE (r_id, r_day), {', '.join(_EVENT_COLUMNS)}
      FROM grid g LEFT JOIN roster ON r_id = g.user_id AND r_day = g.date
      {' '.join(f'LEFT JOIN {e} ON {e}.who = g.user_id AND {e}.day = g.date' for e in _EVENT_TABLES)}),
    carried AS (SELECT user_id, eid, date, week_ending, value, {', '.join(f'"{c}"' for c in _OWN_DAY)},
      {', '.join(f'{carry(c)} AS c_{c}' for c in _CARRIED)}, {', '.join(f'{carry(c)} AS {c}' for c in _EVENT_COLUMNS)},
      count(slob_eff) OVER (PARTITION BY user_id) > 0 AS flow_changed,
      CASE WHEN user_id % 5 = 0 THEN 45310 + user_id % 7 ELSE 0 END AS off FROM joined),
    gone AS (SELECT * REPLACE (CASE WHEN date > exit_end AND off = 0 THEN '-' ELSE value END AS value),
      CASE WHEN date = exit_end AND off = 0 THEN 'roll_off' END AS mark,
      CASE WHEN off = 0 THEN DATE '1900-01-01' ELSE DATE '1899-12-30' + CAST(off AS INTEGER) END AS roll_off FROM carried),
    left_early AS (SELECT * REPLACE (CASE WHEN date > early_end THEN '-' ELSE value END AS value,
      CASE WHEN date = roll_off THEN 'roll_off' WHEN date = early_end THEN 'roll_off' ELSE mark END AS mark,
      CASE WHEN coalesce(c_employee_status, 'Active') = 'Active' AND date > roll_off AND roll_off <> DATE '1900-01-01' THEN 'Rolled-Off'
        ELSE c_employee_status END AS c_employee_status) FROM gone),
    fcst AS (SELECT *, CASE WHEN (date BETWEEN abs_from AND abs_to OR date BETWEEN loa_from AND loa_to) AND value NOT IN ('L1', 'L2') THEN 1
      WHEN date > attr_from AND value <> '-' THEN 1 ELSE 0 END AS abs_fcst, {_FLAGS_SQL} FROM left_early),
    promoted AS (SELECT * REPLACE (CASE WHEN c_role = 'Trainee' AND date >= min(CASE WHEN "WD" = 1 AND c_role = 'Trainee' THEN date END)
        OVER (PARTITION BY user_id) THEN 'Analyst' ELSE c_role END AS c_role),
      CAST(coalesce("WD" = 1 AND rta_status = 'Abs' AND (srtf_total_hrs < 1 OR srtf_total_hrs IS NULL), FALSE)
        OR (abs_fcst = 1 AND iw_attendance_status IS NULL) AS INTEGER) AS abs FROM fcst),
    billed AS (SELECT * REPLACE (CASE WHEN c_role = 'Analyst' AND c_employee_status = 'Active' AND date >= min(CASE WHEN "WD" = 1
        AND c_role = 'Analyst' AND c_billable = 'non-billable' THEN date END) OVER (PARTITION BY user_id) THEN 'billable' ELSE c_billable END AS c_billable)
      FROM promoted),
    units AS (SELECT *, CASE WHEN c_workflow = 'CO - Customer Support' THEN 'CUSTOMER_SUPPORT' WHEN c_workflow LIKE 'CO -%' THEN 'COMMUNITY_OPS'
        WHEN c_workflow = 'Non-Rec' THEN 'COMMUNITY_OPS' ELSE c_workflow END AS pbu0, c_workflow AS lob0,
      CASE WHEN date >= mv_eff THEN mv_market ELSE c_cluster END AS market0,
      CASE WHEN date >= mv_eff THEN mv_flow ELSE c_current_workflow END AS slob0 FROM billed),
    crossed AS (SELECT * EXCLUDE (pbu0, lob0, slob0), CASE WHEN date >= x_eff THEN x_unit ELSE pbu0 END AS pbu, lob0 AS lob,
      replace(replace(CASE WHEN date >= x_eff THEN x_flow ELSE slob0 END, 'OBJECTS/IGPR', 'Objects/IGPR'), 'MESSENGER', 'Messenger') AS slob FROM units),
    pass1 AS (SELECT * REPLACE ({_lob_rules("pbu = 'CUSTOMER_SUPPORT' AND slob = 'IDVAAS'")} AS lob) FROM crossed),
    changed AS (SELECT * REPLACE (CASE WHEN date >= pbu_eff THEN pbu_new ELSE pbu END AS pbu,
      CASE WHEN date >= slob_eff THEN slob_new ELSE slob END AS slob, CASE WHEN date >= role_eff THEN role_new ELSE c_role END AS c_role,
      CASE WHEN date >= market_eff THEN market_new ELSE market0 END AS market0) FROM pass1),
    pass2 AS (SELECT * REPLACE ({_lob_rules("pbu = 'CUSTOMER_SUPPORT'")} AS lob) FROM changed),
    settled AS (SELECT * REPLACE (CASE WHEN lob = 'CO - Customer Support' THEN 'IDVAAS' ELSE slob END AS slob) FROM pass2),
    support AS (SELECT * REPLACE (CASE WHEN slob IN ('Policy', 'Training') AND flow_changed THEN 'CO - PTQ' ELSE lob END AS lob) FROM settled),
    markets AS (SELECT * REPLACE (CASE WHEN market0 = 'GTM_ITALIAN' THEN 'CO - GTM' WHEN market0 = 'PDO_VACCINE_HESITANCY' THEN 'CO - Vaccine Hesitancy'
      ELSE lob END AS lob, CASE WHEN market0 = 'GTM_ITALIAN' THEN 'GTM' ELSE slob END AS slob) FROM support),
    n1 AS (SELECT *, {_next('c_role')} FROM markets WHERE c_role IS NOT NULL),
    n2 AS (SELECT *, {_next('pbu')} FROM n1 WHERE pbu IS NOT NULL),
    n3 AS (SELECT *, {_next('slob')} FROM n2 WHERE slob IS NOT NULL),
    n4 AS (SELECT *, {_next('market0')} FROM n3 WHERE market0 IS NOT NULL),
    {_WSC_SQL.format(source='n4')},
    daily AS (SELECT user_id AS d_id, day AS d_day FROM user_days WHERE kind = 'purchase'),
    final AS (SELECT * FROM marked LEFT JOIN daily ON d_id = user_id AND d_day = date)
    SELECT eid AS "EID", c_role AS "ROLE", 'n' || user_id AS "NAME", '#' || user_id AS "SRT ID", CAST(user_id % 4 AS VARCHAR) AS "WAVE",
      c_employee_status AS "STATUS", strftime(DATE '1899-12-30' + 44000, '%m/%d/%Y') AS "ROLL IN DATE", strftime(roll_off, '%m/%d/%Y') AS "ROLL OFF DATE",
      c_team_lead AS "SUPERVISOR CURRENT", c_ops_lead_eid AS "OPS", upper(market0) AS "MARKET", c_skills AS "Flow Skills",
      CASE pbu WHEN 'CUSTOMER_SUPPORT' THEN 'COMMUNITY_OPS' ELSE pbu END AS "PBU", slob AS "SLOB",
      CASE lob WHEN 'CO - Customer Support' THEN 'CO - Graph Integrity' ELSE lob END AS "LOB",
      'x' AS "SupportRole", 'x' AS "SAP ID", 'x' AS "SHIFT BLOCK", date, value, {_SHIFT_SQL} AS shift, week_ending,
      "Schedule", "WD", "LOA", "PTO", abs AS "ABS", "Leave", iw_highlevel_status, iw_attendance_status,
      coalesce("status_final_AL", CASE WHEN d_id IS NOT NULL THEN 'daily' END) AS "status_final_AL",
      coalesce(rta_status, CASE WHEN d_id IS NOT NULL THEN 'Work' END) AS rta_status,
      coalesce(rta_status_code, CASE WHEN d_id IS NOT NULL THEN 'D1' END) AS rta_status_code,
      srtf_total_hrs, srtf_completed_time, iw_actual_time, "WH", {_WSC} AS "WSC",
      CASE WHEN c_role <> n_c_role THEN c_role || ' to ' || n_c_role END AS role_change,
      CASE WHEN pbu <> n_pbu OR slob <> n_slob OR market0 <> n_market0 THEN
        {_short("pbu || '_' || slob || '_' || market0 || ' to ' || n_pbu || '_' || n_slob || '_' || n_market0")} END AS cross_change,
      mark AS "roll_off/reassignment", c_billable AS billable, abs_fcst AS "ABS_FCST" FROM final
    """


@query("schedule_fact", SCHEDULE_FACT_SQL)
def schedule_fact(t: Tables) -> DataFrame:
    """Every stage of the main edition."""
    return SF.build_schedule_fact(_inputs(t), RUN_DATE, "main")


@query(
    "schedule_fact_2022",
    f"""
    WITH {_GRID_SQL},
    roster AS (SELECT user_id AS r_id, day AS r_day, {', '.join(f'{sql} AS "{c}"' for c, sql in _ROSTER.items())}
      FROM user_days WHERE kind <> 'view'),
    joined AS (SELECT g.user_id, g.eid, g.date, g.date AS day, g.week_ending, g.value, roster.* EXCLUDE (r_id, r_day)
      FROM grid g LEFT JOIN roster ON r_id = g.user_id AND r_day = g.date),
    carried AS (SELECT user_id, eid, date, week_ending, value, {', '.join(f'"{c}"' for c in _OWN_DAY)},
      {', '.join(f'{carry(c)} AS c_{c}' for c in _CARRIED)}, {_FLAGS_SQL} FROM joined),
    promoted AS (SELECT * REPLACE (CASE WHEN c_role = 'Trainee' AND date >= min(CASE WHEN "WD" = 1 AND c_role = 'Trainee' THEN date END)
        OVER (PARTITION BY user_id) THEN 'Analyst' ELSE c_role END AS c_role),
      CASE WHEN user_id % 5 = 0 THEN DATE '1899-12-30' + CAST(45310 + user_id % 7 AS INTEGER) ELSE DATE '1900-01-01' END AS roll_off FROM carried),
    {_WSC_SQL.format(source='promoted')}
    SELECT eid AS "EID", c_role AS "ROLE", 'n' || user_id AS "NAME", '#' || user_id AS "SRT ID", CAST(user_id % 4 AS VARCHAR) AS "WAVE",
      c_employee_status AS "STATUS", strftime(DATE '1899-12-30' + 44000, '%m/%d/%Y') AS "ROLL IN DATE", strftime(roll_off, '%m/%d/%Y') AS "ROLL OFF DATE",
      c_team_lead AS "SUPERVISOR CURRENT", c_ops_lead_eid AS "OPS", upper(c_cluster) AS "MARKET", c_skills AS "Flow Skills",
      CASE WHEN c_workflow = 'CO - Customer Support' THEN 'CUSTOMER_SUPPORT' WHEN c_workflow LIKE 'CO -%' THEN 'COMMUNITY_OPS'
        WHEN c_workflow = 'Non-Rec' THEN 'COMMUNITY_OPS' ELSE c_workflow END AS "PBU", c_current_workflow AS "SLOB", c_workflow AS "LOB",
      'x' AS "SHIFT BLOCK", date, value, {_SHIFT_SQL} AS shift, week_ending, "Schedule", "WD", "LOA", "PTO",
      CAST(coalesce("WD" = 1 AND rta_status = 'Abs' AND (srtf_total_hrs < 1 OR srtf_total_hrs IS NULL), FALSE) AS INTEGER) AS "ABS",
      "Leave", iw_highlevel_status, iw_attendance_status, "status_final_AL", rta_status, rta_status_code, srtf_total_hrs,
      srtf_completed_time, iw_actual_time, "WH", {_WSC} AS "WSC", c_billable AS billable FROM marked
    """,
)
def schedule_fact_2022(t: Tables) -> DataFrame:
    """The edition without overlays, change texts and roll-off status."""
    return SF.build_schedule_fact(_inputs(t), RUN_DATE, "2022")


_NO_VALUE = ["iw_highlevel_status", "iw_attendance_status", "status_final_AL", "rta_status", "rta_status_code", "unplanned_abs",
             "planned_loa", "planned_pto", "scheduled_rta", "role_change", "cross_change", "roll_off/reassignment"]
_EVENTS_2024 = ["early_end", "abs_from", "abs_to", "loa_from", "loa_to", "attr_from", "x_unit", "x_flow", "x_eff", "slob_eff", "slob_new"]
_SQL_2024 = f"""
    WITH {_GRID_SQL},
    {dated_sql('early', 'view', f'{_DAY} AS day, {_DAY} AS early_end', f'{_AFTER}')},
    {dated_sql('cross_skill', 'purchase', f'{_DAY} AS day, {_DAY} AS x_eff, {_X_UNIT} AS x_unit, {_X_FLOW} AS x_flow', f'{_DAY} - 1 > DATE ' + "'2024-01-13'")},
    {dated_sql('ch_slob', 'view', f'{_DAY} AS day, {_DAY} AS slob_eff, {_CH_SLOB} AS slob_new')},
    asked AS (SELECT event_id, user_id, {_DAY} AS day, {_TICKET_KIND} AS change FROM events WHERE event_type = 'signup' AND event_id % 5 > 0),
    tickets AS (SELECT event_id, user_id AS who, day, change FROM asked UNION ALL
      SELECT event_id, user_id + 1, day, change FROM asked WHERE event_id % 8 < 4),
    {_ticket_sql('t_abs', 'Absenteeism', 'day AS abs_from, day + 3 AS abs_to')},
    {_ticket_sql('t_loa', 'LOA', 'day AS loa_from, day + 3 AS loa_to')},
    {_ticket_sql('t_attr', 'Managed Attrition', 'day AS attr_from')},
    joined AS (SELECT g.user_id, g.eid, g.date, g.date AS day, g.week_ending, g.value, {', '.join(_EVENTS_2024)} FROM grid g
      {' '.join(f'LEFT JOIN {e} ON {e}.who = g.user_id AND {e}.day = g.date' for e in ('early', 't_abs', 't_loa', 't_attr', 'cross_skill', 'ch_slob'))}),
    carried AS (SELECT user_id, eid, date, week_ending, value, {', '.join(f'{carry(c)} AS {c}' for c in _EVENTS_2024)},
      count(slob_eff) OVER (PARTITION BY user_id) > 0 AS flow_changed,
      CASE WHEN user_id % 5 = 0 THEN DATE '1899-12-30' + CAST(45310 + user_id % 7 AS INTEGER) ELSE DATE '1900-01-01' END AS roll_off FROM joined),
    left_early AS (SELECT * REPLACE (CASE WHEN date > early_end THEN '-' ELSE value END AS value) FROM carried),
    fcst AS (SELECT *, CASE WHEN (date BETWEEN abs_from AND abs_to OR date BETWEEN loa_from AND loa_to) AND value NOT IN ('L1', 'L2') THEN 1
      WHEN date > attr_from AND value <> '-' THEN 1 ELSE 0 END AS abs_fcst, {_FLAGS_SQL},
      CASE WHEN date >= x_eff THEN x_unit ELSE 'x' END AS pbu, 'x' AS lob, replace(replace(CASE WHEN date >= x_eff THEN x_flow ELSE 'x' END,
      'OBJECTS/IGPR', 'Objects/IGPR'), 'MESSENGER', 'Messenger') AS slob FROM left_early),
    pass1 AS (SELECT * REPLACE ({_lob_rules("pbu = 'CUSTOMER_SUPPORT' AND slob = 'IDVAAS'")} AS lob) FROM fcst),
    changed AS (SELECT * REPLACE (CASE WHEN date >= slob_eff THEN slob_new ELSE slob END AS slob) FROM pass1),
    pass2 AS (SELECT * REPLACE ({_lob_rules("pbu = 'CUSTOMER_SUPPORT'")} AS lob) FROM changed),
    settled AS (SELECT * REPLACE (CASE WHEN lob = 'CO - Customer Support' THEN 'IDVAAS' ELSE slob END AS slob) FROM pass2),
    support AS (SELECT * REPLACE (CASE WHEN slob IN ('Policy', 'Training') AND flow_changed THEN 'CO - PTQ' ELSE lob END AS lob) FROM settled),
    {_WSC_SQL.format(source='support')}
    SELECT eid AS "EID", 'Analyst' AS "ROLE", 'n' || user_id AS "NAME", '#' || user_id AS "SRT ID", CAST(user_id % 4 AS VARCHAR) AS "WAVE",
      'Active' AS "STATUS", strftime(DATE '1899-12-30' + 44000, '%m/%d/%Y') AS "ROLL IN DATE", strftime(roll_off, '%m/%d/%Y') AS "ROLL OFF DATE",
      {', '.join(f"'x' AS " + f'"{c}"' for c in ('SUPERVISOR CURRENT', 'OPS', 'MARKET', 'Flow Skills', 'SupportRole', 'SAP ID', 'SHIFT BLOCK'))},
      CASE pbu WHEN 'CUSTOMER_SUPPORT' THEN 'COMMUNITY_OPS' ELSE pbu END AS "PBU", slob AS "SLOB",
      CASE lob WHEN 'CO - Customer Support' THEN 'CO - Graph Integrity' ELSE lob END AS "LOB", date, value, {_SHIFT_SQL} AS shift, week_ending,
      "Schedule", "WD", "LOA", "PTO", abs_fcst AS "ABS", "Leave", {', '.join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in _NO_VALUE)},
      CAST(NULL AS DOUBLE) AS srtf_total_hrs, {_WSC} AS "WSC"%s FROM marked
    """


@query("schedule_fact_2024", _SQL_2024.replace("%s", ""))
def schedule_fact_2024(t: Tables) -> DataFrame:
    """The edition that takes attributes from the sheet and leaves exits alone."""
    return SF.build_schedule_fact(_inputs(t), RUN_DATE, "2024")


@query("schedule_fact_2024_wfh", _SQL_2024.replace("%s", ', abs_fcst AS "ABS_FCST"'))
def schedule_fact_2024_wfh(t: Tables) -> DataFrame:
    """As the 2024 edition, with the forecast column."""
    return SF.build_schedule_fact(_inputs(t), RUN_DATE, "2024_wfh")
