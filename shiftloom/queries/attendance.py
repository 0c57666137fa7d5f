"""Attendance and hours: feeds of events per (user, day) resolved against each other."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules
from shiftloom.operators.aggregates import COMPLETED_PARTS, STATUS_COLUMNS, TOTAL_PARTS
from shiftloom.plans import feeds, roster
from shiftloom.plans import rule_tables as R
from shiftloom.plans.snapshot import snapshot_fact as take_snapshot
from shiftloom.queries.registry import RUN_DATE, USER_DAYS_SQL, Tables, query, user_days, week_sql
from shiftloom.sources import schemas


def event_day() -> Column:
    return F.col("ts").cast("date")


def feed_of(t: Tables, kind: str, out: str) -> DataFrame:
    """Greatest value of one kind of event per (user, day)."""
    return (
        t.events.where(F.col("event_type") == kind).groupBy("user_id", event_day().alias("day")).agg(F.max("value").alias(out))
    )


@query(
    "coalesce_cascade",
    f"""
    WITH {USER_DAYS_SQL}, v AS (SELECT user_id, CAST(ts AS DATE) AS day,
      max(value) FILTER (WHERE event_type = 'signup') AS a, max(value) FILTER (WHERE event_type = 'purchase') AS b,
      max(value) FILTER (WHERE event_type = 'view') AS c FROM events GROUP BY 1, 2)
    SELECT user_id, day, coalesce(a, b, c) AS status FROM user_days LEFT JOIN v USING (user_id, day)
    """,
)
def coalesce_cascade(t: Tables) -> DataFrame:
    rows = user_days(t).select("user_id", "day")
    for kind, out in (("signup", "a"), ("purchase", "b"), ("view", "c")):
        rows = rows.join(feed_of(t, kind, out), ["user_id", "day"], "left")
    return rows.select("user_id", "day", rules.first_present("a", "b", "c").alias("status"))


_LIST_FLOW = "CASE c_nationkey % 5 WHEN 0 THEN 'MESSENGER' WHEN 1 THEN 'GTM' WHEN 2 THEN 'IDVAAS' WHEN 3 THEN 'Policy' ELSE 'Non-Rec' END"


@query(
    "conditional_fill",
    f"""
    WITH people AS (SELECT c_custkey AS enterprise_id, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Trainee' ELSE 'Analyst' END AS role,
      CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS current_workflow, CASE WHEN c_custkey % 3 > 0 THEN 'PT' END AS cluster,
      CASE WHEN c_custkey % 5 > 0 THEN 'CO - Start' END AS workflow FROM customer),
    list AS (SELECT c_custkey AS eid, {_LIST_FLOW} AS flow, 'M' || c_nationkey AS market FROM customer WHERE c_custkey % 4 < 3),
    lobs AS (SELECT *, CASE flow {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in R.TRAINEE_FLOWS.items())} END AS lob FROM list)
    SELECT enterprise_id, role,
      CASE WHEN role = 'Trainee' AND current_workflow IS NULL THEN flow ELSE current_workflow END AS current_workflow,
      CASE WHEN role = 'Trainee' AND cluster IS NULL THEN market ELSE cluster END AS cluster,
      CASE WHEN role = 'Trainee' AND workflow IS NULL THEN lob ELSE workflow END AS workflow
    FROM people LEFT JOIN lobs ON enterprise_id = eid
    """,
)
def conditional_fill(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    people = t.customer.select(
        key.alias("enterprise_id"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), F.lit("Trainee")).otherwise(F.lit("Analyst")).alias("role"),
        F.when(key % 2 == 1, F.col("c_mktsegment")).alias("current_workflow"),
        F.when(key % 3 > 0, F.lit("PT")).alias("cluster"), F.when(key % 5 > 0, F.lit("CO - Start")).alias("workflow"),
    )
    trainees = t.customer.where(key % 4 < 3).select(
        key.alias("EID"), F.expr(_LIST_FLOW).alias("Training FLOW"),
        F.concat(F.lit("M"), F.col("c_nationkey").cast("string")).alias("Market"),
    )
    return people.transform(roster.trainee_fill(trainees))


# Status map: a rule table of the business, not data.
STATUS_ROWS = [
    ("1A - LATE", "Abs", "A1", "unplanned", "AL"),
    ("1B - SICK LEAVE", "Abs", "A2", "unplanned", "SL"),
    ("12 -TRAINING", "Work", "W2", "work", "TR"),
    ("Work", "Work", "W1", "work", "WK"),
    ("Leave - unpaid", "Off", "O1", "planned", "LU"),
    ("purchase", "Work", "W3", "work", "PU"),
    ("signup", "Work", "W4", "work", "SU"),
]
_MAP_SQL = (
    "status_map(status_final, status, status_code, highlevel, wh_code) AS (VALUES "
    + ", ".join(str(r) for r in STATUS_ROWS) + ")"
)
_ADJUSTED = "CASE event_id % 4 WHEN 0 THEN '1A, LATE' WHEN 1 THEN '1B - SICK LEAVE{nl}' WHEN 2 THEN '12-TRAINING' END"
_ATTENDANCE = "CASE {kind} WHEN 'click' THEN 'Work' WHEN 'view' THEN 'Leave, unpaid' WHEN 'signup' THEN 'Leave, unpaid' END"


def status_map(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(STATUS_ROWS, schemas.STATUS_MAP)


_CLEAN = "replace(CASE WHEN contains({s}, '1B - SICK LEAVE' || chr(10)) THEN '1B - SICK LEAVE' ELSE {s} END, '12-', '12 -')"
_ADJ_SQL = (
    "adj AS (SELECT user_id, day, " + _CLEAN.format(s="replace(s, ',', ' -')") + " AS adjusted FROM (SELECT user_id, CAST(ts AS DATE) AS day, "
    + _ADJUSTED.format(nl="' || chr(10) || '") + " AS s FROM events WHERE event_type = 'error' "
    "QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1))"
)


def adjustments(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "error").select(
        F.col("user_id").alias("Username"), event_day().alias("Date"),
        F.expr(_ADJUSTED.format(nl="\\n")).alias("Status Final"), F.col("event_id").alias("ingest_seq"),
    )


def sheets(t: Tables) -> DataFrame:
    """Update sheets; a user may stand in them with several statuses for a day."""
    rows = t.events.select(
        F.col("user_id").alias("Username"), event_day().alias("Date"),
        F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("Status Final"), "event_type",
    ).distinct()
    return roster.update_sheets(
        *[rows.where(F.col("event_type") == k).drop("event_type") for k in ("purchase", "signup")]
    )


_SHEETS_SQL = (
    "sheets AS (SELECT user_id, day, fallback FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type, "
    "CASE WHEN event_id % 3 > 0 THEN event_type END AS fallback FROM events WHERE event_type IN ('purchase', 'signup')))"
)


@query(
    "resolve_status",
    f"""
    WITH {USER_DAYS_SQL}, {_MAP_SQL}, {_ADJ_SQL}, {_SHEETS_SQL},
    resolved AS (SELECT user_id, day, replace({_ATTENDANCE.format(kind='kind')}, ',', ' -') AS iw_attendance_status,
      replace(coalesce(adjusted, fallback, {_ATTENDANCE.format(kind='kind')}), ',', ' -') AS status_final
      FROM user_days LEFT JOIN adj USING (user_id, day) LEFT JOIN sheets USING (user_id, day))
    SELECT user_id, day, iw_attendance_status, resolved.status_final AS "status_final_AL", status AS rta_status,
      status_code AS rta_status_code, wh_code FROM resolved LEFT JOIN status_map ON resolved.status_final = status_map.status_final
    """,
)
def resolve_status(t: Tables) -> DataFrame:
    rows = user_days(t).select(
        F.col("user_id").alias("enterprise_id"), F.col("day").alias("roster_date"),
        F.expr(_ATTENDANCE.format(kind="kind")).alias("iw_attendance_status"),
    )
    adjusted = roster.adjustment_list(adjustments(t), ["ingest_seq"])
    return rows.transform(roster.resolve_status(adjusted, sheets(t), status_map(t))).withColumnsRenamed(
        {"enterprise_id": "user_id", "roster_date": "day", "WH Code": "wh_code"}
    )


@query(
    "shift_final_status",
    f"""
    WITH {_MAP_SQL}, shifts AS (SELECT event_id, ts AS shift_start, coalesce(CASE event_type WHEN 'click' THEN 'Work' END,
      CASE event_type WHEN 'view' THEN 'Leave - unpaid' END, CASE WHEN event_type <> 'error' THEN event_type END) AS status_final
      FROM events WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-14 15:00:00')
    SELECT event_id, shift_start AS "Shift_Start", shifts.status_final, status AS status_daily, status_code AS status_code_daily,
      highlevel AS highlevel_m_daily, wh_code AS "WH Code_daily"
    FROM shifts LEFT JOIN status_map ON shifts.status_final = status_map.status_final
    """,
)
def shift_final_status(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    extract = t.events.select(
        "event_id", F.col("ts").alias("Shift_Start"), F.when(kind == "click", F.lit("Work")).alias("Event_Name"),
        F.when(kind == "view", F.lit("Leave - unpaid")).alias("Updated_Status"),
        F.when(kind != "error", kind).alias("System_Generated_Status"),
    )
    done = extract.transform(feeds.shift_final_status(status_map(t), RUN_DATE, 15, "yesterday"))
    return done.drop("Event_Name", "Updated_Status", "System_Generated_Status")


@query(
    "attendance_compile",
    """
    SELECT DISTINCT user_id AS "Username", strftime(CAST(ts AS DATE), '%m/%d/%Y') AS "Date", status AS "Status Final" FROM (
      SELECT user_id, ts, event_type AS status FROM events WHERE event_type IN ('click', 'view')
      UNION ALL SELECT user_id, ts, nullif(event_type, 'view') FROM events WHERE event_type IN ('view', 'error')
      UNION ALL SELECT user_id, ts, 'view' FROM events WHERE event_type = 'signup')
    """,
)
def attendance_compile(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("Username"), event_day().alias("Date"), F.col("event_type").alias("Status Final"))
    status = F.col("Status Final")
    return feeds.attendance_compile(
        rows.where(status.isin("click", "view")),
        rows.where(status.isin("view", "error")).withColumn("Status Final", rules.sentinel_to_null(status, "view")),
        rows.where(status == "signup").withColumn("Status Final", F.lit("view")),
    )


# -- feed jobs -----------------------------------------------------------------------


@query(
    "conform_feed",
    """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'Dublin, Ireland' ELSE o_orderpriority END AS "Work City",
      strftime(o_orderdate, '%m-%d-%Y') AS "Week Ending", strftime(o_orderdate, '%m-%d-%Y') AS "Date",
      CAST(o_custkey AS VARCHAR) AS "SRT ID", upper('m' || o_orderstatus) AS "Staffing Market",
      TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '-' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS "Non-SRT Production",
      CAST(o_orderkey AS DOUBLE) AS "Onboarding", o_totalprice AS "Available", o_orderkey AS "Enterprise ID",
      o_orderstatus AS "business unit", 1 AS "Non-FB Learning", strftime(o_orderdate, '%m-%d-%Y') AS "Week Ending Str"
    FROM orders
    """,
)
def conform_feed(t: Tables) -> DataFrame:
    raw = t.orders.select(
        rules.value_map("o_orderpriority", {"1-URGENT": "Dublin,Ireland"}).alias("Work City"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Week Ending"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Transaction Date"),
        F.concat(F.lit("#"), F.col("o_custkey").cast("string")).alias("SRT ID"),
        F.concat(F.lit("m"), F.col("o_orderstatus")).alias("Staffing Market"),
        F.when(F.col("o_orderstatus") == "P", F.lit("-")).otherwise(F.col("o_totalprice").cast("string")).alias("Non-SRT Production"),
        F.col("o_orderkey").cast("string").alias("Onboarding"), F.col("o_totalprice").alias("Time Elapsed (Active)"),
        F.col("o_orderkey").alias("Assigned To"), F.col("o_orderstatus").alias("Business"), F.lit(1).alias("Non-FB  Learning"),
    )
    return raw.transform(feeds.conform_billed_hours())


@query(
    "conform_timestamps",
    f"""
    SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS srt_id, event_id AS enterprise_id, event_type AS business_unit,
      value AS available, CAST(floor(value) AS DOUBLE) AS onboarding, TRY_CAST(nullif(event_type, event_type) AS DOUBLE) AS "non-fb_learning",
      value AS total_hours, {week_sql('CAST(ts AS DATE)')} AS week_ending, strftime({week_sql('CAST(ts AS DATE)')}, '%m-%d-%Y') AS week_ending_str,
      strftime(ts, '%m-%d-%Y') AS date_str FROM events
    """,
)
def conform_timestamps(t: Tables) -> DataFrame:
    raw = t.events.select(
        F.date_format("ts", "MM-dd-yyyy").alias("Transaction Date"),
        F.concat(F.lit("#"), F.col("user_id").cast("string")).alias("SRT ID"), F.col("event_id").alias("Assigned To"),
        F.col("event_type").alias("Business"), F.col("value").alias("Time Elapsed (Active)"),
        F.floor("value").cast("string").alias("Onboarding"), F.lit("-").alias("Non-FB - Learning"),
        F.col("value").alias("Total Hours"), F.col("props").alias("Note"),
    )
    return raw.transform(feeds.conform_timestamps())


@query(
    "conform_weekly_roster",
    """
    SELECT 'COMMUNITY_OPS ' AS "Program", c_mktsegment AS "Location", c_custkey AS "Enterprise ID",
      CASE WHEN c_custkey % 3 = 0 THEN 'A & B' ELSE c_mktsegment END AS "Resource Name",
      CAST(c_custkey AS VARCHAR) AS "SRT ID", replace(c_name, '0', 'NA') AS "SRT Name",
      CASE c_nationkey % 3 WHEN 0 THEN 'Analyst' WHEN 1 THEN 'Team Lead' ELSE 'Trainer' END AS "Role",
      '' AS "SOW", '' AS "Phase", c_nationkey AS "Local Team Name", c_nationkey AS "Market / Base Area / Pillar",
      lower(c_name) AS "Team Lead EID", '1900-01-01' AS "Roll Off Date", '' AS "Date of Movement", '' AS "Resignation Date",
      '12-15-2023' AS "Roster Week Index", 1 AS x1, 2 AS x2, 3 AS x3, 4 AS x4, 5 AS x5, 6 AS x6, '' AS "OJT Start Date" FROM customer
    """,
)
def conform_weekly_roster(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey")
    raw = t.customer.select(
        F.col("c_mktsegment").alias("Location"), F.col("c_custkey").alias("Enterprise ID"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("A%26B")).otherwise(F.col("c_mktsegment")).alias("Resource Name"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("SRT ID"), F.col("c_name").alias("SRT Name"),
        F.when(nation % 3 == 0, F.lit("Reviewer")).when(nation % 3 == 1, F.lit("Operation Team Lead")).otherwise(F.lit("Trainer")).alias("Role"),
        nation.alias("PBU"), nation.alias("Planning Group"), F.col("c_name").alias("Team Lead EID"),
        F.lit(dt.date(1900, 1, 1)).alias("Roll Off Date"), *[F.lit(i).alias(f"x{i}") for i in range(1, 7)],
    )
    # the layout wants at least 20 columns before the date column
    wide = raw.select("Location", *[c for c in raw.columns if c != "Location"])
    return wide.transform(feeds.conform_weekly_roster("12-15-2023"))


@query(
    "snapshot_fact",
    f"""
    WITH {USER_DAYS_SQL}, fact AS (SELECT user_id AS eid, day, rtrim('#' || user_id || '.0', '.0') AS srt_id, CAST(kind = 'error' AS INTEGER) AS abs,
      CASE WHEN hours > 30 THEN kind END AS high, CASE WHEN hours > 100 THEN 'billable' ELSE 'non-billable' END AS billable FROM user_days),
    billed AS (SELECT eid AS "EID_firstbill", min(day) AS first_bill_day FROM fact WHERE billable = 'billable' GROUP BY 1)
    SELECT eid AS "EID", srt_id AS "SRT_ID", strftime(day, '%m-%d-%Y') AS date, abs AS "ABS", high AS iw_highlevel_status, billable,
      day AS date_aux, CAST(day AS VARCHAR) AS date_str, DATE '2023-12-29' AS mfdate, DATE '2024-01-15' AS creation_date,
      CAST(abs = 0 AND high IS NOT NULL AS INTEGER) AS "ABS_aux", "EID_firstbill", first_bill_day
    FROM fact LEFT JOIN billed ON eid = "EID_firstbill" AND day = first_bill_day
    """,
)
def snapshot_fact(t: Tables) -> DataFrame:
    fact = user_days(t).select(
        F.col("user_id").alias("EID"), F.concat(F.lit("#"), F.col("user_id").cast("string"), F.lit(".0")).alias("SRT ID"),
        F.col("day").alias("date"), rules.flag(F.col("kind") == "error").alias("ABS"),
        F.when(F.col("hours") > 30, F.col("kind")).alias("iw_highlevel/status"),
        F.when(F.col("hours") > 100, F.lit("billable")).otherwise(F.lit("non-billable")).alias("billable"),
    )
    return fact.transform(take_snapshot(RUN_DATE, dt.date(2023, 12, 29)))


# -- roster ---------------------------------------------------------------------------

_STATUS_OF = {"view": "available", "click": "coaching", "purchase": "meal", "signup": "break", "error": "unavailable"}
_STATUS_OF_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS_OF.items()) + " END"


def _parts(parts: list[str]) -> str:
    present = [p for p in parts if STATUS_COLUMNS[p] in _STATUS_OF.values()]
    return "round((" + " + ".join(f'coalesce("{p}", 0.0)' for p in present) + ") / 60, 2)"


@query(
    "roster_fact_sql",
    f"""
    WITH {USER_DAYS_SQL},
    attendance AS (SELECT 'u' || user_id AS who, CAST(ts AS DATE) AS shift_date, event_type AS highlevel_status,
      nullif(event_id % 4, 0) AS updated, 6 * floor(value) AS mins, event_id FROM events WHERE event_type = 'signup'),
    billed AS (SELECT 'u' || user_id AS who, CAST(ts AS DATE) AS bday, strftime(ts, '%m-%d-%Y') AS date, value, event_id
      FROM events WHERE event_type = 'purchase'),
    logged AS (SELECT DISTINCT CAST(ts AS DATE) AS sday, user_id, {_STATUS_OF_SQL} AS status, floor(value / 10) AS mins FROM events
      WHERE event_id % 6 <> 0),
    spent AS (SELECT sday, user_id, {', '.join(f'sum(mins) FILTER (WHERE status = {s!r}) AS "{c}"' for c, s in STATUS_COLUMNS.items() if s in _STATUS_OF.values())}
      FROM logged GROUP BY 1, 2)
    SELECT CAST(d.user_id AS VARCHAR) AS srt_id, 'u' || d.user_id AS enterprise_id, kind AS role, CAST(NULL AS VARCHAR) AS employee_status,
      d.value AS skills, d.value AS cluster, d.value AS workflow, d.value AS current_workflow, kind AS team_lead, kind AS ops_lead_eid,
      day AS roster_date, CAST({week_sql('day')} AS VARCHAR) AS week_end_date_text, strftime(day, '%Y-%m') AS report_month,
      'billable' AS billable, highlevel_status AS iw_highlevel_status, CAST(updated AS VARCHAR) AS iw_updated_status,
      highlevel_status AS iw_attendance_status, CAST(attendance.event_id AS VARCHAR) AS iw_srt_id, attendance.who AS iw_enterprise_id,
      shift_date AS iw_shift_date, highlevel_status AS iw_shift_status, highlevel_status AS iw_system_status,
      CAST(shift_date AS VARCHAR) AS iw_date_txt, CAST(shift_date AS VARCHAR) AS iw_week_end_date_txt,
      strftime(shift_date, '%Y-%m') AS iw_report_month, round(mins / 60, 2) AS iw_actual_time,
      billed.value AS srtf_total_hrs, billed.value AS srtf_completed_time, CAST(billed.event_id % 3 AS INTEGER) AS hc,
      CASE WHEN billed.event_id IS NOT NULL THEN 'none' END AS srtf_adjustment_type, billed.date,
      CASE WHEN spent.sday IS NOT NULL THEN {_parts(TOTAL_PARTS)} END AS ts_total_hours,
      CASE WHEN spent.sday IS NOT NULL THEN {_parts(COMPLETED_PARTS)} END AS ts_completed_time
    FROM (SELECT * FROM user_days WHERE kind <> 'view') d
    LEFT JOIN attendance ON 'u' || d.user_id = attendance.who AND day = shift_date
    LEFT JOIN billed ON 'u' || d.user_id = billed.who AND day = bday
    LEFT JOIN spent ON d.user_id = spent.user_id AND day = sday
    """,
)
def roster_fact_sql(t: Tables) -> DataFrame:
    """The join as SQL. Its views have names of their own and are dropped once the plan is known."""
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in ("roster", "attendance", "billed", "timestamps")}
    tables = roster_tables(t)
    for name, view in names.items():
        tables[name].createTempView(view)
    try:
        return roster.status_roster_tables(t.spark, **names, roster_city="inside", work_city="inside", week_ending=None)
    finally:
        for view in names.values():
            t.spark.catalog.dropTempView(view)

def roster_tables(t: Tables) -> dict[str, DataFrame]:
    """The four warehouse tables, cut from events; attendance and billed hours may have several rows a day."""
    firsts = t.events.withColumn("day", event_day())
    who = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    text_day, kind = F.date_format("ts", "MM-dd-yyyy"), F.col("event_type")
    value, lead = F.col("value"), F.col("kind")
    people = user_days(t).select(
        F.col("user_id").cast("string").alias("srt_id"), who.alias("enterprise_id"), lead.alias("role"),
        F.lit(None).cast("string").alias("employee_status"),
        *[value.alias(c) for c in ("skills", "cluster", "workflow", "current_workflow")],
        lead.alias("team_lead"), lead.alias("ops_lead_eid"), F.col("day").alias("roster_date"),
        dates.week_ending_friday("day").cast("string").alias("week_end_date_text"),
        F.date_format("day", "yyyy-MM").alias("report_month"), F.lit("billable").alias("billable"),
        F.when(lead == "view", F.lit("outside")).otherwise(F.lit("inside")).alias("city"),
    )
    iso_day = event_day().cast("string")
    attendance = firsts.where(kind == "signup").select(
        kind.alias("highlevel_status"), F.nullif(F.col("event_id") % 4, F.lit(0)).cast("string").alias("updated_status"),
        kind.alias("attendance_status"), F.col("event_id").cast("string").alias("srt_id"), who.alias("enterprise_id"),
        event_day().alias("shift_date"), kind.alias("shift_status"), kind.alias("system_status"), iso_day.alias("date_txt"),
        iso_day.alias("week_end_date_txt"), F.date_format("ts", "yyyy-MM").alias("report_month"),
        (6 * F.floor("value")).cast("string").alias("actual_time_min"),
    )
    billed = firsts.where(kind == "purchase").select(
        who.alias("enterprise id"), text_day.alias("date"), value.alias("total hours"), value.alias("completed time"),
        (F.col("event_id") % 3).cast("int").alias("hc"), F.lit("none").alias("adjustment types"),
    )
    logged = t.events.select(
        iso_day.alias("reporting_ds"), F.when(F.col("event_id") % 6 == 0, F.lit("outside")).otherwise(F.lit("inside")).alias("work_city"),
        F.col("user_id").cast("string").alias("actor_id"), rules.value_map("event_type", _STATUS_OF).alias("status"),
        F.floor(value / 10).cast("string").alias("time_in_status_mins"),
    )
    return {
        "roster": people, "attendance": attendance, "billed": billed, "timestamps": logged,
    }


_FLOW_OF_KIND = "CASE {k} WHEN 'click' THEN 'IDRA' WHEN 'view' THEN 'Object' ELSE {k} END"


_FAMILY = "CASE " + _FLOW_OF_KIND.format(k="event_type") + " " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in R.WORKFLOW_FAMILIES.items()) + " ELSE event_type END"
_SHRINKAGE_SQL = ("sheets AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 > 0 THEN 'Work, ' || event_id % 2 END AS fallback "
                  "FROM events WHERE event_type = 'signup')")


def _roster_sql(sheets: str, map_key: str, flow: str = _FAMILY, further: str = "") -> str:
    """``further``: columns of the extract that are passed on."""
    return f"""{_MAP_SQL}, {_ADJ_SQL}, {sheets},
    extract AS (SELECT event_id AS ingest_seq, user_id, CAST(ts AS DATE) AS day, event_type, {flow} AS current_workflow{further},
      nullif(event_id % 3, 0) AS hc, event_id % 2 AS srtf_date, CASE WHEN event_id % 5 > 0 THEN value END AS hours,
      {_ATTENDANCE.format(kind='event_type')} AS att, CASE WHEN event_id % 4 > 0 THEN value / 100 END AS actual FROM events),
    totals AS (SELECT user_id, day, coalesce(sum(hours), 0) AS adj FROM extract WHERE hc IS DISTINCT FROM 1 GROUP BY 1, 2),
    firsts AS (SELECT * FROM extract QUALIFY row_number() OVER (PARTITION BY user_id, day, srtf_date ORDER BY ingest_seq) = 1),
    resolved AS (SELECT firsts.* EXCLUDE (hours, att), round(coalesce(nullif(coalesce(adj, hours), 0), 7.5), 2) AS hours, replace(att, ',', ' -') AS att,
      replace(coalesce(adjusted, fallback, att), ',', ' -') AS final
      FROM firsts LEFT JOIN totals USING (user_id, day) LEFT JOIN adj USING (user_id, day) LEFT JOIN sheets USING (user_id, day)),
    enriched AS (SELECT resolved.*, user_id AS enterprise_id, day AS roster_date, hours AS srtf_total_hrs,
      att AS iw_attendance_status, final AS "status_final_AL", status AS rta_status, status_code AS rta_status_code,
      CASE WHEN actual > 0.33 THEN 'worked' ELSE wh_code END AS "WH"
      FROM resolved LEFT JOIN status_map ON resolved.{map_key} = status_map.status_final)"""


_ROSTER_SHOWN = ["ingest_seq", "enterprise_id", "roster_date", "current_workflow", "srtf_date", "srtf_total_hrs",
                 "iw_attendance_status", "status_final_AL", "rta_status", "rta_status_code", "WH"]
_ROSTER_SHOWN_SQL = ", ".join(f'"{c}"' for c in _ROSTER_SHOWN)


def _extract(t: Tables) -> DataFrame:
    seq, kind = F.col("event_id"), F.col("event_type")
    return t.events.select(
        seq.alias("ingest_seq"), F.col("user_id").alias("enterprise_id"), event_day().alias("roster_date"), kind,
        F.expr(_FLOW_OF_KIND.format(k="event_type")).alias("current_workflow"), F.nullif(seq % 3, F.lit(0)).alias("hc"),
        (seq % 2).alias("date"), F.when(seq % 5 > 0, F.col("value")).alias("srtf_total_hrs"), F.lit(7.5).alias("ts_total_hours"),
        F.lit(0.0).alias("srtf_completed_time"), F.lit(0.0).alias("ts_completed_time"),
        F.expr(_ATTENDANCE.format(kind="event_type")).alias("iw_attendance_status"),
        F.when(seq % 4 > 0, F.col("value") / 100).alias("iw_actual_time"),
    )


def _shrinkage(t: Tables) -> DataFrame:
    """The shrinkage report, its days as serials; a person may stand in it several times a day."""
    seq = F.col("event_id")
    rows = t.events.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("Username"), F.datediff(event_day(), F.lit(dt.date(1899, 12, 30))).alias("Day"),
        F.when(seq % 3 > 0, F.concat(F.lit("Work, "), (seq % 2).cast("string"))).alias("Status final"),
    )
    return roster.shrinkage_feed(rows.distinct())


def _roster_shown(fact: DataFrame, *further: str) -> DataFrame:
    worked = F.when(F.col("WH") == F.col("iw_actual_time").cast("string"), F.lit("worked")).otherwise(F.col("WH"))
    return fact.withColumns({"srtf_total_hrs": F.round("srtf_total_hrs", 2), "WH": worked}).select(*_ROSTER_SHOWN, *further)


@query("roster_fact", f"WITH {_roster_sql(_SHEETS_SQL, 'final')} SELECT {_ROSTER_SHOWN_SQL} FROM enriched")
def roster_fact(t: Tables) -> DataFrame:
    past = F.col("event_type").isin("click", "view")
    extract = _extract(t)
    inputs = roster.RosterInputs([extract.where(past), extract.where(~past)], adjustments(t), sheets(t), status_map(t))
    return _roster_shown(roster.build_roster_fact(inputs))


@query("roster_fact_2022", f"WITH {_roster_sql(_SHRINKAGE_SQL, 'att')} SELECT {_ROSTER_SHOWN_SQL} FROM enriched")
def roster_fact_2022(t: Tables) -> DataFrame:
    """One extract, the shrinkage report as fallback, and the status mapped from the attendance feed."""
    inputs = roster.RosterInputs([_extract(t)], adjustments(t), _shrinkage(t), status_map(t))
    return _roster_shown(roster.build_roster_fact(inputs, map_key="iw_attendance_status"))


@query("roster_fact_2024", f"WITH {_roster_sql(_SHEETS_SQL, 'final')} SELECT {_ROSTER_SHOWN_SQL} FROM enriched")
def roster_fact_2024(t: Tables) -> DataFrame:
    """One extract, update sheets as fallback."""
    return _roster_shown(roster.build_roster_fact(roster.RosterInputs([_extract(t)], adjustments(t), sheets(t), status_map(t))))


_TRAINEE_FLOW = "CASE c_nationkey % 4 WHEN 0 THEN 'Messenger' WHEN 1 THEN 'IDVAAS' WHEN 2 THEN 'GTM' ELSE c_mktsegment END"
_TRAINEE_LOB_SQL = "CASE flow " + " ".join(f"WHEN '{f}' THEN '{lob}'" for f, lob in R.TRAINEE_FLOWS.items()) + " END"


@query(
    "roster_fact_wfh",
    f"""
    WITH {_roster_sql(_SHRINKAGE_SQL, 'final', f"CASE WHEN event_id % 7 > 1 THEN {_FAMILY} END", """,
      CASE WHEN event_id % 2 = 0 THEN 'Trainee' ELSE 'Analyst' END AS role, CASE WHEN event_id % 5 > 2 THEN event_type END AS cluster,
      CASE WHEN event_id % 3 > 0 THEN event_type END AS workflow""")},
    trainees AS (SELECT c_custkey AS who, {_TRAINEE_FLOW} AS flow, c_mktsegment AS market FROM customer WHERE c_custkey % 3 > 0),
    deployed AS (SELECT c_custkey AS who, DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER) AS deployed_on,
      CASE WHEN c_custkey % 2 = 0 THEN DATE '2023-02-01' + CAST(c_custkey % 300 AS INTEGER) END AS graduated_on, c_mktsegment AS dmr
      FROM customer WHERE c_custkey % 4 > 0),
    filled AS (SELECT enriched.* REPLACE (
      CASE WHEN role = 'Trainee' AND current_workflow IS NULL THEN flow ELSE current_workflow END AS current_workflow,
      CASE WHEN role = 'Trainee' AND cluster IS NULL THEN market ELSE cluster END AS cluster,
      CASE WHEN role = 'Trainee' AND workflow IS NULL THEN {_TRAINEE_LOB_SQL} ELSE workflow END AS workflow)
      FROM enriched LEFT JOIN trainees ON trainees.who = enterprise_id)
    SELECT {_ROSTER_SHOWN_SQL}, role, cluster, workflow, deployed_on AS "OpsDeploymentDate", graduated_on AS "Graduation_Date", dmr AS "DMR Status"
    FROM filled LEFT JOIN deployed ON deployed.who = enterprise_id
    """,
)
def roster_fact_wfh(t: Tables) -> DataFrame:
    """Trainees take what they lack from the trainee list; shrinkage report as fallback; dates of deployment."""
    seq, kind = F.col("ingest_seq"), F.col("event_type")
    extract = _extract(t).withColumns({
        "current_workflow": F.when(seq % 7 > 1, F.col("current_workflow")), "role": F.when(seq % 2 == 0, F.lit("Trainee")).otherwise(F.lit("Analyst")),
        "cluster": F.when(seq % 5 > 2, kind), "workflow": F.when(seq % 3 > 0, kind),
    })
    key = F.col("c_custkey")
    trainees = t.customer.where(key % 3 > 0).select(
        key.alias("EID"), F.expr(_TRAINEE_FLOW).alias("Training FLOW"), F.col("c_mktsegment").alias("Market"))

    def some_day(first: dt.date) -> Column:
        return F.date_add(F.lit(first), (key % 300).cast("int")).cast("string")

    deployment = t.customer.select(
        key.alias("EID"), F.when(key % 4 > 0, some_day(dt.date(2023, 1, 1))).otherwise(F.lit(R.NO_DEPLOYMENT)).alias("OpsDeploymentDate"),
        F.when(key % 2 == 0, some_day(dt.date(2023, 2, 1))).otherwise(F.lit(R.NO_GRADUATION)).alias("Graduation Date"),
        F.col("c_mktsegment").alias("DMR Status"),
    )
    inputs = roster.RosterInputs([extract], adjustments(t), _shrinkage(t), status_map(t), deployment, trainees)
    return _roster_shown(roster.build_roster_fact(inputs), "role", "cluster", "workflow", "OpsDeploymentDate", "Graduation_Date", "DMR Status")
