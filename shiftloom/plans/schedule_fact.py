"""From a wide schedule sheet to the daily fact, as one lazy plan.

The rows of one sheet row are one timeline: its length is the number of day columns,
whatever the data. An entity that stands in several sheet rows (the duplicate check
reports it) has several timelines, so no key can grow beyond a calendar. All fills,
promotions, look-aheads and weekly sums share the partitioning by timeline. The fact is
shuffled at most twice: by (entity, day) for all joins, unless they are broadcast, and
by timeline.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators import filters, projection, reshape
from shiftloom.operators.joins import SLICE, hot_slices, repeat, row_counts, spread
from shiftloom.operators.overlays import EventFeed, attach_events, from_date_on, payload_of
from shiftloom.operators.projection import q
from shiftloom.operators.timeline import Timeline, keep_first
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule as S

ROW = "__row"
TICKET_HEADERS = projection.HEADER_PAIRS[:2]
LINE = Timeline(keys=["EID", ROW], order=["date"])

# fact column -> roster column, carried over days without a roster row
ROSTER_CARRIED = {
    "m_lob": "workflow",
    "m_flow": "current_workflow",
    "m_role": "role",
    "m_status": "employee_status",
    "m_market": "cluster",
    "m_lead": "team_lead",
    "m_ops": "ops_lead_eid",
    "m_skills": "skills",
    "m_billable": "billable",
}
# columns that hold for their own day only
ROSTER_DAILY = [
    "iw_highlevel_status", "iw_attendance_status", "status_final_AL", "rta_status", "rta_status_code",
    "srtf_total_hrs", "srtf_completed_time", "iw_actual_time", "WH",
]
ROSTER_TENURE = {"m_deployed": "OpsDeploymentDate", "m_graduated": "Graduation_Date"}
# fact column -> sheet column, where the sheet itself is the roster
SHEET_ATTRIBUTES = {
    "m_lob": "LOB", "m_flow": "SLOB", "m_role": "ROLE", "m_status": "STATUS", "m_market": "MARKET",
    "m_lead": "SUPERVISOR CURRENT", "m_ops": "OPS", "m_skills": "Flow Skills",
}
# fact column -> column of the daily feed
DAILY_FILLS = {"status_final_AL": "status_final", "rta_status": "status_daily", "rta_status_code": "status_code_daily"}
SHEET_KEPT = ["NAME", "SRT ID", "WAVE", "ROLL IN DATE", "ROLL OFF DATE", "SupportRole", "SAP ID", "SHIFT BLOCK"]
OUTPUT_NAMES = {
    "m_role": "ROLE", "m_status": "STATUS", "m_lead": "SUPERVISOR CURRENT", "m_ops": "OPS", "m_market": "MARKET",
    "m_skills": "Flow Skills", "m_flow": "SLOB", "m_lob": "LOB", "m_billable": "billable",
}


def _without(cols: Sequence[str], *gone: str) -> list[str]:
    return [c for c in cols if c not in gone]


def _columns_wfh() -> list[str]:
    cols = list(R.FACT_COLUMNS)
    cols.insert(cols.index("billable"), "tenure")
    return cols


def _columns_2022() -> list[str]:
    return _without(R.FACT_COLUMNS, "SupportRole", "SAP ID", "role_change", "cross_change",
                    "roll_off/reassignment", "ABS_FCST")


def _columns_2024(forecast: bool) -> list[str]:
    cols = _without(R.FACT_COLUMNS, "srtf_completed_time", "iw_actual_time", "WH", "billable", "ABS_FCST")
    at = cols.index("srtf_total_hrs")
    cols[at:at] = ["unplanned_abs", "planned_loa", "planned_pto", "scheduled_rta"]
    return cols + ["ABS_FCST"] if forecast else cols


@dataclass(frozen=True)
class Variant:
    """What differs between the editions of the job."""

    columns: list[str]
    absence: str
    roster: bool = True
    overlays: bool = True
    movement: bool = False
    tenure: bool = False
    billable: bool = True
    roll_off: bool = True
    change_texts: bool = True
    promote_all: bool = False
    changes: tuple[str, ...] = ("PBU", "SLOB", "Role", "Market")
    change_horizon: int | None = 7
    coefficient_default: float | None = 0.0
    daily: bool = False
    merge_units: bool = True
    merge_since: dt.date | None = R.UNIT_MERGE_DATE
    ruleset: str = "full"
    spelling: list[tuple[str, str]] = field(default_factory=list)
    exits: bool = True


_2024 = dict(
    absence="2024", roster=False, billable=False, roll_off=False, change_texts=False, promote_all=True,
    changes=("SLOB",), change_horizon=None, merge_since=None, spelling=R.CODE_SPELLING_2024, exits=False,
)
VARIANTS = {
    "main": Variant(R.FACT_COLUMNS, "main", movement=True, daily=True),
    "wfh": Variant(_columns_wfh(), "wfh", tenure=True, coefficient_default=None, ruleset="short"),
    "2022": Variant(_columns_2022(), "2022", overlays=False, billable=False, roll_off=False, change_texts=False,
                    merge_units=False, ruleset="short"),
    "2024": Variant(_columns_2024(False), **_2024),
    "2024_wfh": Variant(_columns_2024(True), **_2024),
}


@dataclass(frozen=True)
class ScheduleInputs:
    """Feeds of the job, with the column names they are delivered with.

    Feeds of which the first row of a key counts (exits, early exits, cross-skilling,
    change log) bring their order as ``ingest_seq``, as readers add it.
    """

    sheet: DataFrame
    codes: DataFrame
    roster: DataFrame | None = None
    exits: DataFrame | None = None
    early_exits: DataFrame | None = None
    tickets: DataFrame | None = None
    cross_skilling: DataFrame | None = None
    change_log: DataFrame | None = None
    daily: DataFrame | None = None
    noise: Sequence[str] = ()
    # columns of the sheet that count, from the left; all of them by default
    width: int | None = None


def unpivot_sheet(sheet: DataFrame, *, noise: Sequence[str] = (), width: int | None = None,
                  first: str = "EID", last: str = "SHIFT BLOCK") -> DataFrame:
    """Wide sheet to (entity, day) rows with the week ending; narrow all the way.

    The sheet must come from files or a written table: its row numbers are then the
    same again when a lost task is repeated.
    """
    wide = sheet.transform(filters.not_sentinel("NAME", R.ERROR_MARKER))
    wide = wide.transform(projection.drop_columns(noise)).transform(projection.drop_matching("WW"))
    if width is not None:
        wide = wide.transform(projection.keep_leading(width))
    ids = projection.columns_between(wide, first, last)
    days = [c for c in wide.columns if c not in ids]
    # texts of a person are made once per sheet row, not once per day
    wide = wide.withColumns(
        {
            "EID": F.lower(q("EID")),
            "SRT ID": text.strip_float_suffix(F.concat(F.lit("#"), q("SRT ID").cast("string"))),
            ROW: F.monotonically_increasing_id(),
        }
    )
    long = wide.transform(reshape.unpivot([*ids, ROW], days))
    return long.withColumn("date", dates.header_to_date("date")).withColumn("week_ending", dates.week_ending_friday("date"))


def forecast_tickets(tickets: DataFrame) -> DataFrame:
    """Tickets to be considered, one row per person."""
    named = tickets.transform(projection.normalize_headers(TICKET_HEADERS)).transform(projection.suffix_headers("_cf"))
    return named.where(F.col("Ticket_decision_cf") == "Consider in Forecast").transform(
        reshape.unnest_ids("EID_cf", "EID_cf")
    )


def exit_events(exits: DataFrame, run_date: dt.date) -> DataFrame:
    """First exit per person, if it is not long past."""
    serial = q("Employment End Date").cast("string").try_cast("double").cast("int")
    known = exits.select(
        q("Enterprise ID").alias("x_id"), dates.serial_to_date(serial).alias("x_end"),
        *_seq(exits),
    ).where(F.col("x_end").isNotNull())
    return known.transform(keep_first(["x_id"], _seq(known))).where(dates.after_horizon("x_end", run_date, 2))


def _seq(df: DataFrame) -> list[str]:
    """The order of a feed's rows; without one there is no first row to keep."""
    if "ingest_seq" not in df.columns:
        raise ValueError(f"a feed with columns {df.columns} has no ingest_seq")
    return ["ingest_seq"]


def event_feeds(inp: ScheduleInputs, v: Variant, run_date: dt.date) -> list[EventFeed]:
    """All dated events of the job in the form the overlays take."""
    feeds: list[EventFeed] = []
    if not v.overlays:
        return feeds
    if inp.cross_skilling is not None:
        cross = inp.cross_skilling.where(dates.after_horizon(q("End date"), run_date, 2)).withColumn(
            "__eff", F.date_add(q("End date"), 1)
        )
        feeds.append(EventFeed("ev_cross", cross, "EID", "__eff",
                               {"x_unit": "Business Unit", "x_flow": "Training FLOW", "x_eff": "__eff"}, _seq(cross)))
    if v.exits and inp.exits is not None:
        feeds.append(EventFeed("ev_exit", exit_events(inp.exits, run_date), "x_id", "x_end", {"exit_end": "x_end"}))
    if inp.early_exits is not None:
        early = inp.early_exits.where(dates.after_horizon("exit_date", run_date, 2))
        feeds.append(EventFeed("ev_early", early, "e_id", "exit_date", {"early_end": "exit_date"}, _seq(early)))
    if inp.tickets is not None:
        tickets = forecast_tickets(inp.tickets)

        def ticket(name: str, change: str, date: str, payload: dict[str, str]) -> EventFeed:
            return EventFeed(name, tickets, "EID_cf", date, payload, ["ID_cf"], f"Forecasted_Change_cf = '{change}'")

        leaver = "Managed_attrition_DATE_FORECASTED_cf"
        feeds += [
            ticket("ev_abs", "Absenteeism", "Start_Date_cf", {"abs_from": "Start_Date_cf", "abs_to": "End_Date_cf"}),
            ticket("ev_loa", "LOA", "Start_Date_cf", {"loa_from": "Start_Date_cf", "loa_to": "End_Date_cf"}),
            ticket("ev_attr", "Managed Attrition", leaver, {"attr_from": leaver}),
        ]
        if v.movement:
            moved = {"mv_eff": "Movement_Effective_Date_cf", "mv_flow": "To_Slob_cf", "mv_market": "To_Market_cf"}
            feeds.append(ticket("ev_move", "Movement", "Movement_Effective_Date_cf", moved))
    if inp.change_log is not None:
        log = inp.change_log
        if v.change_horizon is not None:
            log = log.where(dates.after_horizon("Effective_Date", run_date, v.change_horizon, inclusive=True))
        for t in v.changes:
            feeds.append(EventFeed(f"ev_ch_{t}", log, "e_id", "Effective_Date",
                                   {f"ch_{t}_eff": "Effective_Date", f"ch_{t}": "New"}, _seq(log),
                                   f"Change_Type = '{t}'"))
    return feeds


def _join_roster(df: DataFrame, roster: DataFrame, tenure: bool, hot: DataFrame) -> DataFrame:
    wanted = {**ROSTER_CARRIED, **(ROSTER_TENURE if tenure else {})}
    side = roster.selectExpr(
        "enterprise_id AS EID", "CAST(roster_date AS DATE) AS date",
        *[f"`{c}` AS {n}" for n, c in wanted.items()], *ROSTER_DAILY, *[c for c in roster.columns if c == "ingest_seq"],
    )
    return df.join(repeat(one_per_day(side, "EID", "date"), ["EID"], hot), ["EID", "date", SLICE], "left")


def _join_daily(df: DataFrame, daily: DataFrame, hot: DataFrame) -> DataFrame:
    """The late feed beside the roster; it is used only where the roster ends up without a status."""
    side = daily.selectExpr(
        "User_Name_daily AS EID", "CAST(Date_daily AS DATE) AS date",
        *[f"`{c}` AS __d_{n}" for n, c in DAILY_FILLS.items()], *[c for c in daily.columns if c == "ingest_seq"],
    )
    return df.join(repeat(one_per_day(side, "EID", "date"), ["EID"], hot), ["EID", "date", SLICE], "left")


def one_per_day(df: DataFrame, entity: str, day: str) -> DataFrame:
    """One row per person and day: the first one delivered, by all columns where no order is.

    A roster that repeats a day would make two rows of one, and of a timeline one that
    nothing bounds. :func:`~shiftloom.operators.checks.duplicate_keys` reports repeats.
    """
    order = ["ingest_seq"] if "ingest_seq" in df.columns else [q(c) for c in df.columns if c not in (entity, day)]
    return df.transform(keep_first([entity, day], order)).drop("ingest_seq")


def build_schedule_fact(inp: ScheduleInputs, run_date: dt.date, variant: str = "main",
                        null_cells: str = "off") -> DataFrame:
    """The daily schedule fact of one edition; see :data:`VARIANTS`."""
    v = VARIANTS[variant]
    mark = "roll_off/reassignment"
    df = unpivot_sheet(inp.sheet, noise=inp.noise, width=inp.width)
    if null_cells == "off":
        df = df.withColumn("value", F.coalesce(F.col("value"), F.lit(R.NO_SHIFT)))

    # All joins are on (EID, date, slice): one partitioning for them, one for the timelines.
    # An entity with very many sheet rows, such as a placeholder for vacancies, has slices.
    entities = inp.sheet.select(F.lower(q("EID")).alias("EID"))
    hot = hot_slices(row_counts(entities, ["EID"]), ["EID"])
    feeds = event_feeds(inp, v, run_date)
    if v.roster and inp.roster is None:
        raise ValueError(f"variant {variant!r} needs a roster")
    if v.roster:
        kept = [f"`{c}`" for c in SHEET_KEPT if c in df.columns]
        df = df.select("EID", ROW, *kept, "date", "week_ending", "value")
        df = _join_roster(spread(df, ["EID"], hot), inp.roster, v.tenure, hot)
    else:
        renamed = [f"`{c}` AS {n}" for n, c in SHEET_ATTRIBUTES.items()]
        df = df.selectExpr("EID", ROW, *[f"`{c}`" for c in SHEET_KEPT], "date", "week_ending", "value", *renamed)
        df = df.withColumns({c: F.lit(None).cast("double" if c.startswith(("srtf", "iw_actual")) else "string")
                             for c in [*ROSTER_DAILY, "m_billable"]})
    daily = v.daily and inp.daily is not None
    if daily:
        df = _join_daily(df, inp.daily, hot)
    if feeds:
        df = df if v.roster else spread(df, ["EID"], hot)
        df = df.transform(attach_events(feeds, "EID", "date", hot))
    df = df.drop(SLICE)

    # everything that is carried forward, in one window
    carried = {o: c for f in feeds for o, c in payload_of(f).items()}
    if v.roster:
        carried.update({c: c for c in ROSTER_CARRIED})
        carried.update({c: c for c in ROSTER_TENURE} if v.tenure else {})
    if carried:
        df = LINE.fill_forward(df, carried)
    has = {f.name for f in feeds}
    if "ev_ch_SLOB" in has:
        df = LINE.first_where(df, {"__flow_changed": (F.col("ev_ch_SLOB").isNotNull(), "date")})
    df = df.drop(*has).withColumn(mark, F.lit(None).cast("string"))

    # exits, spelling of codes
    if "ev_exit" in has:
        df = df.transform(S.apply_exit("value", mark, "date", "exit_end", "ROLL OFF DATE"))
    df = df.withColumn("value", text.replace_chain("value", R.VACANCY_CODE))
    if v.tenure:
        df = df.withColumn("tenure", S.tenure_class("date", "m_deployed", "m_graduated", "ROLL IN DATE", "m_status"))
        df = LINE.fill_forward(df, {"tenure": "tenure"})
    if "ev_early" in has:
        df = df.transform(S.apply_exit("value", mark, "date", "early_end"))
    df = df.withColumn("value", text.replace_chain("value", v.spelling))

    # forecasts and flags
    intervals = [(lo, hi) for name, lo, hi in
                 (("ev_abs", "abs_from", "abs_to"), ("ev_loa", "loa_from", "loa_to")) if name in has]
    df = df.transform(S.apply_forecasts("ABS_FCST", "value", "date", intervals, "attr_from" if "ev_attr" in has else None))
    codes = inp.codes.transform(S.classify_codes(v.ruleset))
    df = df.transform(S.code_groups_of(codes, "value", "__group"))
    df = df.withColumns(S.flag_columns("value", "__group", null_cells))
    df = df.withColumn("ABS", S.absence_flag(v.absence))
    df = df.withColumns(
        {
            "ROLL IN DATE": dates.serial_to_date(q("ROLL IN DATE")),
            "ROLL OFF DATE": dates.serial_or_sentinel(q("ROLL OFF DATE")),
            "value": F.coalesce(F.col("value"), F.lit(R.NO_SHIFT)),
        }
    )
    if v.roll_off:
        df = df.transform(S.roll_off_status("m_status", "date", "ROLL OFF DATE", mark))

    # promotions
    working = F.col("__group") == R.DEFAULT_GROUP
    df = df.transform(S.promote_trainees(LINE, "m_role", "date", working))
    if v.promote_all:
        df = df.withColumn("m_role", rules.override("m_role", F.col("m_role") == "Trainee", "Analyst"))
    if v.billable:
        df = df.transform(S.promote_billable(LINE, "m_role", "m_status", "m_billable", "date", working))

    # unit, flow, line of business, role, market
    df = df.withColumn("PBU", S.business_unit("m_lob"))
    if "ev_move" in has:
        df = df.transform(from_date_on("date", "mv_eff", "m_market", "mv_market"))
        df = df.transform(from_date_on("date", "mv_eff", "m_flow", "mv_flow"))
    if "ev_cross" in has:
        df = df.transform(S.apply_cross_skill("PBU", "m_flow", "date", "x_eff", "x_unit", "x_flow", run_date))
    elif v.overlays:
        df = df.withColumn("m_flow", text.replace_chain("m_flow", R.FLOW_SPELLING))
    if v.overlays:
        df = df.withColumn("m_lob", S.line_of_business("PBU", "m_flow", "m_lob"))
        targets = {"PBU": "PBU", "SLOB": "m_flow", "Role": "m_role", "Market": "m_market"}
        for t in ("PBU", "SLOB", "Role", "Market"):
            if f"ev_ch_{t}" in has:
                df = df.transform(from_date_on("date", f"ch_{t}_eff", targets[t], f"ch_{t}"))
            if t == "SLOB":
                changed = F.col("__flow_changed").isNotNull() if "ev_ch_SLOB" in has else F.lit(False)
                df = df.transform(S.settle_lob("PBU", "m_flow", "m_lob", changed))
        if "Market" in v.changes:
            df = df.transform(S.market_rules("m_market", "m_flow", "m_lob"))
    if v.change_texts:
        df = df.transform(S.attribute_change(LINE, "m_role", "PBU", "m_flow", "m_market"))
    if v.roster:
        df = df.withColumn("m_market", F.upper("m_market"))

    # week and shift
    df = df.transform(S.weekly_coefficient_in_place(LINE.keys, default=v.coefficient_default))
    df = df.withColumn("shift", S.shift_bucket("value"))

    if daily:
        df = df.withColumns({c: rules.first_present(c, f"__d_{c}") for c in DAILY_FILLS})
    if v.merge_units:
        df = df.transform(S.dated_override("PBU", "m_lob", since=v.merge_since))
    return _finish(df, v)


def _finish(df: DataFrame, v: Variant) -> DataFrame:
    """Output names, order and types."""
    if not v.roll_off:
        df = df.withColumn("roll_off/reassignment", F.lit(None).cast("string"))
    df = df.withColumns(
        {
            "ABS_FCST": F.coalesce(F.col("ABS_FCST"), F.lit(0)),
            "ROLL IN DATE": dates.date_text(q("ROLL IN DATE")),
            "ROLL OFF DATE": dates.date_text(q("ROLL OFF DATE")),
            "WAVE": q("WAVE").cast("string"),
        }
    ).withColumnsRenamed({k: n for k, n in OUTPUT_NAMES.items() if k in df.columns})
    missing = {c: "string" for c in v.columns if c not in df.columns}
    return df.transform(projection.add_missing(missing)).transform(projection.project(v.columns))


def export_edges(df: DataFrame, columns: Sequence[str] = ("date", "week_ending")) -> DataFrame:
    """Dates as ISO text for the CSV export."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
