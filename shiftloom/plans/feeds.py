"""Feed jobs: daily shift extract, compiled attendance, billed hours, timestamps, weekly roster."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators import filters, projection
from shiftloom.operators.joins import lookup
from shiftloom.operators.projection import q
from shiftloom.operators.sets import stack_distinct
from shiftloom.plans import rule_tables as R

FINAL_STATUS = ("Event_Name", "Updated_Status", "System_Generated_Status")
DAILY_MAP = {
    "Status": "status_daily",
    "Status_code": "status_code_daily",
    "highlevel_m": "highlevel_m_daily",
    "WH Code": "WH Code_daily",
}
FEED_DATE_FORMATS = ("MM-dd-yyyy", "M/d/yyyy", "yyyy-MM-dd")
TEXT_DAY = "MM-dd-yyyy"


def shift_final_status(status_map: DataFrame, run_date: dt.date, hours: int, day: str = "today",
                       start: str = "Shift_Start", cascade: Sequence[str] = FINAL_STATUS):
    """Shifts started by the cut-off, with event name, updated or system status, mapped."""
    return lambda df: (
        df.transform(filters.started_by(start, run_date, hours, day))
        .withColumns({start: dates.drop_zone(start), "status_final": rules.first_present(*cascade)})
        .transform(lookup(status_map, "status_final", "Status final", DAILY_MAP))
    )


def daily_extract(extract: DataFrame, status_map: DataFrame, run_date: dt.date, hours: int = 10,
                  day: str = "today") -> DataFrame:
    """The daily feed that fills statuses the roster does not have yet."""
    named = extract.transform(projection.normalize_headers([(" ", "_")]))
    out = named.transform(shift_final_status(status_map, run_date, hours, day))
    return out.transform(projection.rename({"User_Name": "User_Name_daily", "Date": "Date_daily"}))


def shift_attendance(extract: DataFrame, run_date: dt.date, hours: int = 15, day: str = "today") -> DataFrame:
    """Shift extract as (Username, Date, Status Final)."""
    started = extract.transform(filters.started_by("`Shift Start`", run_date, hours, day))
    return started.select(
        q("User Name").alias("Username"), q("Date").cast("date").alias("Date"),
        rules.first_present(q("Event Name"), q("Updated Status"), q("System Generated Status")).alias("Status Final"),
    )


def attendance_compile(*feeds: DataFrame) -> DataFrame:
    """All attendance feeds (Username, Date, Status Final), equal rows once, the day as text.

    Repeated keys are reported by ``checks.duplicate_keys(["Username", "Date"])``.
    """
    cols = ["Username", "Date", "Status Final"]
    same = [f.select(q("Username"), q("Date").cast("date").alias("Date"), q("Status Final")) for f in feeds]
    return stack_distinct(*same).withColumn("Date", dates.date_text("Date")).transform(projection.project(cols))


def conform_billed_hours(columns: Sequence[str] | None = None):
    """Billed-hours file: ids and cities spelled alike, days as text, hours as numbers."""

    def op(df: DataFrame) -> DataFrame:
        rows = df if columns is None else df.transform(projection.project(columns))
        wrong, right = R.CITY_SPELLING

        def day(c: str):
            return dates.date_text(dates.parse_any_date(q(c).cast("string"), FEED_DATE_FORMATS), TEXT_DAY)

        rows = rows.withColumns(
            {
                "Work City": text.regex_replace(q("Work City"), wrong, right),
                "SRT ID": text.regex_replace(q("SRT ID").cast("string"), "#", ""),
                "Staffing Market": F.upper(q("Staffing Market")),
                "Week Ending": day("Week Ending"),
                "Transaction Date": day("Transaction Date"),
                "Non-SRT Production": q("Non-SRT Production").try_cast("double"),
                "Onboarding": q("Onboarding").try_cast("double"),
            }
        )
        return rows.withColumn("Week Ending Str", q("Week Ending")).transform(projection.rename(R.BILLED_RENAMES))

    return op


def conform_timestamps(last: str = "Total Hours"):
    """Timestamp file: columns up to the total, week ending added, headers normalised."""

    def op(df: DataFrame) -> DataFrame:
        rows = df.transform(projection.column_ranges((None, last)))
        rows = rows.withColumn("Transaction Date", dates.parse_date(q("Transaction Date").cast("string"), TEXT_DAY))
        rows = rows.withColumn("Week Ending", dates.week_ending_friday(q("Transaction Date")))
        rows = rows.withColumns(
            {
                "week_ending_str": dates.date_text(q("Week Ending"), TEXT_DAY),
                "date_str": dates.date_text(q("Transaction Date"), TEXT_DAY),
            }
        ).transform(projection.normalize_headers())
        rows = rows.withColumn("SRT_ID", text.regex_replace(F.col("SRT_ID").cast("string"), "#", ""))
        rows = rows.transform(projection.rename(R.TIMESTAMP_RENAMES))
        rows = rows.toDF(*[c.lower() for c in rows.columns])
        hours = {c: "double" for c in R.TIMESTAMP_HOURS if c in rows.columns}
        return rows.withColumns({c: q(c).try_cast(t) for c, t in hours.items()})

    return op


def conform_weekly_roster(week: str, exact_suffix: bool = True):
    """Weekly roster in the target layout, stamped with its week.

    ``exact_suffix=False`` cuts the last two characters of the SRT ID whatever they are.
    """

    def op(df: DataFrame) -> DataFrame:
        rows = df.transform(projection.rename(R.ROSTER_RENAMES))
        rows = rows.transform(
            projection.insert_constants(
                [(0, "Program", R.PROGRAM), (7, "SOW", ""), (8, "Phase", ""), (19, "OJT Start Date", ""),
                 (None, "Date of Movement", ""), (None, "Resignation Date", "")]
            )
        )
        srt_id = q("SRT ID").cast("string")
        rows = rows.withColumns(
            {
                "SRT ID": text.strip_float_suffix(srt_id) if exact_suffix else text.drop_last(srt_id, 2),
                "Team Lead EID": F.lower(q("Team Lead EID")),
            }
        ).transform(projection.with_all_strings(lambda c: text.regex_replace(c, *R.ESCAPED_AND)))
        return rows.withColumns(
            {
                "Program": text.replace_chain("Program", R.PROGRAM_NAMES),
                "Roster Week Index": F.lit(week),
                "Roll Off Date": q("Roll Off Date").cast("string"),
                "Role": rules.value_map("Role", R.ROSTER_ROLES),
                "SRT Name": text.replace_chain(q("SRT Name"), [("0", "NA")]),
            }
        )

    return op
