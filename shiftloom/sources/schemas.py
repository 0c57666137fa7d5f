"""Schemas of the feeds. Readers take them as given; nothing is inferred.

Fixed values: the column names are those the feeds are delivered with.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(),
    "D": T.DateType(), "t": T.TimestampType(), "n": T.TimestampNTZType(),
}


def schema(**columns: str) -> T.StructType:
    """``schema(name='s', day='D')`` with one type letter per column."""
    return T.StructType([T.StructField(c, _TYPES[t]) for c, t in columns.items()])


CODES = schema(indice="s", code="s", description="s")

ROSTER_EXTRACT = schema(
    enterprise_id="s", role="s", employee_status="s", skills="s", cluster="s", current_workflow="s", workflow="s",
    roster_date="D", billable="s", team_lead="s", ops_lead_eid="s", iw_highlevel_status="s",
    iw_attendance_status="s", iw_actual_time="d", srtf_total_hrs="d", srtf_completed_time="d", hc="i",
    srtf_adjustment_type="s", date="s", ts_total_hours="d", ts_completed_time="d",
)
WAREHOUSE_ROSTER = schema(
    srt_id="s", enterprise_id="s", role="s", employee_status="s", skills="s", cluster="s", workflow="s",
    current_workflow="s", team_lead="s", ops_lead_eid="s", roster_date="D", week_end_date_text="s",
    report_month="s", billable="s", city="s",
)
WAREHOUSE_ATTENDANCE = schema(
    highlevel_status="s", updated_status="s", attendance_status="s", srt_id="s", enterprise_id="s", shift_date="D",
    shift_status="s", system_status="s", date_txt="s", week_end_date_txt="s", report_month="s", actual_time_min="s",
)
WAREHOUSE_BILLED = schema(**{
    "enterprise id": "s", "date": "s", "total hours": "d", "completed time": "d", "hc": "i", "adjustment types": "s",
})
WAREHOUSE_TIMESTAMPS = schema(reporting_ds="s", work_city="s", actor_id="s", status="s", time_in_status_mins="s")
ATTENDANCE_FEED = schema(**{"Username": "s", "Date": "D", "Status Final": "s"})
SHRINKAGE = schema(**{"Username": "s", "Day": "D", "Status final": "s"})
STATUS_MAP = schema(**{"Status final": "s", "Status": "s", "Status_code": "s", "highlevel_m": "s", "WH Code": "s"})
DEPLOYMENT = schema(**{"EID": "s", "OpsDeploymentDate": "s", "Graduation Date": "s", "DMR Status": "s"})
SHIFT_EXTRACT = schema(**{
    "Primary Group": "s", "User Name": "s", "Primary Supervisor": "s", "Date": "D", "System Generated Status": "s",
    "Event Name": "s", "Updated Status": "s", "Shift Start": "t", "Shift End": "t", "First Check In": "n",
    "Last Check Out": "n", "Time Checked In (min)": "d", "Last Modified By": "s", "Last Modified At": "n",
})
CROSS_SKILLING = schema(**{"Business Unit": "s", "Training FLOW": "s", "EID": "s", "End date": "D"})
TRAINEES = schema(**{"Training FLOW": "s", "EID": "s", "Market": "s"})
EXITS = schema(**{"Enterprise ID": "s", "Employment End Date": "s"})
EARLY_EXITS = schema(e_id="s", exit_date="D")
CHANGE_LOG = schema(e_id="s", Change_Type="s", Old="s", New="s", Effective_Date="D", Until_Date="D")
TICKETS = schema(**{
    "ID": "l", "EID": "s", "Ticket decision": "s", "Forecasted Change": "s", "Start Date": "D", "End Date": "D",
    "Managed attrition DATE FORECASTED": "D", "Movement Effective Date": "D", "To Slob": "s", "To Market": "s",
})
SHEET_STATIC = {
    "EID": "s", "ROLE": "s", "NAME": "s", "SRT ID": "s", "WAVE": "s", "STATUS": "s", "ROLL IN DATE": "i",
    "ROLL OFF DATE": "i", "SUPERVISOR CURRENT": "s", "OPS": "s", "MARKET": "s", "Flow Skills": "s", "SLOB": "s",
    "LOB": "s", "SupportRole": "s", "SAP ID": "s", "SHIFT BLOCK": "s",
}


def sheet(day_headers: list[str]) -> T.StructType:
    """Schedule sheet: the static columns, then one text column per day."""
    return schema(**SHEET_STATIC, **{h: "s" for h in day_headers})


BILLED_HOURS_COLUMNS = [
    "Work City", "Week Ending", "Transaction Date", "Process", "Assigned To", "SRT ID", "Staffing Market", "Language",
    "Type", "Position", "Time Elapsed (Active)", "Breaks", "Coaching", "FB Learning", "Onboarding", "Meal",
    "Non-FB  Learning", "Meeting", "Well-being", "Non-SRT Production", "Completed Time", "Total Hours",
    "Adjustment Types", "Comment", "HC", "Business",
]
WEEKLY_ROSTER_COLUMNS = [
    "Location", "Enterprise ID", "Resource Name", "SRT ID", "SRT Name", "Role", "PBU", "Workflow",
    "Current Workflow", "Sub-Workflow", "Microflow", "Planning Group", "Language", "Team Lead EID",
    "Group Lead EID", "Roll Off Date", "Employee Status",
]
