"""Rule tables of the schedule domain.

Fixed values: all names, codes and patterns below are given by the schedules and
feeds and must be met exactly.
"""

from __future__ import annotations

import datetime as dt

# -- schedule codes ----------------------------------------------------------
CODE_SHEETS = ["MF/WH", "MF"]
DAY_OFF_CODES = ["L1", "L2"]
OFF_CODES = ["L1", "L2", "-"]
VACATION_CODES = ["COM", "COM(s)", "COE", "CON"]
# (test, argument, group), first match decides, otherwise Work
CODE_RULES = [
    ("in", DAY_OFF_CODES, "Day Off"),
    ("ends", "1", "LOA"),
    ("starts", "V", "Vacation"),
    ("in", ["T"], "Trainees"),
    ("in", VACATION_CODES, "Vacation"),
    ("ends", "ct", "LOA"),
    ("ends", "fa", "LOA"),
    ("ends", "mpl", "LOA"),
    ("ends", "2", "LOA"),
    ("ends", "t", "LOA"),
    ("ends", "wri", "LOA"),
    ("ends", "ml", "LOA"),
]
NUMBERED_LEAVE = ["3", "4", "5", "6", "9"]  # further endings of the current rule set
CODE_RULESETS = {
    "short": CODE_RULES,
    "full": CODE_RULES + [("ends", n, "LOA") for n in NUMBERED_LEAVE],
}
DEFAULT_GROUP = "Work"

# (test, part, shift), first match decides, otherwise "-"
SHIFT_RULES = [("E", "Evening"), ("N", "Night"), ("M(s)", "Middle"), ("M", "Morning")]
NO_SHIFT = "-"

VACANCY_CODE = [("V0", "-")]
CODE_SPELLING_2024 = [("VOM2", "OM2")]

# -- business unit and line of business --------------------------------------
CUSTOMER_LOB = "CO - Customer Support"
CUSTOMER_UNIT = "CUSTOMER_SUPPORT"
COMMUNITY_UNIT = "COMMUNITY_OPS"
COMMUNITY_PREFIX = "CO -"
COMMUNITY_LOBS = ["Non-Rec", "CO - Non-Rec"]

COMMUNITY_FLOWS = {
    "Messenger": "CO - Content Moderation",
    "Content Moderation": "CO - Content Moderation",
    "Objects/IGPR": "CO - Content Moderation",
    "MISREPRESENTATION": "CO - Graph Integrity",
    "IDVAAS": "CO - Graph Integrity",
    "Non-Rec": "CO - Non-Rec",
    "GTM": "CO - GTM",
}
# flows of the trainee list, which is spelled in two ways
TRAINEE_FLOWS = {
    **COMMUNITY_FLOWS,
    "OBJECTS/IGPR": "CO - Content Moderation",
    "MESSENGER": "CO - Content Moderation",
}
FLOW_SPELLING = [("OBJECTS/IGPR", "Objects/IGPR"), ("MESSENGER", "Messenger")]
LERT = "LERT"
CUSTOMER_FLOW = "IDVAAS"
SUPPORT_FLOWS = ["Policy", "Training"]
SUPPORT_LOB = "CO - PTQ"
HESITANCY_MARKET, HESITANCY_LOB = "PDO_VACCINE_HESITANCY", "CO - Vaccine Hesitancy"
ITALIAN_MARKET, ITALIAN_LOB, ITALIAN_FLOW = "GTM_ITALIAN", "CO - GTM", "GTM"

UNIT_MERGE_DATE = dt.date(2023, 10, 28)
MERGED_LOB = "CO - Graph Integrity"

WORKFLOW_FAMILIES = {
    "IGPR/Objects": "Objects/IGPR",
    "Object": "Objects/IGPR",
    "Misrepresentation": "MISREPRESENTATION",
    "InstagramProfile": "MISREPRESENTATION",
    "PrivateImpersonation": "MISREPRESENTATION",
    "IDRA": "IDVAAS",
    "INA": "IDVAAS",
    "IG Access": "IDVAAS",
    "FNRP": "IDVAAS",
    "IDReview": "IDVAAS",
    "NamesReview": "IDVAAS",
}

CHANGE_ABBREVIATIONS = [
    ("CUSTOMER_SUPPORT", "CS"),
    ("COMMUNITY_OPS", "CO"),
    ("MISREPRESENTATION", "MISREP"),
    ("Content Moderation", "CM"),
]

# -- statuses ----------------------------------------------------------------
SICK_LEAVE = "1B - SICK LEAVE"
STATUS_COMMA = [(",", " -")]
STATUS_TWELVE = [("12-", "12 -")]
NO_DEPLOYMENT, NO_GRADUATION = "00:00:00", "Rolled-off"
LONG_TENURE_SERIAL = 44927
TRAINING_DAYS = 19
WORKED_THRESHOLD = 0.33

# -- feeds -------------------------------------------------------------------
ERROR_MARKER = "0x2a"
ROSTER_ROLES = {"Reviewer": "Analyst", "Operation Team Lead": "Team Lead"}
PROGRAM = "CO"
PROGRAM_NAMES = [("CO", "COMMUNITY_OPS "), ("PDO", "PRODUCT_DATA_OPS ")]
ESCAPED_AND = ("%26", " & ")
CITY_SPELLING = ("Dublin,Ireland", "Dublin, Ireland")
ROSTER_RENAMES = {"Planning Group": "Market / Base Area / Pillar", "PBU": "Local Team Name"}
BILLED_RENAMES = {
    "Transaction Date": "Date",
    "Assigned To": "Enterprise ID",
    "Time Elapsed (Active)": "Available",
    "Non-FB  Learning": "Non-FB Learning",
    "Business": "business unit",
}
TIMESTAMP_RENAMES = {
    "Transaction_Date": "Date",
    "Assigned_To": "Enterprise_ID",
    "Time_Elapsed_(Active)": "Available",
    "Business": "business_unit",
}
TIMESTAMP_HOURS = ["non-srt_production", "onboarding", "day_onboarding", "night_onboarding", "non-fb_learning"]

# -- output of the schedule fact ----------------------------------------------
FACT_COLUMNS = [
    "EID", "ROLE", "NAME", "SRT ID", "WAVE", "STATUS", "ROLL IN DATE", "ROLL OFF DATE",
    "SUPERVISOR CURRENT", "OPS", "MARKET", "Flow Skills", "PBU", "SLOB", "LOB", "SupportRole",
    "SAP ID", "SHIFT BLOCK", "date", "value", "shift", "week_ending", "Schedule",
    "WD", "LOA", "PTO", "ABS", "Leave", "iw_highlevel_status", "iw_attendance_status",
    "status_final_AL", "rta_status", "rta_status_code", "srtf_total_hrs", "srtf_completed_time",
    "iw_actual_time", "WH", "WSC", "role_change", "cross_change", "roll_off/reassignment",
    "billable", "ABS_FCST",
]
