"""Feed jobs and the snapshot."""

import datetime as dt

from pyspark.sql import functions as F

from shiftloom.operators.checks import duplicate_keys
from shiftloom.plans import feeds
from shiftloom.plans.snapshot import snapshot_fact
from shiftloom.sources import schemas
from tests.conftest import rows

RUN = dt.date(2024, 1, 15)


def extract(spark):
    def shift(user, hour, event, updated, system):
        start = f"2024-01-15 {hour:02d}:00:00"
        return (user, "2024-01-15", system, event, updated, start)

    data = [shift("a", 9, "Leave", "Work", "Abs"), shift("b", 10, None, "Work", "Abs"), shift("c", 11, None, None, "Abs"), shift("d", 8, None, None, "Abs")]
    df = spark.createDataFrame(data, "`User Name` string, Date string, `System Generated Status` string, `Event Name` string, `Updated Status` string, `Shift Start` string")
    return df.withColumn("Shift Start", F.to_timestamp("Shift Start")).withColumn("Date", F.col("Date").cast("date"))


def test_daily_extract(spark):
    smap = spark.createDataFrame([("Work", "Work", "W", "h", "WK")], schemas.STATUS_MAP)
    got = feeds.daily_extract(extract(spark), smap, RUN, hours=10)
    assert rows(got.select("User_Name_daily", "status_final", "status_daily", "WH Code_daily")) == [
        ("a", "Leave", None, None), ("b", "Work", "Work", "WK"), ("d", "Abs", None, None)]
    assert dict(got.dtypes)["Shift_Start"] == "timestamp_ntz" and "Date_daily" in got.columns
    assert feeds.daily_extract(extract(spark), smap, RUN, 10, "yesterday").count() == 0


def test_compiled_attendance(spark):
    shift = feeds.shift_attendance(extract(spark), RUN, hours=15)
    assert rows(shift)[0] == ("a", RUN, "Leave")
    old = spark.createDataFrame([("a", RUN, "Leave"), ("a", RUN, "Leave"), ("a", RUN, None), ("z", RUN, None)], schemas.ATTENDANCE_FEED)
    df = feeds.attendance_compile(old, old.limit(0), shift)
    assert df.columns == ["Username", "Date", "Status Final"] and df.count() == 6
    assert rows(df.transform(duplicate_keys(["Username", "Date"]))) == [("a", "01/15/2024", 2)]


def test_billed_hours(spark):
    data = {c: "x" for c in schemas.BILLED_HOURS_COLUMNS} | {
        "Work City": "Dublin,Ireland", "SRT ID": "#12", "Staffing Market": "pt", "Week Ending": "12/29/2023",
        "Transaction Date": "2023-12-27", "Non-SRT Production": "-", "Onboarding": "1.5", "unused": "u"}
    df = spark.createDataFrame([tuple(data.values())], ", ".join(f"`{c}` string" for c in data))
    r = df.transform(feeds.conform_billed_hours(schemas.BILLED_HOURS_COLUMNS)).first().asDict()
    assert (r["Work City"], r["SRT ID"], r["Staffing Market"]) == ("Dublin, Ireland", "12", "PT")
    assert (r["Week Ending"], r["Week Ending Str"], r["Date"]) == ("12-29-2023", "12-29-2023", "12-27-2023")
    assert (r["Non-SRT Production"], r["Onboarding"]) == (None, 1.5) and "unused" not in r
    assert {"Enterprise ID", "Available", "Non-FB Learning", "business unit"} <= set(r)


def test_timestamps(spark):
    cols = ["Transaction Date", "SRT ID", "Assigned To", "Business", "Time Elapsed (Active)", "Non-FB - Learning", "Day - Onboarding", "Total Hours", "later"]
    df = spark.createDataFrame([("12-23-2023", "#7", "e", "b", "1", "2", "3", "4", "5")], ", ".join(f"`{c}` string" for c in cols))
    got = df.transform(feeds.conform_timestamps())
    r = got.first().asDict()
    assert r["week_ending"] == dt.date(2023, 12, 29) and r["week_ending_str"] == "12-29-2023" and r["date_str"] == "12-23-2023"
    assert (r["srt_id"], r["enterprise_id"], r["available"], r["day_onboarding"]) == ("7", "e", "1", 3.0)
    assert "later" not in got.columns and dict(got.dtypes)["non-fb_learning"] == "double"


def test_weekly_roster(spark):
    data = {c: "x" for c in schemas.WEEKLY_ROSTER_COLUMNS} | {
        "SRT ID": "120.0", "Role": "Reviewer", "Team Lead EID": "Lead.A", "Resource Name": "A%26B", "SRT Name": "N0"}
    df = spark.createDataFrame([tuple(data.values())], ", ".join(f"`{c}` string" for c in data))
    got = df.transform(feeds.conform_weekly_roster("12-15-2023"))
    r = got.first().asDict()
    assert got.columns[:1] == ["Program"] and got.columns[7:9] == ["SOW", "Phase"] and got.columns[19] == "OJT Start Date"
    assert r["Program"] == "COMMUNITY_OPS "  # the trailing space belongs to the name
    assert (r["SRT ID"], r["Role"], r["Team Lead EID"], r["Resource Name"], r["SRT Name"]) == ("120", "Analyst", "lead.a", "A & B", "NNA")
    assert r["Roster Week Index"] == "12-15-2023" and {"Local Team Name", "Market / Base Area / Pillar"} <= set(r)
    odd = df.withColumn("SRT ID", F.lit("123"))
    assert odd.transform(feeds.conform_weekly_roster("w")).first()["SRT ID"] == "123"
    assert odd.transform(feeds.conform_weekly_roster("w", exact_suffix=False)).first()["SRT ID"] == "1"


def test_snapshot(spark):
    d = [dt.date(2024, 1, n) for n in (1, 2, 3)]
    df = spark.createDataFrame(
        [("e", d[0], "#120.0", 0, "h", "non-billable"), ("e", d[1], "#120.0", 0, None, "billable"), ("e", d[2], "#120.0", 1, "h", "billable"), ("f", d[0], "#1", 0, "h", None)],
        "EID string, date date, `SRT ID` string, ABS int, iw_highlevel_status string, billable string").withColumn("roll_off/x", F.lit(1))
    got = df.transform(snapshot_fact(RUN, dt.date(2023, 12, 29)))
    assert {"SRT_ID", "roll_off_x"} <= set(got.columns)
    assert rows(got.select("EID", "date_str", "date", "SRT_ID", "ABS_aux", "first_bill_day")) == [
        ("e", "2024-01-01", "01-01-2024", "#12", 1, None), ("e", "2024-01-02", "01-02-2024", "#12", 0, d[1]),
        ("e", "2024-01-03", "01-03-2024", "#12", 0, None), ("f", "2024-01-01", "01-01-2024", "#1", 1, None)]
    assert got.first()["mfdate"] == dt.date(2023, 12, 29) and got.first()["creation_date"] == RUN
