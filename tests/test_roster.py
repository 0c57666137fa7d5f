"""Roster fact: hours, statuses, trainees, the warehouse query."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftloom.plans import roster as RO
from shiftloom.sources import schemas
from tests.conftest import rows

D = dt.date(2024, 1, 5)


def hours(spark, data):
    schema = "enterprise_id string, roster_date date, srtf_date string, hc int, srtf_total_hrs double, ts_total_hours double, ingest_seq int"
    df = spark.createDataFrame(data, schema)
    got = df.transform(RO.adjusted_hours(measures={"srtf_total_hrs": "ts_total_hours"}))
    return rows(got.select("enterprise_id", "srtf_date", "ingest_seq", "srtf_total_hrs"))


def test_adjustments_replace_hours_and_rows_are_deduplicated(spark):
    assert hours(spark, [("e", D, "a", 1, 8.0, None, 1), ("e", D, "a", -1, 2.0, None, 2)]) == [("e", "a", 1, 2.0)]
    # the total goes to every row of the key, also under another source day
    assert hours(spark, [("e", D, "a", 1, 8.0, None, 1), ("e", D, "b", -1, 2.0, None, 2)]) == [("e", "a", 1, 2.0), ("e", "b", 2, 2.0)]


def test_missing_headcount_counts_as_adjustment(spark):
    assert hours(spark, [("e", D, None, None, None, 7.5, 1)]) == [("e", None, 1, 7.5)]
    assert hours(spark, [("e", D, "a", 1, 0.0, 6.0, 1)]) == [("e", "a", 1, 6.0)]
    assert hours(spark, [(None, D, "a", None, 3.0, 6.0, 1)]) == [(None, "a", 1, 3.0)]


@pytest.mark.parametrize("raw, clean, legacy", [
    ("1A, LATE", "1A - LATE", "1A - LATE"), ("1B - SICK LEAVE\n", "1B - SICK LEAVE", "1B - SICK LEAVE"),
    ("1B - SICK LEAVE x", "1B - SICK LEAVE x", "1B - SICK LEAVE x"), ("12-TRAINING", "12 -TRAINING", "12 -TRAINING"),
    (None, None, "1B - SICK LEAVE")])
def test_status_text(spark, raw, clean, legacy):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(RO.clean_status("s"), RO.clean_status("s", legacy=True)).first() == (clean, legacy)


def test_status_cascade_and_map(spark):
    fact = spark.createDataFrame([("a", D, "Work"), ("b", D, "Leave, x"), ("c", D, None), ("d", D, "Work")],
                                 "enterprise_id string, roster_date date, iw_attendance_status string")
    adj = spark.createDataFrame([("a", D, "1A, LATE", 1), ("a", D, "12-X", 2), ("d", D, None, 1)], "Username string, Date date, `Status Final` string, ingest_seq int")
    sheets = spark.createDataFrame([("a", D, "no"), ("d", D, "Sheet, y")], schemas.ATTENDANCE_FEED)
    smap = spark.createDataFrame([("Leave - x", "Off", "O", "h", "LX"), ("Work", "Work", "W", "h", "WK")], schemas.STATUS_MAP)
    op = RO.resolve_status(RO.adjustment_list(adj, ["ingest_seq"]), RO.update_sheets(sheets), smap)
    got = fact.transform(op).select("enterprise_id", "status_final_AL", "iw_attendance_status", "rta_status")
    assert rows(got) == [("a", "12 -X", "Work", None), ("b", "Leave - x", "Leave - x", "Off"), ("c", None, None, None), ("d", "Sheet - y", "Work", None)]
    by_attendance = fact.transform(RO.resolve_status(
        RO.adjustment_list(adj, ["ingest_seq"]), RO.update_sheets(sheets), smap, map_key="iw_attendance_status"))
    assert rows(by_attendance.select("enterprise_id", "rta_status")) == [("a", "Work"), ("b", "Off"), ("c", None), ("d", "Work")]


def test_shrinkage_days_are_serials_or_dates(spark):
    serial = spark.createDataFrame([("u", 45296, "Work")], "Username string, Day int, `Status final` string")
    dated = spark.createDataFrame([("u", D, "Work")], schemas.SHRINKAGE)
    assert rows(RO.shrinkage_feed(serial)) == rows(RO.shrinkage_feed(dated)) == [("u", D, "Work")]


def test_deployment_sentinels(spark):
    df = spark.createDataFrame([("a", "2024-01-02", "Rolled-off", "x"), ("b", "00:00:00", "2024-02-01", "x"), ("c", "2024-01-03", "2024-02-01", "x")], schemas.DEPLOYMENT)
    assert rows(RO.deployment_dates(df).select("enterprise_id", "OpsDeploymentDate", "Graduation_Date")) == [
        ("a", dt.date(2024, 1, 2), None), ("c", dt.date(2024, 1, 3), dt.date(2024, 2, 1))]


def test_trainee_fill_only_where_missing(spark):
    people = spark.createDataFrame([("a", "Trainee", None, None, None), ("b", "Trainee", "kept", None, "kept"), ("c", "Analyst", None, None, None)],
                                   "enterprise_id string, role string, current_workflow string, cluster string, workflow string")
    listed = spark.createDataFrame([("OBJECTS/IGPR", "a", "pt"), ("Policy", "b", "es"), ("GTM", "c", "es")], schemas.TRAINEES)
    assert rows(people.transform(RO.trainee_fill(listed))) == [
        ("a", "Trainee", "OBJECTS/IGPR", "pt", "CO - Content Moderation"), ("b", "Trainee", "kept", "es", "kept"), ("c", "Analyst", None, None, None)]


def extract(spark, names):
    data = [(n, "Analyst", "Active", "s", "pt", "IDRA", "CO", D, "billable", "l", "o", "h", "Work", 8.0, 7.0, 7.0, 1, None, "01-05-2024", 1.0, 1.0) for n in names]
    return spark.createDataFrame(data, schemas.ROSTER_EXTRACT).withColumn("ingest_seq", F.monotonically_increasing_id())


def test_roster_fact(spark):
    adj = spark.createDataFrame([], "Username string, Date date, `Status Final` string, ingest_seq bigint")
    none = spark.createDataFrame([], schemas.ATTENDANCE_FEED)
    smap = spark.createDataFrame([("Work", "Work", "W", "h", "WK")], schemas.STATUS_MAP)
    deployed = spark.createDataFrame([("a", "2024-01-02", "Rolled-off", "x")], schemas.DEPLOYMENT)
    inp = RO.RosterInputs([extract(spark, ["a"]), extract(spark, ["b"])], adj, RO.update_sheets(none), smap, deployment=deployed)
    got = RO.build_roster_fact(inp).select("enterprise_id", "current_workflow", "srtf_total_hrs", "rta_status", "WH", "OpsDeploymentDate", "srtf_date")
    assert rows(got) == [("a", "IDVAAS", 7.0, "Work", "8.0", dt.date(2024, 1, 2), "01-05-2024"), ("b", "IDVAAS", 7.0, "Work", "8.0", None, "01-05-2024")]


def test_warehouse_query_as_frames_and_as_sql(spark):
    week = "2024-01-05"
    people = [("s1", "a", *["x"] * 8, D, week, "2024-01", "billable", "in"), ("s2", "b", *["x"] * 8, D, week, "2024-01", "billable", "in"),
              ("s3", "c", *["x"] * 8, D, week, "2024-01", "billable", "out"), ("s4", "d", *["x"] * 8, D, "2024-01-12", "2024-01", "billable", "in")]
    tables = {
        "w_roster": spark.createDataFrame(people, schemas.WAREHOUSE_ROSTER),
        "w_attendance": spark.createDataFrame([("h", "u", "t", "s1", "a", D, "x", "x", "x", "x", "x", "90")], schemas.WAREHOUSE_ATTENDANCE),
        "w_billed": spark.createDataFrame([("a", "01-05-2024", 7.0, 8.0, 1, "none"), ("b", "garbage", 1.0, 1.0, 1, "none")], schemas.WAREHOUSE_BILLED),
        "w_timestamps": spark.createDataFrame(
            [(week, "in", "s1", "available", "60"), (week, "in", "s1", "available", "60"), (week, "in", "s1", "non-fb-training", "30"), (week, "out", "s1", "meal", "600")],
            schemas.WAREHOUSE_TIMESTAMPS),
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    args = dict(roster_city="in", work_city="in", week_ending=week)
    frames = RO.status_roster_fact(*tables.values(), **args)
    sql = RO.status_roster_tables(spark, roster="w_roster", attendance="w_attendance", billed="w_billed", timestamps="w_timestamps", **args)
    assert frames.columns == sql.columns and rows(frames) == rows(sql) and frames.count() == 2
    a = frames.where("enterprise_id = 'a'").first()
    assert (a["iw_actual_time"], a["srtf_total_hrs"], a["ts_total_hours"], a["ts_completed_time"]) == (1.5, 7.0, 1.0, 1.5)
    b = frames.where("enterprise_id = 'b'").first()
    assert (b["srtf_total_hrs"], b["ts_total_hours"]) == (None, None)
    every = RO.status_roster_fact(*tables.values(), **{**args, "week_ending": None})
    assert every.count() == 3
