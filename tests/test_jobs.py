"""Jobs end to end, from landed files to written outputs."""

import datetime as dt

from pyspark.sql import functions as F

from shiftloom import jobs
from shiftloom.plans import roster as RO
from shiftloom.sources import readers, schemas
from tests.conftest import rows
from tests.test_schedule_fact import RUN, inputs  # noqa: F401  (fixture)

RUN_DATE = dt.date(2024, 1, 15)
EXTRACT = (
    "Daily export\n"
    "Primary Group,User Name,Primary Supervisor,Date,System Generated Status,Event Name,Updated Status,Shift Start,Shift End,"
    "First Check In,Last Check Out,Time Checked In (min),Last Modified By,Last Modified At,Other\n"
    "g,a,s,2024-01-15,Abs,,Work,2024-01-15 09:00:00,,,,,,,x\n"
    "g,b,s,2024-01-15,Abs,,,2024-01-15 12:00:00,,,,,,,x\n"
)
MAP = "Status final,Status,Status_code,highlevel_m,WH Code\nWork,Work,W,h,WK\n"


def land(folder, name, content):
    (folder / name).write_text(content)
    return str(folder / name)


def test_daily_extract_and_attendance(spark, tmp_path):
    extract, smap = land(tmp_path, "e.csv", EXTRACT), land(tmp_path, "m.csv", MAP)
    latest, backup = str(tmp_path / "latest"), str(tmp_path / "backup")
    out = jobs.run_daily_extract(spark, extract, smap, RUN_DATE, latest, backup)
    assert rows(out.select("User_Name_daily", "status_final", "status_daily")) == [("a", "Work", "Work")]
    assert (tmp_path / "backup" / "run_date=2024-01-15").is_dir()
    feed = land(tmp_path, "c.csv", "Username,Date,Status Final\na,2024-01-15,Leave\na,2024-01-15,Work\n")
    doubled = jobs.run_attendance(spark, feed, feed, extract, RUN_DATE, str(tmp_path / "att"))
    assert rows(doubled) == [("a", "01/15/2024", 2)]
    assert readers.read_csv(spark, str(tmp_path / "att")).count() == 3
    # its own output is the next run's feed, dates and all
    jobs.run_attendance(spark, str(tmp_path / "att"), feed, extract, RUN_DATE, str(tmp_path / "next"))
    assert readers.read_csv(spark, str(tmp_path / "next")).where("Date IS NULL").count() == 0
    bad = land(tmp_path, "bad.csv", "Username,Date,Status Final\na,14.01.2024,Leave\n")
    assert rows(jobs.feed_misfits(spark, bad, schemas.ATTENDANCE_FEED)) == [("Date", 1)]


def test_formats_and_periods(spark, tmp_path):
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    assert jobs.files_of("roster/%Y-%m.csv", days) == ["roster/2024-01.csv", "roster/2024-02.csv"]
    spark.createDataFrame([("u", "x")], "Username string, other string").write.parquet(str(tmp_path / "folder"))
    assert rows(jobs.read_feed(spark, jobs.Feed(str(tmp_path / "folder"), "parquet"), jobs.texts("Username"))) == [("u",)]


def test_conformed_feeds(spark, tmp_path):
    billed = land(tmp_path, "b.csv", ",".join(schemas.BILLED_HOURS_COLUMNS) + ",x\n" + ",".join(["1"] * 27) + "\n")
    jobs.run_billed_hours(spark, billed, str(tmp_path / "billed"))
    weekly = land(tmp_path, "w.csv", ",".join(schemas.WEEKLY_ROSTER_COLUMNS) + "\n" + ",".join(["1"] * 17) + "\n")
    jobs.run_weekly_roster(spark, [weekly, weekly], "12-15-2023", str(tmp_path / "weekly"))
    stamps = land(tmp_path, "t.csv", "Transaction Date,SRT ID,Total Hours,x\n12-23-2023,#7,4,9\n")
    jobs.run_timestamps(spark, stamps, str(tmp_path / "stamps"))
    assert spark.read.parquet(str(tmp_path / "billed")).columns[-1] == "Week Ending Str"
    assert spark.read.parquet(str(tmp_path / "weekly")).count() == 2
    assert rows(spark.read.parquet(str(tmp_path / "stamps")).select("week_ending", "srt_id")) == [(dt.date(2023, 12, 29), "7")]


def test_roster_job(spark, tmp_path):
    line = {c: "" for c in schemas.ROSTER_EXTRACT.names} | {"enterprise_id": "a", "roster_date": "2024-01-05", "iw_attendance_status": "Work", "hc": "1", "srtf_total_hrs": "7"}
    text = ",".join(line) + "\n" + ",".join(line.values()) + "\n"
    paths = [land(tmp_path, f"r{i}.csv", text) for i in range(2)]
    extract = jobs.read_feed(spark, paths, schemas.ROSTER_EXTRACT).withColumn("ingest_seq", F.monotonically_increasing_id())
    empty = spark.createDataFrame([], schemas.ATTENDANCE_FEED)
    smap = jobs.read_feed(spark, land(tmp_path, "m.csv", MAP), schemas.STATUS_MAP)
    inp = RO.RosterInputs([extract], empty.withColumn("ingest_seq", F.lit(1)), RO.update_sheets(empty), smap)
    doubled = jobs.run_roster(spark, inp, RUN_DATE, str(tmp_path / "latest"), str(tmp_path / "backup"))
    assert doubled.count() == 0
    assert rows(spark.read.parquet(str(tmp_path / "backup")).select("enterprise_id", "srtf_total_hrs", "rta_status", "run_date")) == [("a", 7.0, "Work", RUN_DATE)]


def test_schedule_job(spark, inputs, tmp_path):  # noqa: F811
    paths = {k: str(tmp_path / k) for k in ("latest", "export", "snapshots")}
    report = jobs.run_schedule(spark, inputs, RUN, variant="wfh", file_date=dt.date(2024, 1, 3), excluded=["bob"], **paths)
    assert report.fact.count() == 42 and report.duplicates.count() == 0
    assert {r["value"] for r in report.codes.collect()} == {"-", "M", "L1", "T"}
    assert report.working_after_exit.count() == 0 or rows(report.working_after_exit) == [("ana",)]
    exported = readers.read_csv(spark, paths["export"])
    assert exported.columns == report.fact.columns and exported.count() == 42
    snap = spark.read.parquet(paths["snapshots"])
    assert snap.count() == 42 and {"SRT_ID", "roll_off_reassignment", "first_bill_day", "run_date"} <= set(snap.columns)
