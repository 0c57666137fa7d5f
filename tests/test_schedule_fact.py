"""The whole schedule job on a small landed sheet, in every edition."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.checks import duplicate_keys
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule_fact as SF
from shiftloom.sources import schemas
from tests.conftest import plan, rows

START = dt.date(2024, 1, 6)  # a Saturday
SERIAL = (START - dt.date(1899, 12, 30)).days
DAYS = [START + dt.timedelta(days=i) for i in range(14)]
RUN = dt.date(2024, 1, 8)


def sheet_rows():
    """EID, NAME, roll-off serial, one code per day."""
    return [
        ("Ana", "n1", 0, "LLMMMMMLLMMMMM"),
        ("bob", "n2", SERIAL + 9, "MMMMMLLMMMMMLL"),
        ("cy", "n3", 0, ".TTTTLLMMMMM.L"),
        ("err", R.ERROR_MARKER, 0, "MMMMMMMMMMMMMM"),
    ]


def land(spark, path, data):
    static = {"ROLE": "Trainee", "SRT ID": "12.0", "WAVE": "1", "STATUS": "Active", "LOB": "CO - GTM", "SLOB": "GTM", "MARKET": "pt"}
    out = []
    for eid, name, off, codes in data:
        row = [eid if c == "EID" else name if c == "NAME" else 45000 if c == "ROLL IN DATE" else off if c == "ROLL OFF DATE"
               else static.get(c, "x") for c in schemas.SHEET_STATIC]
        out.append((*row, *[{".": None, "L": "L1"}.get(c, c) for c in codes], "noise", "noise"))
    headers = [str(SERIAL + i) for i in range(14)]
    schema = schemas.sheet([*headers, "WW1", "Aux"])
    spark.createDataFrame(out, schema).write.parquet(path)
    return spark.read.parquet(path)


def roster(spark):
    """Roster rows on three days only; the rest is carried."""
    data = []
    for eid in ("ana", "bob", "cy"):
        for i in (0, 4, 8):
            role = "Trainee" if eid == "cy" else "Analyst"
            data.append((eid, DAYS[i], role, "Active", "CO - GTM", "GTM", "pt", "lead", "ops", "skill", "non-billable",
                         "Abs" if i == 4 else "Work", 0.5 if i == 4 else None, dt.date(2024, 1, 9), dt.date(2024, 1, 12)))
    cols = ("enterprise_id string, roster_date date, role string, employee_status string, workflow string, current_workflow string, "
            "cluster string, team_lead string, ops_lead_eid string, skills string, billable string, rta_status string, srtf_total_hrs double, "
            "OpsDeploymentDate date, Graduation_Date date")
    df = spark.createDataFrame(data, cols)
    texts = ["iw_highlevel_status", "iw_attendance_status", "status_final_AL", "rta_status_code", "WH"]
    return df.withColumns({**{c: F.lit(None).cast("string") for c in texts},
                           "srtf_completed_time": F.lit(0.0), "iw_actual_time": F.lit(0.0)})


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    sheet = land(spark, str(tmp_path_factory.mktemp("sheet") / "s"), sheet_rows())
    listed = str(tmp_path_factory.mktemp("codes") / "c")
    spark.createDataFrame([("MF", c, "") for c in ("M", "T", "L1", "V")], schemas.CODES).write.parquet(listed)
    codes = spark.read.parquet(listed)  # a file, whose size Spark knows
    exits = spark.createDataFrame([("ana", str(SERIAL + 7)), ("ana", str(SERIAL + 3)), ("bob", "9/16/2023")], schemas.EXITS)
    exits = exits.withColumn("ingest_seq", F.monotonically_increasing_id())
    log = spark.createDataFrame(
        [("bob", "Market", "pt", "es", DAYS[3], None), ("bob", "SLOB", "GTM", "IDVAAS", DAYS[5], None),
         ("bob", "Role", "Analyst", "Coach", DAYS[9], None), ("cy", "PBU", "x", "CUSTOMER_SUPPORT", DAYS[10], None),
         ("bob", "Market", "pt", "old", dt.date(2023, 1, 1), None)], schemas.CHANGE_LOG)
    tickets = spark.createDataFrame(
        [(1, "bob@" + "." * 16 + "7#cy", "Consider in Forecast", "Absenteeism", DAYS[0], DAYS[1], None, None, None, None),
         (2, "cy", "Consider in Forecast", "Movement", None, None, None, DAYS[11], "Messenger", "mk"),
         (3, "bob", "Reject", "LOA", DAYS[2], DAYS[12], None, None, None, None)], schemas.TICKETS)
    cross = spark.createDataFrame([("COMMUNITY_OPS", "OBJECTS/IGPR", "ana", DAYS[5])], schemas.CROSS_SKILLING)
    early = spark.createDataFrame([("cy", DAYS[12])], schemas.EARLY_EXITS)
    daily = spark.createDataFrame([("ana", DAYS[1], "Work", "Work", "W")],
                                  "User_Name_daily string, Date_daily date, status_final string, status_daily string, status_code_daily string")
    cross, log, early = (df.withColumn("ingest_seq", F.monotonically_increasing_id()) for df in (cross, log, early))
    return SF.ScheduleInputs(sheet, codes, roster(spark), exits, early, tickets, cross, log, daily, noise=["Aux"])


@pytest.fixture(scope="module")
def main(inputs):
    fact = SF.build_schedule_fact(inputs, RUN, "main")
    return {(r["EID"], r["date"]): r for r in fact.collect()}


def col(fact, eid, name):
    return [fact[eid, d][name] for d in DAYS]


@pytest.mark.parametrize("variant", list(SF.VARIANTS))
def test_every_edition_has_its_columns_and_all_days(inputs, variant):
    fact = SF.build_schedule_fact(inputs, RUN, variant)
    assert fact.columns == SF.VARIANTS[variant].columns
    assert fact.count() == 3 * 14 and fact.transform(duplicate_keys(["EID", "date"])).count() == 0


def test_edition_columns():
    assert len(R.FACT_COLUMNS) == 43
    assert "tenure" in SF.VARIANTS["wfh"].columns and "ABS_FCST" not in SF.VARIANTS["2022"].columns
    assert "unplanned_abs" in SF.VARIANTS["2024"].columns and SF.VARIANTS["2024_wfh"].columns[-1] == "ABS_FCST"


def test_2024_editions_leave_exits_alone(inputs):
    fact = {(r["EID"], r["date"]): r for r in SF.build_schedule_fact(inputs, RUN, "2024").collect()}
    assert col(fact, "ana", "value")[7:] == ["L1", "L1", "M", "M", "M", "M", "M"]
    assert col(fact, "cy", "value")[13] == "-"  # early exits count


def test_a_feed_without_order_is_an_error(inputs):
    for feed in ("exits", "early_exits", "cross_skilling", "change_log"):
        bare = replace(inputs, **{feed: getattr(inputs, feed).drop("ingest_seq")})
        with pytest.raises(ValueError, match="ingest_seq"):
            SF.build_schedule_fact(bare, RUN, "main")


def test_wide_sheets_keep_every_day(spark, tmp_path):
    headers = [str(SERIAL + i) for i in range(500)]
    row = ["x" if t == "s" else 1 for t in schemas.SHEET_STATIC.values()] + ["M"] * 500
    spark.createDataFrame([row], schemas.sheet(headers)).write.parquet(str(tmp_path / "s"))
    sheet = spark.read.parquet(str(tmp_path / "s"))
    assert SF.unpivot_sheet(sheet).select("date").distinct().count() == 500
    assert SF.unpivot_sheet(sheet, width=395).count() == 395 - 17


@pytest.mark.parametrize("partitions", [1, 3])
def test_repeated_roster_days_change_nothing_by_their_place(inputs, main, partitions):
    again = inputs.roster.withColumns({"role": F.lit("Zz"), "ingest_seq": F.lit(2)})
    first = inputs.roster.withColumn("ingest_seq", F.lit(1))
    want = {k: r.asDict() for k, r in main.items()}
    for stacked in (first.unionByName(again), again.unionByName(first)):
        fact = SF.build_schedule_fact(replace(inputs, roster=stacked.repartition(partitions)), RUN, "main")
        assert {(r["EID"], r["date"]): r.asDict() for r in fact.collect()} == want


def test_exit_blanks_later_days_and_is_marked(main):
    assert col(main, "ana", "value")[7:] == ["L1"] + ["-"] * 6
    assert [d for d, m in zip(DAYS, col(main, "ana", "roll_off/reassignment")) if m] == [DAYS[7]]
    assert col(main, "cy", "value")[13] == "-"  # early exit


def test_roll_off(main):
    assert col(main, "bob", "STATUS") == ["Active"] * 10 + ["Rolled-Off"] * 4
    assert main["bob", DAYS[9]]["roll_off/reassignment"] == "roll_off"
    assert main["bob", DAYS[0]]["ROLL OFF DATE"] == "01/15/2024" and main["ana", DAYS[0]]["ROLL OFF DATE"] == "01/01/1900"


def test_promotions(main):
    # first working code of cy is on day 7
    assert col(main, "cy", "ROLE") == ["Trainee"] * 7 + ["Analyst"] * 7
    assert col(main, "cy", "billable") == ["non-billable"] * 7 + ["billable"] * 7


def test_changes(main):
    assert col(main, "bob", "MARKET") == ["PT"] * 3 + ["ES"] * 11
    assert col(main, "bob", "SLOB") == ["GTM"] * 5 + ["IDVAAS"] * 9
    assert col(main, "bob", "LOB") == ["CO - GTM"] * 5 + ["CO - Graph Integrity"] * 9
    assert col(main, "bob", "ROLE") == ["Analyst"] * 9 + ["Coach"] * 5
    assert main["bob", DAYS[8]]["role_change"] == "Analyst to Coach"
    assert main["bob", DAYS[2]]["cross_change"] == "CO_GTM_pt to CO_GTM_es"
    assert sum(c is not None for c in col(main, "bob", "cross_change")) == 2
    # cross-skilling of ana counts from the day after its end; movement of cy
    assert col(main, "ana", "SLOB") == ["GTM"] * 6 + ["Objects/IGPR"] * 8
    # unit change of cy to customer support from day 10 fixes the flow, and the units are merged in the end
    assert col(main, "cy", "SLOB")[9:] == ["GTM"] + ["IDVAAS"] * 4
    assert set(col(main, "cy", "PBU")) == {"COMMUNITY_OPS"} and col(main, "cy", "MARKET")[11] == "MK"


def test_forecast_and_absence(main):
    assert col(main, "bob", "ABS_FCST") == [1, 1] + [0] * 12
    assert col(main, "cy", "ABS_FCST") == [1, 1] + [0] * 12
    assert main["ana", DAYS[4]]["ABS"] == 1 and main["ana", DAYS[3]]["ABS"] == 0


def test_flags_shift_and_week(main):
    assert main["cy", DAYS[0]]["value"] == "-" and main["cy", DAYS[0]]["Schedule"] == 0
    assert main["bob", DAYS[0]]["shift"] == "Morning" and main["bob", DAYS[0]]["week_ending"] == DAYS[6]
    assert col(main, "bob", "WSC")[:7] == [1, 1, 1, 1, 1, 0, 0]
    assert main["ana", DAYS[1]]["rta_status"] == "Work" and main["ana", DAYS[2]]["rta_status"] is None
    assert main["ana", DAYS[0]]["SRT ID"] == "#12" and main["ana", DAYS[0]]["ROLL IN DATE"] == "03/15/2023"


def test_legacy_null_cells(inputs):
    fact = SF.build_schedule_fact(inputs, RUN, "main", null_cells="legacy")
    r = fact.where((F.col("EID") == "cy") & (F.col("date") == F.lit(DAYS[0]))).first()
    assert (r["value"], r["Schedule"], r["WD"], r["LOA"], r["PTO"], r["Leave"]) == ("-", 1, 1, 1, 1, 0)


def test_tenure_edition(inputs):
    fact = SF.build_schedule_fact(inputs, RUN, "wfh").where("EID = 'bob'").orderBy("date")
    assert [r["tenure"] for r in fact.collect()] == ["Trainee"] * 3 + ["DMR"] * 3 + ["Tenured"] * 8


def test_sheet_edition_promotes_every_trainee(inputs):
    fact = SF.build_schedule_fact(inputs, RUN, "2024")
    assert {r["ROLE"] for r in fact.select("ROLE").distinct().collect()} == {"Analyst"}
    assert fact.where("rta_status IS NOT NULL").count() == 0


def test_missing_feeds_change_nothing(spark, inputs):
    bare = SF.ScheduleInputs(inputs.sheet, inputs.codes, inputs.roster, noise=["Aux"])
    empty = SF.ScheduleInputs(
        inputs.sheet, inputs.codes, inputs.roster, inputs.exits.limit(0), inputs.early_exits.limit(0), inputs.tickets.limit(0),
        inputs.cross_skilling.limit(0), inputs.change_log.limit(0), inputs.daily.limit(0), noise=["Aux"])
    a, b = (SF.build_schedule_fact(i, RUN, "main") for i in (bare, empty))
    assert rows(a, "EID", "date") == rows(b, "EID", "date")
    with pytest.raises(ValueError):
        SF.build_schedule_fact(SF.ScheduleInputs(inputs.sheet, inputs.codes), RUN, "main")


def test_repeated_sheet_rows_stay_and_are_reported(spark, inputs, tmp_path):
    twice = land(spark, str(tmp_path / "s"), [*sheet_rows()[:1], *sheet_rows()[:1]])
    fact = SF.build_schedule_fact(SF.ScheduleInputs(twice, inputs.codes, inputs.roster, noise=["Aux"]), RUN, "main")
    assert fact.count() == 28 and fact.transform(duplicate_keys(["EID", "date"])).count() == 14


def test_fact_is_shuffled_twice_at_most(spark, inputs):
    """By (entity, day) for the joins, by timeline for all windows; once if joins broadcast."""
    text = plan(SF.build_schedule_fact(inputs, RUN, "main"))
    by_line = [x for x in text.splitlines() if "Exchange hashpartitioning(EID" in x and "__row" in x]
    assert len(by_line) == 1 and text.count("+- Window") >= 6
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(SF.build_schedule_fact(inputs, RUN, "2022"))
        keys = [x.split("hashpartitioning(")[1] for x in text.splitlines() if "Exchange hashpartitioning(EID" in x]
        assert sum("__slice" in k for k in keys) == 2  # fact and roster
        # once more after the code list, which may not be broadcast here either
        assert sum("__row" in k for k in keys) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
