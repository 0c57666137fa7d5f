"""Schedule rules: golden cases and both readings of null cells."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.timeline import Timeline
from shiftloom.plans import schedule as S
from tests.conftest import plan, rows

SATURDAY = dt.date(2023, 12, 23)


@pytest.mark.parametrize("code, group", [
    ("L1", "Day Off"), ("V1", "LOA"), ("V", "Vacation"), ("T", "Trainees"), ("COE", "Vacation"), ("Xct", "LOA"),
    ("M", "Work"), ("M(s)", "Work"), ("A9", "LOA"), ("COM(s)", "Vacation"), ("OM2", "LOA"), ("Xwri", "LOA"), ("N8", "Work"),
])
def test_code_group(spark, code, group):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(S.code_group("c")).first()[0] == group
    short = df.select(S.code_group("c", "short")).first()[0]
    assert short == ("Work" if code == "A9" else group)


def test_classify_keeps_the_two_sheets(spark):
    codes = spark.createDataFrame([("MF/WH", "M", ""), ("MF", "L1", ""), ("WH", "V", ""), ("MF", "M", "again")],
                                  "indice string, code string, description string")
    assert rows(codes.transform(S.classify_codes())) == [("L1", "Day Off"), ("M", "Work")]


def test_flags_and_null_cells(spark):
    codes = spark.createDataFrame([("M", "Work"), ("T", "Trainees"), ("V", "Vacation"), ("A9", "LOA"), ("L1", "Day Off")], "code string, codes_group string")
    cells = spark.createDataFrame([("M",), ("T",), ("V",), ("A9",), ("L1",), ("-",), ("?",), (None,)], "value string")
    flags = ["Schedule", "WD", "LOA", "PTO", "Leave"]

    def of(mode):
        df = cells.transform(S.schedule_flags(codes, null_cells=mode))
        return {r["value"]: tuple(r[f] for f in flags) for r in df.collect()}

    off = of("off")
    assert off == {"M": (1, 1, 0, 0, 0), "T": (1, 1, 0, 0, 0), "V": (1, 0, 0, 1, 0), "A9": (1, 0, 1, 0, 0),
                   "L1": (0, 0, 0, 0, 1), "-": (0, 0, 0, 0, 0), "?": (1, 0, 0, 0, 0), None: (0, 0, 0, 0, 0)}
    assert of("legacy") == {**off, None: (1, 1, 1, 1, 0)}
    with pytest.raises(ValueError):
        S.flag_columns("value", "codes_group", "other")


@pytest.mark.parametrize("cell, shift", [("ME", "Evening"), ("N", "Night"), ("M(s)", "Middle"), ("M", "Morning"), ("L1", "-"), (None, "-")])
def test_shift(spark, cell, shift):
    assert spark.createDataFrame([(cell,)], "v string").select(S.shift_bucket("v")).first()[0] == shift


def test_absence_modes(spark):
    schema = "WD int, Schedule int, rta_status string, srtf_total_hrs double, ABS_FCST int, iw_attendance_status string"
    cases = {  # (main, wfh, 2022, 2024)
        (1, 1, "Abs", None, None, None): (1, 1, 1, 0),
        (1, 1, "Abs", 5.0, None, None): (0, 1, 0, 0),
        (1, 0, "Work", 0.5, None, "x"): (0, 0, 0, 1),
        (0, 1, None, None, 1, None): (1, 1, 0, 1),
        (0, 1, None, None, 1, "here"): (0, 0, 0, 1),
        (1, 1, None, None, None, None): (0, 0, 0, 0),
    }
    for case, want in cases.items():
        df = spark.createDataFrame([case], schema)
        assert df.select(*[S.absence_flag(m).alias(m) for m in ("main", "wfh", "2022", "2024")]).first() == want
    with pytest.raises(ValueError):
        S.absence_flag("2023")


# days Saturday to Friday, M = work, L = day off, - = off
WEEKS = [
    ("MMMMMML", [5 / 7] * 7),
    ("LLMMMMM", [0, 0, 1, 1, 1, 1, 1]),
    ("LLMMMML", [0, 0, 1, 1, 1, 1, 1]),
    ("LLLMMMM", [5 / 7] * 7),
    ("LLLLMMM", [5 / 7] * 7),
    ("-LMMMMM", [0, 0, 1, 1, 1, 1, 1]),
    ("MMMMMMM", [0] * 7),
]


def week_rows(spark, week, entity="e", copies=1):
    data = [
        (entity, SATURDAY + dt.timedelta(days=i), SATURDAY + dt.timedelta(days=6), int(c == "M"), int(c == "L"))
        for i, c in enumerate(week) for _ in range(copies)
    ]
    return spark.createDataFrame(data, "EID string, date date, week_ending date, Schedule int, Leave int")


@pytest.mark.parametrize("week, want", WEEKS)
def test_weekly_coefficient_golden(spark, week, want):
    df = week_rows(spark, week)
    for op in (S.weekly_coefficient(), S.weekly_coefficient_in_place(["EID"])):
        got = [r["WSC"] for r in df.transform(op).orderBy("date").collect()]
        assert got == pytest.approx(want)
    blank = [r["WSC"] for r in df.transform(S.weekly_coefficient(default=None)).orderBy("date").collect()]
    assert blank == [w or None for w in want]


def test_weekly_coefficient_of_repeated_days(spark):
    df = week_rows(spark, "LLMMMMM", copies=2).transform(S.weekly_coefficient())
    assert df.count() == 14 and {r["WSC"] for r in df.collect()} == {0.0}  # 14 days in the week: no rule holds



def test_weekly_coefficient_of_bounded_timelines(spark):
    """The same results in windows, with repeated days and rows without a key, from a fact that is made once."""
    rng = random.Random(4)
    data = []
    for _ in range(400):
        d, off = SATURDAY + dt.timedelta(rng.randrange(35)), rng.choice([0, 0, 1, None])
        week = d + dt.timedelta((4 - d.weekday()) % 7)
        data.append((rng.choice(["a", "b", "c", "d", "e", "f", None]), rng.choice([d, d, d, d, None]), week if d.day % 9 else None,
                     None if off is None else 1 - off, off))
    data += [("g", SATURDAY + dt.timedelta(i), SATURDAY + dt.timedelta(6), int(c == "M"), int(c == "L")) for i, c in enumerate("LLMMMML")]
    data += [("h", SATURDAY + dt.timedelta(i), SATURDAY + dt.timedelta(6), 1, 0) for i in (0, 1, 1, 2)]
    df = spark.createDataFrame(data, "EID string, date date, week_ending date, Schedule int, Leave int")
    want = df.transform(S.weekly_coefficient())
    got = df.transform(S.weekly_coefficient(bounded=True))
    assert rows(got.select(want.columns)) == rows(want) and got.columns == df.columns + ["WSC"]
    assert plan(got).count("Scan ExistingRDD") == 1 < plan(want).count("Scan ExistingRDD")

def test_tenure(spark):
    d = dt.date
    cases = [
        (d(2024, 1, 1), d(2024, 1, 2), None, 0, None, "Trainee"),
        (d(2024, 1, 2), d(2024, 1, 2), d(2024, 1, 9), 0, None, "DMR"),
        (d(2024, 1, 9), d(2024, 1, 2), d(2024, 1, 9), 0, None, "Tenured"),
        (d(2024, 1, 9), None, None, 44926, None, "Tenured"),
        (d(2024, 1, 20), None, None, 45292, "Active", "Trainee"),  # rolled in on 1 January
        (d(2024, 1, 21), None, None, 45292, "Active", "Tenured"),
        (d(2024, 1, 21), None, None, 45292, "Gone", None),
    ]
    df = spark.createDataFrame(cases, "day date, dep date, grad date, rin int, status string, want string")
    for r in df.withColumn("got", S.tenure_class("day", "dep", "grad", "rin", "status")).collect():
        assert r["got"] == r["want"], r


@pytest.mark.parametrize("lob, unit", [
    ("CO - Customer Support", "CUSTOMER_SUPPORT"), ("CO - GTM", "COMMUNITY_OPS"), ("Non-Rec", "COMMUNITY_OPS"), ("LERT", "LERT"), (None, None)])
def test_business_unit(spark, lob, unit):
    assert spark.createDataFrame([(lob,)], "l string").select(S.business_unit("l")).first()[0] == unit


def test_line_of_business_passes(spark):
    data = [("LERT", "LERT"), ("CUSTOMER_SUPPORT", "GTM"), ("CUSTOMER_SUPPORT", "IDVAAS"), ("COMMUNITY_OPS", "Objects/IGPR"), ("COMMUNITY_OPS", None), (None, "GTM")]
    df = spark.createDataFrame(data, "u string, f string").withColumn("l", F.lit("old"))
    first = [r[0] for r in df.select(S.line_of_business("u", "f", "l")).collect()]
    second = [r[0] for r in df.select(S.line_of_business("u", "f", "l", after_changes=True)).collect()]
    assert first == ["LERT", "old", "CO - Customer Support", "CO - Content Moderation", "old", "old"]
    assert second == ["LERT", "CO - Customer Support", "CO - Customer Support", "CO - Content Moderation", "old", "old"]


def test_settled_flow_and_support_functions(spark):
    df = spark.createDataFrame([("CUSTOMER_SUPPORT", "GTM", True), ("X", "Policy", True), ("X", "Training", False)], "u string, f string, c boolean")
    got = df.withColumn("l", F.lit("old")).transform(S.settle_lob("u", "f", "l", F.col("c"))).select("f", "l")
    assert [tuple(r) for r in got.collect()] == [("IDVAAS", "CO - Customer Support"), ("Policy", "CO - PTQ"), ("Training", "old")]


def test_markets_and_dated_override(spark):
    df = spark.createDataFrame([("GTM_ITALIAN",), ("PDO_VACCINE_HESITANCY",), ("pt",)], "m string").withColumns({"f": F.lit("f"), "l": F.lit("l")})
    assert rows(df.transform(S.market_rules("m", "f", "l"))) == [
        ("GTM_ITALIAN", "GTM", "CO - GTM"), ("PDO_VACCINE_HESITANCY", "f", "CO - Vaccine Hesitancy"), ("pt", "f", "l")]
    dated = spark.createDataFrame([(dt.date(2023, 10, 27),), (dt.date(2023, 10, 28),)], "date date")
    dated = dated.withColumns({"u": F.lit("CUSTOMER_SUPPORT"), "l": F.lit("CO - Customer Support")})
    assert [tuple(r)[1:] for r in dated.transform(S.dated_override("u", "l")).collect()] == [
        ("CUSTOMER_SUPPORT", "CO - Customer Support"), ("COMMUNITY_OPS", "CO - Graph Integrity")]
    assert {r["u"] for r in dated.transform(S.dated_override("u", "l", since=None)).collect()} == {"COMMUNITY_OPS"}


def test_exit_needs_an_open_roll_off(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(d(2024, 1, 1), 0), (d(2024, 1, 2), None), (d(2024, 1, 2), 0), (d(2024, 1, 3), 0), (d(2024, 1, 3), 45000)], "day date, off int")
    df = df.withColumns({"value": F.lit("M"), "mark": F.lit(None).cast("string"), "ended": F.lit(d(2024, 1, 2))})
    got = [(r["value"], r["mark"]) for r in df.transform(S.apply_exit("value", "mark", "day", "ended", "off")).collect()]
    assert got == [("M", None), ("M", "roll_off"), ("M", "roll_off"), ("-", None), ("M", None)]


def test_roll_off_sentinel(spark):
    d = dt.date
    data = [("Active", d(2024, 1, 3), d(2024, 1, 2)), (None, d(2024, 1, 3), d(2024, 1, 2)), ("Active", d(2024, 1, 3), d(1900, 1, 1)),
            ("Leave", d(2024, 1, 3), d(2024, 1, 2)), ("Active", d(2024, 1, 2), d(2024, 1, 2))]
    df = spark.createDataFrame(data, "status string, day date, off date").withColumn("mark", F.lit(None).cast("string"))
    got = [(r["status"], r["mark"]) for r in df.transform(S.roll_off_status("status", "day", "off", "mark")).collect()]
    assert got == [("Rolled-Off", None), ("Rolled-Off", None), ("Active", None), ("Leave", None), ("Active", "roll_off")]


@pytest.mark.parametrize("rows_per_chunk", [None, 2])
def test_attribute_change_text(spark, rows_per_chunk):
    day = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    data = [
        ("e", day[0], "Trainee", "CUSTOMER_SUPPORT", "Content Moderation", "pt"),
        ("e", day[1], "Trainee", None, "Content Moderation", "pt"),  # dropped, but its role is still the next one
        ("e", day[2], "Analyst", "COMMUNITY_OPS", "MISREPRESENTATION", "pt"),
        ("e", day[3], "Analyst", "COMMUNITY_OPS", "MISREPRESENTATION", "pt"),
        ("f", day[0], "Analyst", "COMMUNITY_OPS", "GTM", "es"),
    ]
    df = spark.createDataFrame(data, "e string, d date, role string, unit string, flow string, market string")
    line = Timeline(["e"], ["d"]) if rows_per_chunk is None else Timeline(["e"], ["d"], F.unix_date("d"), rows_per_chunk=rows_per_chunk)
    got = line.unsplit(S.attribute_change(line, "role", "unit", "flow", "market")(line.split(df)))
    assert rows(got.select("e", "d", "role_change", "cross_change")) == [
        ("e", day[0], None, "CS_CM_pt to CO_MISREP_pt"), ("e", day[2], None, None), ("e", day[3], None, None), ("f", day[0], None, None)]


def test_promotions(spark):
    day = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    data = [("e", d, v, "Trainee", "Active", "non-billable") for d, v in zip(day, "TMTM")]
    df = spark.createDataFrame(data, "e string, d date, v string, role string, status string, billable string")
    line, working = Timeline(["e"], ["d"]), F.col("v") == "M"
    got = S.promote_trainees(line, "role", "d", working)(df)
    got = S.promote_billable(line, "role", "status", "billable", "d", working)(got).orderBy("d")
    assert [(r["role"], r["billable"]) for r in got.collect()] == [("Trainee", "non-billable")] + [("Analyst", "billable")] * 3
