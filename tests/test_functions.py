"""Column expressions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from tests.conftest import rows

D = dt.date


def one(spark, value, expr, type_="string"):
    df = spark.createDataFrame([(value,)], f"c {type_}")
    return df.select(expr(F.col("c"))).first()[0]


@pytest.mark.parametrize("value, want", [("#120.0", "#12"), ("#5.0", "#5"), ("a", "a"), (None, None)])
def test_rstrip_is_a_character_set(spark, value, want):
    assert one(spark, value, lambda c: text.rstrip_set(c, ".0")) == want


@pytest.mark.parametrize("value, exact, cut", [("12.0", "12", "12"), ("#7", "#7", ""), ("123", "123", "1"), (None, None, None), ("x", "x", "")])
def test_float_suffix_and_cut(spark, value, exact, cut):
    assert one(spark, value, text.strip_float_suffix) == exact
    assert one(spark, value, lambda c: text.drop_last(c, 2)) == cut


def test_text_helpers(spark):
    assert one(spark, "0123456789abcdef7#c.d", lambda c: text.from_char(c, 16)) == "7#c.d"
    assert one(spark, "ab", lambda c: text.from_char(c, 16)) == ""
    assert one(spark, None, lambda c: text.has(c, "x")) is False
    assert one(spark, "M(s)", lambda c: text.has(c, "M(s)")) is True
    assert one(spark, "M", lambda c: text.has_regex(c, "^M$")) is True
    assert one(spark, None, lambda c: text.join_text(F.lit("a"), c)) is None
    assert one(spark, "a.b", lambda c: text.replace_chain(c, [(".", "-"), ("-b", "+")])) == "a+"


@pytest.mark.parametrize("offset", range(9))
def test_week_ending_is_the_next_friday(spark, offset):
    day = D(2023, 12, 23) + dt.timedelta(days=offset)
    friday = one(spark, day, dates.week_ending_friday, "date")
    assert friday.weekday() == 4 and 0 <= (friday - day).days <= 6
    week = one(spark, day, dates.week_number, "date")
    assert week == (friday - D(1970, 1, 9)).days // 7


def test_serials(spark):
    assert one(spark, 45290, dates.serial_to_date, "int") == D(2023, 12, 30)
    assert one(spark, 0, dates.serial_or_sentinel, "int") == D(1900, 1, 1)
    assert one(spark, None, dates.serial_or_sentinel, "int") is None
    assert one(spark, "45290", dates.header_to_date) == D(2023, 12, 30)
    assert one(spark, "1/3/2023", dates.header_to_date) == D(2023, 1, 3)
    assert one(spark, "total", dates.header_to_date) is None


def test_parsing_gives_null_on_bad_text(spark):
    assert one(spark, "Rolled-off", lambda c: dates.parse_date(c, "yyyy-MM-dd")) is None
    assert one(spark, "12-29-2023", lambda c: dates.parse_any_date(c, ["M/d/yyyy", "MM-dd-yyyy"])) == D(2023, 12, 29)
    assert one(spark, D(2024, 1, 5), dates.date_text, "date") == "01/05/2024"
    assert one(spark, D(2024, 1, 5), dates.weekday_num, "date") == 4


def test_cutoff_counts_whole_seconds(spark):
    cut = dates.shift_cutoff(D(2024, 1, 15), 10)
    assert cut == dt.datetime(2024, 1, 15, 10)
    assert dates.shift_cutoff(D(2024, 1, 15), 10, "yesterday") == dt.datetime(2024, 1, 14, 10)
    with pytest.raises(ValueError):
        dates.shift_cutoff(D(2024, 1, 15), 10, "tomorrow")
    for micro, kept in ((0, True), (999_999, True)):
        ts = dt.datetime(2024, 1, 15, 10, 0, 0, micro)
        assert one(spark, ts, lambda c: dates.up_to_cutoff(c, cut), "timestamp_ntz") is kept
    assert one(spark, dt.datetime(2024, 1, 15, 10, 0, 1), lambda c: dates.up_to_cutoff(c, cut), "timestamp_ntz") is False


def test_horizon(spark):
    run = D(2024, 1, 15)
    assert one(spark, D(2024, 1, 13), lambda c: dates.after_horizon(c, run, 2), "date") is False
    assert one(spark, D(2024, 1, 13), lambda c: dates.after_horizon(c, run, 2, inclusive=True), "date") is True


def test_drop_zone_keeps_wall_clock(spark):
    df = spark.sql("SELECT timestamp'2024-01-15 08:30:00' AS t").select(dates.drop_zone("t").alias("t"))
    assert df.dtypes == [("t", "timestamp_ntz")] and df.first()[0] == dt.datetime(2024, 1, 15, 8, 30)


def test_rules_first_and_last_match(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    n = F.col("n")
    listed = rules.decision_list([(n < 3, "low"), (n < 9, "mid")], "none")
    chain = rules.last_match([(n < 9, "mid"), (n < 3, "low")], F.lit("kept"))
    assert rows(df.select("n", listed.alias("a"), chain.alias("b"))) == [
        (None, "none", "kept"), (1, "low", "low"), (5, "mid", "mid")]
    assert df.select(rules.decision_list([], "x")).first()[0] == "x"


def test_last_match_equals_single_steps(spark):
    df = spark.range(30).withColumn("c", F.lit("start"))
    steps = [(F.col("id") % 2 == 0, "two"), (F.col("id") % 3 == 0, "three"), (F.col("id") % 5 == 0, "five")]
    stepwise = df
    for cond, value in steps:
        stepwise = stepwise.withColumn("c", rules.override("c", cond, value))
    assert rows(df.withColumn("c", rules.last_match(steps, "c"))) == rows(stepwise)


def test_null_handling_rules(spark):
    df = spark.createDataFrame([(None,), ("x",), ("y",)], "c string")
    got = df.select("c", rules.not_equal("c", "x").alias("ne"), rules.flag(F.col("c") == "x").alias("f"),
                    rules.value_map("c", {"x": "X"}).alias("m"), rules.sentinel_to_null("c", "y").alias("s"))
    assert rows(got) == [(None, True, 0, None, None), ("x", False, 1, "X", "x"), ("y", True, 0, "y", None)]


def test_worked_hours_text(spark):
    df = spark.createDataFrame([(0.33, "A"), (8.0, "A"), (None, "A")], "h double, code string")
    assert sorted(r[0] for r in df.select(rules.hours_text("h", "code")).collect()) == ["8.0", "A", "A"]
    assert one(spark, 90, rules.minutes_to_hours, "int") == 1.5
    assert one(spark, 0.0, rules.zero_to_null, "double") is None
