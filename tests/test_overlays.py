"""Effective-dated overlays and their corner cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.overlays import EventFeed, attach_events, effective_overlay, event_table, interval_overlay
from shiftloom.operators.timeline import Timeline
from tests.conftest import rows

LINES = {
    "bounded": lambda: Timeline(["e"], ["d"]),
    "cut": lambda: Timeline(["e"], ["d"], position=F.unix_date("d"), rows_per_chunk=2),
}


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(params=sorted(LINES))
def line(request, spark):
    return LINES[request.param]()


def fact(spark, entities=("a", "b"), days=range(6)):
    return spark.createDataFrame([(e, day(n)) for e in entities for n in days], "e string, d date")


def feed(spark, data, schema="who string, eff date, v string, w string, seq int", **kw):
    df = spark.createDataFrame(data, schema)
    return EventFeed("ev", df, "who", "eff", {"v": "v", "w": "w"}, ["seq"], **kw)


def result(df, *cols):
    return {(r["e"], (r["d"] - day(0)).days): tuple(r[c] for c in cols) for r in df.collect()}


def test_event_holds_from_its_day_on(spark, line):
    f = feed(spark, [("a", day(2), "x", "p", 1), ("a", day(4), "y", "q", 2)])
    got = result(fact(spark).transform(effective_overlay(line, [f], "e", "d")), "v", "w")
    assert [got["a", n] for n in range(6)] == [(None, None)] * 2 + [("x", "p")] * 2 + [("y", "q")] * 2
    assert all(got["b", n] == (None, None) for n in range(6))


def test_several_events_on_a_day_do_not_multiply_rows(spark, line):
    f = feed(spark, [("a", day(1), "late", "x", 9), ("a", day(1), "first", "y", 1), (None, day(1), "z", "z", 0)])
    df = fact(spark).transform(effective_overlay(line, [f], "e", "d"))
    assert df.count() == 12 and result(df, "v")["a", 5] == ("first",)


def test_columns_are_carried_one_by_one_unless_atomic(spark, line):
    f = feed(spark, [("a", day(1), "x", "p", 1), ("a", day(3), None, "q", 1)])
    apart = result(fact(spark).transform(effective_overlay(line, [f], "e", "d")), "v", "w")
    whole = result(fact(spark).transform(effective_overlay(line, [f], "e", "d", atomic=True)), "v", "w")
    assert apart["a", 4] == ("x", "q") and whole["a", 4] == (None, "q") and whole["a", 2] == ("x", "p")


def test_event_outside_the_days_counts_only_with_carry_in(spark, line):
    f = feed(spark, [("a", day(-3), "old", "o", 1), ("b", day(9), "future", "f", 1), ("c", day(1), "gone", "g", 1)])
    lost = result(fact(spark).transform(effective_overlay(line, [f], "e", "d")), "v")
    kept = fact(spark).transform(effective_overlay(line, [f], "e", "d", carry_in=True))
    assert all(v == (None,) for v in lost.values())
    assert result(kept, "v") == {(e, n): ("old",) if e == "a" else (None,) for e in "ab" for n in range(6)}
    assert kept.columns == ["e", "d", "v", "w"]


def test_empty_event_table(spark, line):
    df = fact(spark).transform(effective_overlay(line, [feed(spark, [])], "e", "d"))
    assert df.count() == 12 and df.where("v IS NOT NULL").count() == 0


def test_feeds_of_one_frame_are_one_scan(spark):
    data = [("a", day(1), "PBU", "u", None), ("a", day(1), "SLOB", "s", day(2)), (None, day(1), "PBU", "n", None)]
    log = spark.createDataFrame(data, "who string, eff date, kind string, new string, other date")
    feeds = [
        EventFeed("unit", log, "who", "eff", {"u": "new"}, where="kind = 'PBU'"),
        EventFeed("flow", log, "who", "other", {"f": "new"}, where="kind = 'SLOB'"),
    ]
    assert rows(event_table(feeds).select("__day", "unit.u", "flow.f")) == [(day(1), "u", None), (day(2), None, "s")]
    assert event_table(feeds)._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    got = fact(spark).transform(attach_events(feeds, "e", "d"))
    assert got.where("unit IS NOT NULL").count() == 1 and got.count() == 12


def test_interval_equals_brute_force(spark, line):
    spans = [("a", 0, 1), ("a", 3, 3), ("b", 2, 9)]  # apart from each other
    f = EventFeed("ev", spark.createDataFrame([(e, day(lo), day(hi)) for e, lo, hi in spans], "who string, lo date, hi date"),
                  "who", "lo", {"lo": "lo", "hi": "hi"})
    df = fact(spark).transform(interval_overlay(line, f, "e", "d", "lo", "hi", "hit", unless=F.col("d") == F.lit(day(4))))
    want = {(e, n): (1 if n != 4 and any(e == s[0] and s[1] <= n <= s[2] for s in spans) else None,) for e in "ab" for n in range(6)}
    assert result(df, "hit") == want and df.columns == ["e", "d", "hit"]
