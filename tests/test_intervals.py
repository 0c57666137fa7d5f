import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import intervals
from shiftloom.operators.timeline import Timeline
from tests.conftest import plan, rows

DAY = dt.date(2024, 1, 1)
POINTS, TICKETS = "who long, day date, n long", "who long, lo date, hi date, ticket long"


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


def who(rng):
    return 1 if rng.random() < 0.5 else rng.choice([None, 0, 1, 2, 3])


def sample_tickets(rng, n=120, lengths=(0, 1, 3, 9, -2, 40, 992, 993, 5000, 40_000, None)):
    out = []
    for i in range(n):
        lo, length = rng.randrange(-40, 40), rng.choice(lengths)
        out.append((who(rng), day(lo), None if length is None else day(lo + length), i))
    return out + out[:10]


def pairs(points, tickets):
    return sorted((p[0], p[1], p[2], t[1], t[2], t[3]) for p in points for t in tickets
                  if None not in (p[0], p[1], t[1], t[2]) and p[0] == t[0] and t[1] <= p[1] <= t[2])


def sample(seed):
    """Points and tickets; one person has half of all. Nulls, reversed, far and equal tickets."""
    rng = random.Random(seed)
    return [(who(rng), day(rng.choice([None, *range(-40, 40)])), i) for i in range(120)], sample_tickets(rng)


@pytest.mark.parametrize("longest, per_slice", [(None, 10**6), (None, 5), (10, 7), (40_000, 10**6)])
def test_every_pair_is_met(spark, longest, per_slice):
    points, tickets = sample(3)
    left = spark.createDataFrame(points, POINTS).repartition(4)
    met = left.transform(intervals.range_join(spark.createDataFrame(tickets, TICKETS), "who", "day", "lo", "hi", longest, per_slice))
    assert rows(met) == pairs(points, tickets)
    assert "NestedLoop" not in plan(met) and "Cartesian" not in plan(met)


def test_bins_of_an_interval_are_bounded(spark):
    tickets = [(1, day(0), day(n), n) for n in (0, 31, 32, 991, 992, 993, 31_743, 31_745, 200_000, 2_900_000)]
    binned = intervals.binned_intervals(spark.createDataFrame(tickets, TICKETS), "lo", "hi")
    assert max(r["count"] for r in binned.groupBy("ticket").count().collect()) <= intervals.REACH + 1


def test_covering_counts_repeats_and_overlaps(spark):
    points, tickets = sample(5)
    df = spark.createDataFrame(points, POINTS)
    aggs = {"n_open": F.sum("__times"), "since": F.min("lo"), "until": F.max("hi")}
    got = df.transform(intervals.covering(spark.createDataFrame(tickets, TICKETS), "who", "day", "lo", "hi", aggs, per_slice=9))
    met = pairs(points, tickets)
    for r in got.collect():
        mine = [m for m in met if m[2] == r["n"]]
        want = (len(mine), min(m[3] for m in mine), max(m[4] for m in mine)) if mine else (None, None, None)
        assert (r["n_open"], r["since"], r["until"]) == want
    assert got.count() == len(points)


def united(tickets, gap=1):
    """Spans by marking days one by one."""
    out = []
    for person in {t[0] for t in tickets} - {None}:
        mine = sorted((t[1], t[2]) for t in tickets if t[0] == person and t[2] is not None and t[1] <= t[2])
        for lo, hi in mine:
            if out and out[-1][0] == person and lo <= out[-1][2] + dt.timedelta(gap):
                out[-1] = (person, out[-1][1], max(out[-1][2], hi), out[-1][3] + 1)
            else:
                out.append((person, lo, hi, 1))
    return sorted(out)


@pytest.mark.parametrize("rows_per_chunk, gap", [(10**6, 1), (4, 1), (3, 0), (7, 5)])
def test_union_over_chunk_borders(spark, rows_per_chunk, gap):
    for seed in (1, 2):
        tickets = sample_tickets(random.Random(seed), 150, (0, 1, 2, 3, -2, None, 30 if seed == 2 else 4))
        line = Timeline(["who"], [], rows_per_chunk=rows_per_chunk)
        got = spark.createDataFrame(tickets, TICKETS).repartition(3).transform(
            intervals.union(line, "lo", "hi", {"n": F.count(F.lit(1))}, gap))
        assert rows(got) == united(tickets, gap)


def test_spans_cover_the_same_days(spark):
    tickets = sample_tickets(random.Random(9), 100, (0, 1, 2, 5, 9))
    spans = rows(spark.createDataFrame(tickets, TICKETS).transform(intervals.union(Timeline(["who"], []), "lo", "hi")))
    days = {(t[0], t[1] + dt.timedelta(i)) for t in tickets if t[0] is not None for i in range((t[2] - t[1]).days + 1)}
    laid = [(s[0], s[1] + dt.timedelta(i)) for s in spans for i in range((s[2] - s[1]).days + 1)]
    assert len(laid) == len(set(laid)) and set(laid) == days


def test_flag_sees_the_earlier_longer_ticket(spark):
    tickets = [(1, day(0), day(9), 1), (1, day(2), day(3), 2)]
    fact = spark.createDataFrame([(1, day(n), n) for n in (1, 5, 9, 10)], POINTS)
    flagged = fact.transform(intervals.covered_flag(spark.createDataFrame(tickets, TICKETS), "who", "day", "lo", "hi", "out"))
    assert [r["out"] for r in sorted(flagged.collect(), key=lambda r: r["n"])] == [1, 1, 1, None]
