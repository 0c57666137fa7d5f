import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shiftloom.plans import corrections as C
from shiftloom.queries.corrections import _feed, status_fact
from shiftloom.sources.published import read_published, state
from tests.conftest import plan, rows

DAY = dt.date(2024, 1, 1)
MOVES = "who long, eff date, event_id long, unit string, flow string"
LATE, BASE = "who long, eff date, status int", "user_id long, day date, status int"


def feeds(rng, people=12, days=60):
    base = [(p, DAY + dt.timedelta(d), rng.choice([0, 1, None])) for p in range(people) for d in range(days) if rng.random() < 0.8]
    moves = [(rng.randrange(people), DAY + dt.timedelta(rng.randrange(-9, days)), i, rng.choice([None, "u1", "u2"]), rng.choice([None, "f1", "f2"]))
             for i in range(40)]
    late = {(rng.randrange(people), DAY + dt.timedelta(rng.randrange(days))): rng.randrange(2) for _ in range(40)}
    return base, moves, late


def altered(rng, base, moves, late):
    base = [r for r in base if rng.random() > 0.005] + [(50, DAY + dt.timedelta(3), 1)]
    moves = [m if rng.random() > 0.08 else (*m[:3], "new", m[4]) for m in moves if rng.random() > 0.05]
    late = {k: v for k, v in late.items() if rng.random() > 0.05} | {(3, DAY + dt.timedelta(17)): 1, (99, DAY): 1}
    return base, moves, late


def frames(spark, base, moves, late):
    return (spark.createDataFrame(base, BASE), spark.createDataFrame(moves, MOVES),
            spark.createDataFrame([(*k, v) for k, v in late.items()], LATE))


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_a_full_build(spark, tmp_path, seed):
    rng, path = random.Random(seed), str(tmp_path / "fact")
    old = feeds(rng)
    base, moves, late = frames(spark, *old)
    status_fact(moves, late).publish(base, path)
    for _ in range(2):
        new = altered(rng, *old)
        nbase, nmoves, nlate = frames(spark, *new)
        changes = [C.changed_events(_feed(moves), _feed(nmoves)), C.changed_days(late, nlate, "who", "eff"), C.changed_days(base, nbase, "user_id", "day")]
        fact = status_fact(nmoves, nlate)
        C.refresh(fact, nbase, path, changes)
        assert rows(read_published(spark, path)) == rows(fact.whole(nbase))
        old, (base, moves, late) = new, (nbase, nmoves, nlate)


def test_only_the_weeks_concerned_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "fact")
    base, moves, late = frames(spark, *feeds(random.Random(5)))
    base = base.where("user_id <> 4").union(spark.createDataFrame([(4, DAY + dt.timedelta(d), 0) for d in range(60)], BASE))
    moves = moves.where("who <> 4").union(spark.createDataFrame([(4, DAY, 900, "u", "f"), (4, DAY + dt.timedelta(30), 901, "u", "f")], MOVES))
    status_fact(moves, late).publish(base, path)
    before = state(spark, path)
    # a change ends where a later event has all columns
    nmoves = moves.union(spark.createDataFrame([(4, DAY + dt.timedelta(12), 902, "v", None)], MOVES))
    done = C.refresh(status_fact(nmoves, late), base, path, [C.changed_events(_feed(moves), _feed(nmoves))])
    concerned = [dt.date(2024, 1, 19), dt.date(2024, 1, 26), dt.date(2024, 2, 2)]
    assert done.weeks == concerned and done.written == concerned
    kept = {p.value: p.path for p in before.parts}
    assert {p.value for p in done.state.parts if kept.get(p.value) != p.path} == {str(w) for w in concerned}
    assert len(read_published(spark, path, only=concerned).inputFiles()) < len(read_published(spark, path).inputFiles())
    assert rows(read_published(spark, path)) == rows(status_fact(nmoves, late).whole(base))


def test_nothing_changed_or_nothing_came_of_it(spark, tmp_path):
    path = str(tmp_path / "fact")
    base, moves, late = frames(spark, *feeds(random.Random(6)))
    fact = status_fact(moves, late)
    first = fact.publish(base, path)
    assert C.refresh(fact, base, path, [C.changed_events(_feed(moves), _feed(moves))]).state == first
    # a move that says what holds anyway: weeks are looked at, none is written
    same = moves.withColumn("event_id", F.col("event_id") + 1000)
    marked = C.changed_days(late.limit(0), late, "who", "eff")
    done = C.refresh(status_fact(same, late), base, path, [marked])
    assert done.weeks and not done.written and done.state == first


def test_differing_counts_repeats(spark):
    old, new = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k long, v string"), spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    assert rows(C.differing(old, new, ["k"])) == [(1,), (3,)]


def scans(df):
    return plan(df).count("FileScan parquet")


def test_base_and_feeds_are_read_once(spark, tmp_path):
    base, moves, late = frames(spark, *feeds(random.Random(7)))

    def landed(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    assert scans(status_fact(moves, late).whole(landed(base, "base"))) == 1
    old, new = landed(moves, "old"), landed(moves.where("event_id % 3 > 0"), "new")
    assert scans(C.changed_events(_feed(old), _feed(new))) == 2


def first_of_days(moves):
    firsts = {}
    for who, eff, i, *payload in moves:
        if None not in (who, eff) and (who, eff) not in firsts or firsts.get((who, eff), (i,))[0] > i:
            firsts[who, eff] = (i, *payload)
    return {k: v[1:] for k, v in firsts.items()}


def test_ranges_of_changed_events(spark):
    rng = random.Random(8)

    def move(i):
        who, unit, flow = rng.choice([None, 0, 1, 2]), rng.choice([None, "u1", "u2"]), rng.choice([None, "f1", "f2"])
        return who, rng.choice([None, *(DAY + dt.timedelta(d) for d in range(40))]), i, unit, flow

    old = [move(i) for i in range(150)]
    new = [(*m[:3], rng.choice([m[3], None]), m[4]) for m in old if rng.random() > 0.1] + [move(i) for i in range(150, 160)]
    was, now = first_of_days(old), first_of_days(new)
    want = []
    for who, day in was.keys() | now.keys():
        if ((who, day) in was, was.get((who, day))) != ((who, day) in now, now.get((who, day))):
            settled = [d for w, d in now if w == who and d > day and None not in now[w, d]]
            want.append((who, day, min(settled) - dt.timedelta(1) if settled else C.FOREVER))
    got = C.changed_events(_feed(spark.createDataFrame(old, MOVES)), _feed(spark.createDataFrame(new, MOVES)))
    assert rows(got) == sorted(want)


def test_touched_weeks(spark):
    rng, fridays = random.Random(9), [dt.date(2024, 1, 5) + dt.timedelta(7 * i) for i in range(20)]
    pairs = [(rng.choice([None, 0, 1, 2, 3]), rng.choice([None, *fridays])) for _ in range(60)]
    ranges = []
    for who in (0, 1, 1, 2, 2, 2, 9, None):
        first = DAY + dt.timedelta(rng.randrange(120))
        ranges.append((who, first, rng.choice([C.FOREVER, first, first + dt.timedelta(9), first - dt.timedelta(20)])))
    ranges += [(3, DAY + dt.timedelta(50), DAY), (3, DAY + dt.timedelta(1), DAY + dt.timedelta(2)), (3, DAY, DAY + dt.timedelta(30))]
    reach = lambda d: d + dt.timedelta((4 - d.weekday()) % 7) if d != C.FOREVER else d
    want = {(w, week) for w, week in pairs for r, lo, hi in ranges if None not in (w, week) and w == r and reach(lo) <= week <= reach(hi)}
    got = C.touched(spark.createDataFrame(pairs, "user_id long, week date"),
                    spark.createDataFrame(ranges, f"{C.ENTITY} long, {C.FIRST} date, {C.LAST} date"), "user_id", "week")
    assert rows(got) == sorted(want)
