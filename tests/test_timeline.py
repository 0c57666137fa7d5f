"""Ordered operators against brute force, with and without cutting hot entities."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftloom.operators import timeline
from shiftloom.operators.timeline import CHUNK, Timeline
from tests.conftest import plan, rows

SCHEMA = "k string, pos bigint, seq bigint, v string"


def make(seed: int, n: int = 240):
    """One entity holds a third of all rows, some rows have no entity, positions repeat."""
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        k = "hot" if seq % 3 == 0 else rnd.choice([None, "a", "b", "c", "d", "e"])
        out.append((k, rnd.randrange(40), seq, rnd.choice([None, None, "x", "y", "z"])))
    return out


def line(rows_per_chunk: int, tie: bool = True) -> Timeline:
    return Timeline(["k"], ["pos", "seq"], F.col("pos"), F.col("seq") if tie else None, rows_per_chunk)


def by_entity(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        if r[0] is not None:
            groups.setdefault(r[0], []).append(r)
    return groups


def brute(data, mode):
    """{seq: result}; rows without an entity get nothing."""
    out = {r[2]: None for r in data if r[0] is None}
    for members in by_entity(data).values():
        values = [r[3] for r in members]
        for i, r in enumerate(members):
            if mode == "forward":
                known = [v for v in values[: i + 1] if v is not None][-1:]
            elif mode == "backward":
                known = [v for v in values[i:] if v is not None][:1]
            elif mode == "following":
                known = [v for v in values[i + 1 :] if v is not None][:1]
            elif mode == "next":
                nxt = values[i + 1] if i + 1 < len(values) else None
                known = [nxt if nxt is not None else values[i]]
            else:
                known = sorted(m[1] for m in members if m[3] == "y")[:1]
            out[r[2]] = known[0] if known else None
    return out


def run(spark, data, tl, mode):
    df = tl.split(spark.createDataFrame(data, SCHEMA))
    if mode == "forward":
        df = tl.fill_forward(df, {"r": "v"})
    elif mode == "backward":
        df = tl.fill_backward(df, {"r": "v"})
    elif mode == "following":
        df = tl.following(df, {"r": "v"})
    elif mode == "next":
        df = tl.next_or_self(df, {"r": "v"})
    else:
        df = tl.first_where(df, {"r": (F.col("v") == "y", "pos")})
    return {r["seq"]: r["r"] for r in tl.unsplit(df).collect()}


MODES = ["forward", "backward", "following", "next", "first"]


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("rows_per_chunk, tie", [(10**6, True), (12, True), (12, False), (1, True)])
def test_equals_brute_force(spark, mode, rows_per_chunk, tie):
    data = make(7)
    assert run(spark, data, line(rows_per_chunk, tie), mode) == brute(data, mode)


@pytest.mark.parametrize("mode", MODES)
def test_bounded_line_is_the_same(spark, mode):
    data = make(11)
    assert run(spark, data, Timeline(["k"], ["pos", "seq"]), mode) == brute(data, mode)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-3, 3), st.sampled_from([None, "x", "y"])), min_size=1, max_size=25))
def test_any_rows(spark, drawn):
    data = [(k, pos, seq, v) for seq, (k, pos, v) in enumerate(drawn)]
    for mode in ("forward", "following", "next"):
        assert run(spark, data, line(3), mode) == brute(data, mode)


def test_hot_entity_is_cut_and_order_kept(spark):
    data = make(3)
    cut = line(12).split(spark.createDataFrame(data, SCHEMA))
    sizes = {(r["k"], r[CHUNK]): r["count"] for r in cut.groupBy("k", CHUNK).count().collect()}
    hot = {c: n for (k, c), n in sizes.items() if k == "hot"}
    assert len(hot) > 5 and max(hot.values()) <= 12
    assert all(c == 0 for (k, c) in sizes if k in {"a", "b"} and sum(n for (j, _), n in sizes.items() if j == k) <= 12)
    ordered = [r[CHUNK] for r in cut.where("k = 'hot'").orderBy("pos", "seq").collect()]
    assert ordered == sorted(ordered)
    assert len({c for (k, c) in sizes if k is None}) > 1  # rows without a key are spread


def chunk_sizes(spark, data, rows_per_chunk):
    cut = line(rows_per_chunk).split(spark.createDataFrame(data, SCHEMA)).where("k = 'hot'")
    ordered = [r[CHUNK] for r in cut.orderBy("pos", "seq").collect()]
    assert ordered == sorted(ordered)
    return [ordered.count(c) for c in set(ordered)]


@pytest.mark.parametrize("shape", ["one old row", "one time for all", "no times", "half at one time", "dense"])
def test_no_chunk_is_much_larger_than_wanted(spark, shape):
    now, n = 1_700_000_000_000_000, 6000
    pos = {
        "one old row": lambda i: 0 if i == 0 else now + i, "one time for all": lambda i: now, "no times": lambda i: None,
        "half at one time": lambda i: now + (0 if i % 2 else i), "dense": lambda i: now + i // 3,
    }[shape]
    sizes = chunk_sizes(spark, [("hot", pos(i), i, "x") for i in range(n)] + [("a", 1, n, "x")], 500)
    assert sum(sizes) == n and max(sizes) <= 1000


@pytest.mark.parametrize("mode", ["forward", "following", "next"])
def test_heavy_positions_equal_brute_force(spark, mode):
    rnd = random.Random(1)
    data = [("hot", rnd.choice([5, 5, 5, 5, 2, 9, 7]), i, rnd.choice([None, None, "x", "y"])) for i in range(300)]
    assert run(spark, data, line(20), mode) == brute(data, mode)


def test_fill_is_idempotent(spark):
    df = spark.createDataFrame(make(5), SCHEMA)
    once = df.transform(timeline.forward_fill(line(12), {"v": "v"}))
    twice = once.transform(timeline.forward_fill(line(12), {"v": "v"}))
    assert rows(once, "seq") == rows(twice, "seq")


def test_dedupe_keeps_first_and_last(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m")], "k string, seq int, v string")
    assert rows(df.transform(timeline.keep_first(["k"], ["seq"]))) == [(None, 4, "m"), ("a", 1, "y"), ("b", 2, "z")]
    assert rows(df.transform(timeline.keep_last(["k"], ["seq"]))) == [(None, 5, "n"), ("a", 3, "x"), ("b", 2, "z")]


def test_dedupe_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 3)], "k string, seq int").transform(timeline.keep_first(["k"], ["seq"]))
    assert plan(df).count("WindowGroupLimit") == 2  # once before, once after the exchange
