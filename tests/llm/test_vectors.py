import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftloom.llm import vectors

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, entries=256, rounds=4, parts=4):
    """The contract with Python integers and no bounds."""
    good = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    width = parts * max(1, -(-max((len(r[2]) for r in good), default=0) // parts))
    whole = lambda x: int(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024)
    vecs = [[whole(x) for x in r[2]] + [0] * (width - len(r[2])) for r in good]
    order = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][2]))
    d = width // parts
    cut = [[tuple(v[p * d:(p + 1) * d]) for v in vecs] for p in range(parts)]
    books = [[cut[p][i] for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(nearest(x, books[p])[0], []).append(x)
            books[p] = [tuple(sum(c) // len(c) for c in zip(*groups[e])) if e in groups else old for e, old in enumerate(books[p])]
    best = [[nearest(cut[p][i], books[p]) for p in range(parts)] for i in range(len(good))]
    errors = [sum(b[1] for b in bs) for bs in best]
    by_label = {}
    for r, e in zip(good, errors):
        by_label[r[1]] = by_label.get(r[1], 0) + e
    top = 2**63 - 1
    sha = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return sorted(((r[0], "".join("%02x" % b[0] for b in bs), min(e, top), min(by_label[r[1]], top), sha)
                   for r, bs, e in zip(good, best, errors)), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.lit("x")).withColumn("v", F.lit(1)).repartition(3)
    return sorted((tuple(r) for r in vectors.compress(df, **options).collect()), key=repr)


def clustered(n, width, seed=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(20)]
    return [(i, i % 3 if i % 7 else None, [c + rng.gauss(0, 0.02) for c in centres[rng.randrange(20)]]) for i in range(n)]


def test_equals_brute_force_on_clusters(spark):
    rows = clustered(400, 8)
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = clustered(60, 8) + [
        (None, 1, [0.5] * 8), (None, None, [0.25] * 8), (70, 1, None), (71, 1, [1.0, None]), (72, 1, [math.nan] * 8),
        (73, 1, [math.inf] * 8), (74, 2, []), (75, 2, [1.0, -1.0, 0.0001]), (76, 5, [-0.0001] * 8), (3, 1, [0.1] * 8),
        (3, 1, [0.1] * 8), (77, 5, [0.1] * 9),
    ]
    assert run(spark, rows, entries=16) == brute(rows, entries=16)
    assert run(spark, rows, entries=1) == brute(rows, entries=1)


@pytest.mark.parametrize("size", [1e6, 1e19, 1e160, 1e307])
def test_huge_components_stay_exact(spark, size):
    rows = clustered(40, 8) + [(-1, 1, [size] * 8), (100, 2, [-size, 1.0, size / 3, *[0.0] * 5]), (101, 2, [size * 0.9] * 8)]
    assert run(spark, rows, entries=8) == brute(rows, entries=8)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, 1, [float(i % 2)] * 4) for i in range(40)] + [(100 + i, 1, [0.5] * 4) for i in range(5)]
    got = run(spark, rows, entries=3, rounds=0)
    assert got == brute(rows, entries=3, rounds=0)
    assert {r[1] for r in got} == {"00000000", "01010101"}


def test_no_rows(spark):
    for rows in ([], [(1, 1, None)]):
        assert run(spark, rows) == []


def test_one_hot_vector(spark):
    rows = clustered(50, 8) + [(1000 + i, 9, [0.3] * 8) for i in range(500)]
    assert run(spark, rows, entries=32) == brute(rows, entries=32)


def test_decoded_is_the_entry(spark):
    rows = vectors.kept(spark.createDataFrame(clustered(80, 8), SCHEMA))
    width = vectors.width_of(rows)
    books = vectors.fitted(rows, width, entries=16)
    for r in vectors.decoded(vectors.encoded(rows, books, width), books).collect():
        code = bytes.fromhex(r["code"])
        assert [round(x * 1024) for x in r["restored"]] == [v for b, c in zip(books, code) for v in b.entries[c]]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 40), st.integers(1, 6), st.integers(0, 9999), st.integers(1, 50))
def test_dual_descent_finds_the_nearest(n, k, width, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread, (n, width)).astype(float) / 1024
    entries = rng.integers(-spread, spread, (k, width))
    block, book = vectors.Block(x, 1024), vectors.Book(entries.astype(object))
    got = np.full(n, -1)
    for i, j, chosen in block.assigned(book, *vectors._tree(book)):
        assert (got[block.order[i:j]] == -1).all()
        got[block.order[i:j]] = chosen
        assert (block.total(i, j) == block.points[block.order[i:j]].sum(axis=0)).all()
    want = ((block.points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (got == want).all()


def test_clusters_are_assigned_whole():
    """Far clusters prune almost all pairs: few rows are compared with entries one by one."""
    x = np.array([r[2] for r in clustered(4000, 4)])
    book = vectors.Book(vectors.whole(np.array([r[2] for r in clustered(4000, 4)][:20]) * 0 + np.arange(20)[:, None] * 50, 1024))
    block = vectors.Block(x, 1024)
    single = sum(j - i for i, j, chosen in block.assigned(book, *vectors._tree(book)) if isinstance(chosen, int))
    assert single > 3900


@given(st.integers(-10**60, 10**60))
def test_limbs(value):
    assert sum(v << (32 * k) for k, v in vectors._limbs(value)) == value
