import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shiftloom.llm import brown

from .helpers import ascii_lower, corpus, frame, words


def tokens(text):
    return [*words(ascii_lower(text)), "\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 = 2"


def slow_base(rows):
    c = Counter()
    for r in rows:
        if not held(r[0]):
            c.update(tokens(r[1]))
    n, v = sum(c.values()), len(c)
    return sorted(
        (str(r[0]), held(r[0]), len(tokens(r[1])), sum(c[t] > 0 for t in tokens(r[1])), n,
         round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 6)) for r in rows)


def test_counts_and_base_equal_brute_force(spark):
    rows = corpus(6)
    for size in (1 << 23, 2000):  # one block per partition, and many
        got = brown.score(frame(spark, rows), F.expr(HELD_OUT), classes=5, block_bytes=size).collect()
        assert sorted((str(r["doc_id"]), *r[1:5], round(r["base_score"], 6)) for r in got) == slow_base(rows)
        assert all(r["score"] < 0 for r in got)


def test_blocks_do_not_change_the_model(spark):
    rows = corpus(6)
    one, many = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in brown.score(frame(spark, rows), F.expr(HELD_OUT), classes=5, block_bytes=b).collect()}
                 for b in (1 << 23, 1500))
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-6 for k in one)


def test_model_is_a_distribution():
    rng = np.random.default_rng(1)
    k = 4
    matrix = rng.integers(0, 50, (k + 1, k + 1))
    matrix[:, 2] = 0  # an empty class
    rare = np.concatenate((rng.integers(0, 5, k + 1), rng.integers(0, 5, k + 1), [1]))
    rare[k + 1 + 2] = 0
    table = brown.transitions(matrix, rare, k, 0.1)
    size = np.maximum(matrix.sum(0), 1)
    # words of a class share its counts, so p(class) is the cell times the class's count
    total = (10 ** table[:, :k + 1] * size).sum(1) + 10 ** table[:, k + 1]
    assert np.allclose(total, 1)


def test_exchange_finds_word_classes(spark):
    import random

    rng = random.Random(3)
    nouns, verbs = [f"n{i}" for i in range(30)], [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(x for _ in range(40) for x in (rng.choice(nouns), rng.choice(verbs))), "en", "a", 1) for i in range(60)]
    got = brown.score(frame(spark, rows), F.expr(HELD_OUT), classes=2, rounds=4).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    # knowing the class halves the choice at every word
    assert 10 ** (-got["s"] / got["n"]) < 0.65 * 10 ** (-got["b"] / got["n"])


def test_held_out_beats_base(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = brown.score(rows, F.expr(HELD_OUT)).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


def test_no_rows_and_nothing_to_learn_from(spark):
    assert brown.score(frame(spark, []), F.expr(HELD_OUT)).collect() == []
    got = brown.score(frame(spark, corpus(6)), F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)


def test_packed_contexts_come_back():
    keys, counts = np.array([0, 3, 65, 66 * 3 + 2]), np.array([1, 254, 255, 70000])
    word, context, count = brown.Contexts.unpacked(brown.Contexts.packed(keys, counts, 66, 5), 66)
    assert (word * 66 + context).tolist() == keys.tolist() and count.tolist() == counts.tolist()
    ids = np.array([0, 65535, 65536, (1 << 24) - 1])
    assert brown.unpack_ids(brown.pack_ids(ids), 4).tolist() == ids.tolist()
    for far in ([], [5, 1 << 24, (1 << 24) + 5, (1 << 31) - 1]):
        ids = np.array(far, np.int64)
        assert brown.unpack_ids(brown.pack_ids(ids), len(far)).tolist() == far


def test_more_passes_are_better_until_they_settle(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    total = [brown.score(rows, F.expr(HELD_OUT), rounds=n).where("held_out").agg(F.sum("score")).first()[0] for n in (1, 12)]
    assert total[1] > total[0]
    # a tolerance that no pass reaches ends after the first
    once = brown.score(rows, F.expr(HELD_OUT), settled=1e9).where("held_out").agg(F.sum("score")).first()[0]
    assert abs(once - total[0]) < 1e-6
