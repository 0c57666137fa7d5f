import random

from pyspark.sql import functions as F

from shiftloom.llm import mixing

from .helpers import corpus, frame, prose, words


def docs(n=600):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        text = prose(rng, rng.randint(20, 80))
        if i % 9 == 0:
            text += " | cell | cell"
        rows.append((i, text, "en" if i % 3 else "de", "big" if i % 2 else f"s{i % 7}", 1))
    return rows


def test_rake_equals_brute_force(spark):
    df = frame(spark, docs())
    got = mixing.drawn(df)
    cells = {tuple(r[k] for k in mixing.KEYS): r for r in got.groupBy(*mixing.KEYS).agg(
        F.sum(mixing.tokens_of(F.col("text"))).alias("t"), F.max("__p").alias("p")).collect()}
    tokens = {k: r["t"] for k, r in cells.items()}
    total = sum(tokens.values())
    want, shares = dict(map(lambda x: (x[0], float(x[1])), tokens.items())), []
    for d, power in enumerate(mixing.POWERS.values()):
        have = {}
        for k, t in tokens.items():
            have[k[d]] = have.get(k[d], 0) + t
        z = sum(h ** power for h in have.values())
        shares.append({v: (h ** power / z, h) for v, h in have.items()})
    budget = mixing.SLACK * min(h / s for x in shares for s, h in x.values())
    for _ in range(400):
        for d, x in enumerate(shares):
            sums = {}
            for k, w in want.items():
                sums[k[d]] = sums.get(k[d], 0) + w
            want = {k: min(w * x[k[d]][0] * budget / sums[k[d]], tokens[k]) for k, w in want.items()}
    assert total > budget > 0.5 * total
    assert all(abs(cells[k]["p"] * tokens[k] - w) <= 0.03 * w for k, w in want.items())


def test_draws_follow_the_probabilities(spark):
    out = mixing.report(frame(spark, docs(4000)))
    assert out.count() == 4000
    r = out.agg(F.sum("probability").alias("p"), F.sum(F.col("selected").cast("int")).alias("n"), F.max("probability").alias("m")).first()
    assert abs(r["p"] - r["n"]) < 120 and r["m"] <= 1
    again = mixing.report(frame(spark, docs(4000)).repartition(7))
    assert sorted(map(tuple, out.select("doc_id", "selected").collect())) == sorted(map(tuple, again.select("doc_id", "selected").collect()))


def test_edges(spark):
    rows = corpus(2)
    out = mixing.report(frame(spark, rows)).collect()
    assert sorted(str((r["doc_id"], r["tokens"])) for r in out) == sorted(str((r[0], len(words(r[1])) + 1)) for r in rows)
    assert all(r["probability"] is not None for r in out)
    df = frame(spark, rows).withColumnRenamed("n_chars", "weight")
    kept = mixing.mix(df)
    assert kept.columns == df.columns and 0 < kept.count() <= len(rows)
    assert mixing.mix(frame(spark, [])).collect() == []


def test_own_topic_and_no_python(spark):
    df = frame(spark, docs())
    out = mixing.drawn(df, topic=F.when(F.col("doc_id") % 5 == 0, F.lit("fives")))
    assert {r[0] for r in out.select("__topic").distinct().collect()} == {None, "fives"}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_document_of_a_new_source_beside_large_ones(spark):
    rows = [(i, "w " * 500, "en" if i % 3 else "de", f"s{i % 20}", 1) for i in range(2000)] + [(9999, "a few words", "en", None, 1)]
    df = frame(spark, rows)
    out = mixing.drawn(df).withColumn("t", mixing.tokens_of(F.col("text")))
    total, taken = out.agg(F.sum("t"), F.sum(F.col("t") * F.col("__p"))).first()
    assert taken > 0.65 * total
    assert [(r["__p"], r["__drawn"]) for r in out.where("doc_id = 9999").collect()] == [(1.0, True)]
    found = {(r["dim"], r["value"]): r for r in mixing.marginals(df).collect()}
    assert [k for k, r in found.items() if not r["met"]] == [("source", None)]
    assert found["source", None]["taken"] == found["source", None]["have"] == 4
