import random

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.ruletable import apply_rules, rule_table
from shiftloom.plans import rule_tables as R
from shiftloom.plans import rules_as_tables as RT
from shiftloom.plans import schedule as S
from tests.conftest import plan, rows

SCHEMA = "a string, b string, n long"


def holds(test, arg, value):
    if test == "any":
        return True
    if test == "null":
        return value is None
    if value is None or arg is None:
        return False
    return {"in": value == arg, "starts": value.startswith(arg), "ends": value.endswith(arg)}[test]


def random_rules(rng, n):
    word = lambda: "".join(rng.choice("ab|:1") for _ in range(rng.randint(0, 3)))
    rules = []
    for _ in range(n):
        tests = {x: (t, word() if rng.random() > 0.03 else None) for x in "ab" if (t := rng.choice(["any", "in", "starts", "ends", "null"]))}
        rules.append((tests, {"out": rng.choice(["x", "y", "z"]) + str(rng.randrange(99))}))
    data = [(word() if rng.random() > 0.1 else None, word() if rng.random() > 0.1 else None, i) for i in range(150)]
    return rules, data


@pytest.mark.parametrize("seed, n, last", [(1, 40, False), (2, 60, True), (3, 3, False)])
def test_random_rules(spark, seed, n, last):
    rules, data = random_rules(random.Random(seed), n)
    table = rule_table(spark, ["a", "b"], ["out"], rules)
    got = spark.createDataFrame(data, SCHEMA).transform(apply_rules(table, ["a", "b"], {"out": F.lit("none")}, last))
    for r in got.collect():
        met = [v["out"] for t, v in rules if all(holds(*t[x], r[x]) for x in "ab")]
        assert r["out"] == ((met[-1] if last else met[0]) if met else "none"), r


def test_tables_equal_the_wired_rules(spark):
    codes = [(c,) for c in ["L1", "M1", "VA", "T", "t", "COM", "COM(s)", "xct", "fa", "mpl", "E2", "wri", "ml", "N9", "M", "", None, "V1"]]
    df = spark.createDataFrame(codes, "code string")
    for ruleset in R.CODE_RULESETS:
        wired = df.select("code", S.code_group("code", ruleset).alias("codes_group"))
        table = df.transform(apply_rules(RT.code_rules(spark, ruleset), ["code"], {"codes_group": F.lit(R.DEFAULT_GROUP)}))
        assert rows(table) == rows(wired)
    lobs = spark.createDataFrame([(x,) for x in ["CO - Customer Support", "CO - GTM", "CO -", "CO", "Non-Rec", "x", None]], "lob string")
    assert rows(lobs.transform(apply_rules(RT.unit_rules(spark), ["lob"], {"unit": F.col("lob")}))) == rows(lobs.withColumn("unit", S.business_unit("lob")))
    pairs = [(u, f, "own") for u in ["LERT", "CUSTOMER_SUPPORT", "COMMUNITY_OPS", "x", None] for f in [*R.COMMUNITY_FLOWS, "LERT", "IDVAAS", "x", None]]
    df = spark.createDataFrame(pairs, "unit string, flow string, lob string")
    for after in (False, True):
        table = df.transform(apply_rules(RT.lob_rules(spark, after), ["unit", "flow"], {"lob": F.col("lob")}, last=True))
        assert rows(table) == rows(df.withColumn("lob", S.line_of_business("unit", "flow", "lob", after)))


def test_the_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([("r7", None, 1), ("r1999", None, 2), ("s", None, 3)], SCHEMA)
    sizes = []
    for n in (10, 2000):
        table = spark.range(n).select(F.col("id").alias("priority"), F.lit("in").alias("a_test"), F.concat(F.lit("r"), "id").alias("a"),
                                      F.col("id").cast("string").alias("out"))
        got = df.transform(apply_rules(table, ["a"], {"out": None}))
        sizes.append(len(plan(got)))
        assert "NestedLoop" not in plan(got)
    assert rows(got.select("n", "out")) == [(1, "7"), (2, "1999"), (3, None)]
    assert abs(sizes[0] - sizes[1]) < 200


def test_no_rules_and_odd_rules(spark):
    df = spark.createDataFrame([("x", None, 1)], SCHEMA)
    assert rows(df.transform(apply_rules(rule_table(spark, ["a"], ["out"], []), ["a"], {"out": F.lit("d")}))) == [("x", None, 1, "d")]
    with pytest.raises(ValueError, match="unknown test"):
        apply_rules(rule_table(spark, ["a"], ["out"], [({"a": ("like", "x")}, {"out": "y"})]), ["a"], {"out": None})
