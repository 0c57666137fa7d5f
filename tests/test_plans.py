"""Physical plans: what is pushed down, shuffled, split and kept out of Python."""

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import aggregates, joins
from shiftloom.operators.joins import SLICE, hot_slices, join_back, lookup, row_counts, spread
from shiftloom.operators.timeline import Timeline
from shiftloom.plans.roster import adjusted_hours
from tests.conftest import plan, rows


@pytest.fixture
def no_static_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def skewed(spark, tmp_path, n=30_000):
    """A third of all rows belong to one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997)
    spark.range(0, n, 1, 16).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(str(tmp_path / "s"))
    return spark.read.parquet(str(tmp_path / "s"))


def test_totals_join_spreads_a_hot_key(spark, tmp_path, no_static_broadcast):
    """Slices take the hot key apart; nothing is lost or doubled, keyless rows included."""
    df = skewed(spark, tmp_path)
    df = df.withColumn("k", F.when(F.col("id") % 7 > 0, F.col("k")))
    counts = row_counts(df, ["k"])
    hot = hot_slices(counts, ["k"], per_slice=1000)
    assert [r["k"] for r in hot.collect()] == [-1]
    sizes = {(r["k"], r[SLICE]): r["count"] for r in spread(df, ["k"], hot).groupBy("k", SLICE).count().collect()}
    for key in (-1, None):
        mine = [n for (k, _), n in sizes.items() if k == key]
        assert len(mine) > 5 and max(mine) < sum(mine) / 4
    out = df.transform(join_back(["k"], {"n": F.count(F.lit(1)), "s": F.sum("id")}, per_slice=1000))
    want = df.join(df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")), "k", "left")
    assert rows(out.select("id", "k", "n", "s"), "id") == rows(want.select("id", "k", "n", "s"), "id")
    joins_in_plan = [x for x in plan(out).splitlines() if "SortMergeJoin" in x]
    assert len(joins_in_plan) == 1 and SLICE in joins_in_plan[0]


def test_member_flag_uses_slices(spark, no_static_broadcast):
    df = spark.range(50).select((F.col("id") % 5).alias("k"))
    table = spark.range(3).select(F.col("id").alias("key"), F.lit("x").alias("name"), F.col("id").alias("seq"))
    flagged = df.transform(joins.member_flag(table, "k", "key", "f"))
    assert flagged.agg(F.sum("f"), F.count("k")).first() == (30, 50) and SLICE in plan(flagged)


def test_totals_are_combined_before_the_shuffle(spark, tmp_path):
    text = plan(skewed(spark, tmp_path, 300).transform(aggregates.group_sum(["k"], ["id"])))
    assert text.count("HashAggregate") == 2 and "partial_sum" in text and "SortAggregate" not in text


def test_timeline_has_one_shuffle_of_its_rows(spark, tmp_path, no_static_broadcast):
    line = Timeline(["k"], ["id"], F.col("id"))
    df = skewed(spark, tmp_path)
    split = line.split(df)
    out = line.first_where(line.fill_forward(split, {"f": "pad"}), {"m": (F.col("id") > 5, "id")})
    exchanges = [x for x in plan(out).splitlines() if "Exchange hashpartitioning(k" in x and "__chunk" in x and "pad" not in x]
    # rows once; the rest are chunk borders, which start from a filter on the list of hot keys
    windows = plan(out).count("+- Window")
    assert windows >= 2 and len(exchanges) <= 6
    assert "BroadcastHashJoin" in plan(split) and "CartesianProduct" not in plan(out) and "NestedLoop" not in plan(out)


def test_no_border_work_without_hot_keys(spark, tmp_path):
    line = Timeline(["k"], ["id"], F.col("id"))
    out = line.unsplit(line.fill_forward(line.split(skewed(spark, tmp_path, 3000)), {"f": "pad"}))
    qe = out._jdf.queryExecution()
    out._jdf.collectAsList()
    final = qe.executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Window [") + final.count("Window (") <= 1 and "SortAggregate" not in final


def test_short_lists_are_broadcast_and_long_ones_split(spark, tmp_path):
    table = spark.range(10).select(F.col("id").cast("string").alias("code"), F.lit("x").alias("name"), F.col("id").alias("seq"))
    fact = spark.range(100).select((F.col("id") % 3).cast("string").alias("c"))
    assert "BroadcastHashJoin" in plan(fact.transform(lookup(table, "c", "code", {"name": "n"}, order=["seq"])))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spark.range(0, 60_000, 1, 6).select(
            F.when(F.col("id") % 3 > 0, F.lit("0")).otherwise((F.col("id") % 9).cast("string")).alias("c"), F.uuid().alias("pad")
        ).write.parquet(str(tmp_path / "fact"))
        hot = spark.read.parquet(str(tmp_path / "fact")).transform(lookup(table, "c", "code", {"name": "n"}, order=["seq"]))
        run = hot.select("c", "pad", "n")
        qe = run._jdf.queryExecution()
        run._jdf.collectAsList()
        assert "SortMergeJoin(skew=true)" in qe.executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_adjustments(spark, tmp_path):
    """One (employee, day) with a third of all rows: the totals are the same as by hand."""
    df = skewed(spark, tmp_path, 3000).select(
        F.col("k").alias("e"), F.lit(1).alias("d"), (F.col("id") % 2).alias("s"), (F.col("id") % 2).alias("hc"),
        F.lit(1.0).alias("h"), F.lit(9.0).alias("fallback"), F.col("id").alias("ingest_seq"))
    got = df.transform(adjusted_hours(["e", "d"], "s", measures={"h": "fallback"}))
    assert {r["h"] for r in got.where("e = -1").collect()} == {500.0} and got.where("e = -1").count() == 2


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.col("id").alias("v"), F.lit("x").alias("unused")).write.parquet(path)
    other = spark.read.parquet(path).select(F.col("id").alias("rid"), F.col("v").alias("w"))
    df = spark.read.parquet(path).where("v > 3").transform(joins.left_join_on(other, {"id": "rid"})).select("id", "w")
    text = plan(df)
    assert "GreaterThan(v,3)" in text and "unused" not in text
    assert rows(df)[0] == (4, 4)
