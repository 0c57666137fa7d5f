"""Checks taken in the pass that writes."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftloom import jobs
from shiftloom.operators.checks import Watch, duplicate_keys
from tests.conftest import plan, rows
from tests.test_schedule_fact import RUN, inputs  # noqa: F401  (fixture)

TYPES = "k string, d int, v string"


def watched(df, tmp_path_factory, **options):
    watch = Watch(["k", "d"], {"low": F.col("d") < 1}, ["v"], **options)
    watch.over(df).write.parquet(str(tmp_path_factory.mktemp("w") / "t"))
    return watch


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0, 1, None]), st.sampled_from(["x", "y", "", None]))))
def test_counts_equal_those_of_the_rows(spark, tmp_path_factory, data):
    watch = watched(spark.createDataFrame(data, TYPES).repartition(3), tmp_path_factory)
    keyed = [(k, d) for k, d, _ in data if k is not None and d is not None]
    assert (watch.rows, watch.keyless, watch.count("low")) == (len(data), len(data) - len(keyed), sum(d == 0 for _, d, _ in data))
    assert watch.values("v") == dict(Counter(v for *_, v in data))
    assert watch.surplus == len(keyed) - len(set(keyed))  # few keys are counted exactly


def test_a_column_of_many_values_is_given_up(spark, tmp_path_factory):
    for n, listed in ((Watch.MOST - 1, True), (Watch.MOST, False), (20 * Watch.MOST, False)):
        df = spark.range(4 * n).select(F.lit("a").alias("k"), F.lit(1).alias("d"), (F.col("id") % n).cast("string").alias("v"))
        got = watched(df, tmp_path_factory).values("v")
        assert (got == {str(i): 4 for i in range(n)}) if listed else got is None


def test_estimate_of_repeated_keys(spark, tmp_path_factory):
    df = spark.range(40000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("d"), F.lit("v").alias("v"))
    assert watched(df, tmp_path_factory).surplus < 2000
    assert 18000 < watched(df.union(df.where("CAST(k AS INT) < 20000")), tmp_path_factory).surplus < 22000


def test_nothing_watched(spark):
    with pytest.raises(ValueError):
        Watch(["k"]).rows


def test_schedule_job_reads_the_fact_no_second_time(spark, inputs, tmp_path):  # noqa: F811
    for publish in (False, True):
        folder = tmp_path / str(publish)
        report = jobs.run_schedule(spark, inputs, RUN, str(folder / "latest"), str(folder / "export"), publish=publish)
        assert report.watch.rows == report.fact.count()
        assert report.watch.values("value") == {r["value"]: r["count"] for r in report.fact.groupBy("value").count().collect()}
        assert {r["value"] for r in report.codes.collect()} == {r["value"] for r in report.fact.select("value").distinct().collect()}
        assert "FileScan" not in plan(report.codes)
        assert report.watch.surplus == 0 and rows(report.fact.transform(duplicate_keys(["EID", "date"]))) == []
        if not report.watch.count("gone"):
            assert "FileScan" not in plan(report.working_after_exit)
