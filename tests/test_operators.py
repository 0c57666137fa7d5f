"""Projections, filters, reshape, joins, aggregates, checks on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.operators import aggregates, checks, filters, joins, projection, reshape, sets
from tests.conftest import rows


def test_header_order_matters(spark):
    assert projection.normalize_header("A - B  C") == "A_B_C"
    assert projection.normalize_header("A - B/C", [("/", "_"), (" ", "_")], lower=True) == "a_-_b_c"
    df = spark.createDataFrame([(1, 2)], "`Time Elapsed` int, `A - B` int")
    assert df.transform(projection.normalize_headers(lower=True)).columns == ["time_elapsed", "a_b"]
    assert df.transform(projection.suffix_headers("_cf")).columns == ["Time Elapsed_cf", "A - B_cf"]


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "EID int, `WW1` int, `Shift Block` int, `45290` int")
    assert df.transform(projection.drop_matching("WW")).columns == ["EID", "Shift Block", "45290"]
    assert df.transform(projection.keep_leading(2)).columns == ["EID", "WW1"]
    assert projection.columns_between(df, "WW1", "45290") == ["WW1", "Shift Block", "45290"]
    assert df.transform(projection.column_ranges((None, "EID"), ("Shift Block", None))).columns == ["EID", "Shift Block", "45290"]
    assert df.transform(projection.drop_columns(["WW1", "nope"])).columns == ["EID", "Shift Block", "45290"]
    with pytest.raises(KeyError):
        df.transform(projection.drop_columns(["nope"], strict=True))


def test_insert_conform_stamp(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    got = df.transform(projection.insert_constants([(0, "p", "CO"), (2, "q", ""), (None, "z", 1)]))
    assert got.columns == ["p", "a", "q", "b", "z"] and got.first() == ("CO", 1, "", "x", 1)
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("n", T.DateType())])
    conformed = df.transform(projection.conform_schema(schema))
    assert conformed.schema == schema and conformed.first() == (None, None)
    stamped = df.transform(projection.stamp({"run": dt.date(2024, 1, 1)}, {"c": "b"})).first()
    assert stamped["c"] == "x" and stamped["run"] == dt.date(2024, 1, 1)
    assert df.transform(projection.add_missing({"b": "int", "d": "date"})).dtypes[-1] == ("d", "date")
    with pytest.raises(Exception):
        df.transform(projection.cast_columns({"b": "int"}, lenient=False)).collect()


def test_filters_keep_or_drop_nulls(spark):
    df = spark.createDataFrame([("0x2a",), (None,), ("n",)], "name string")
    assert rows(df.transform(filters.not_sentinel("name", "0x2a"))) == [(None,), ("n",)]
    assert rows(df.transform(filters.not_in("name", ["n"]))) == [(None,), ("0x2a",)]
    assert rows(df.transform(filters.present("name"))) == [("0x2a",), ("n",)]
    assert rows(df.transform(filters.equals_any("name", ["n", "m"]))) == [("n",)]


def test_unpivot_keeps_nulls_and_mixes_types(spark):
    df = spark.createDataFrame([("a", "M", 1), ("b", None, 2)], "EID string, `45290` string, `45291` int")
    long = df.transform(reshape.unpivot(["EID"]))
    assert rows(long) == [("a", "45290", "M"), ("a", "45291", "1"), ("b", "45290", None), ("b", "45291", "2")]
    back = long.transform(reshape.pivot_groups(["EID"], "date", ["45290", "45291"], F.first("value")))
    assert rows(back) == [("a", "M", "1"), ("b", None, "2")]


@pytest.mark.parametrize("cell, want", [
    ("a.b@................7#c.d", ["a.b", "c.d"]),
    ("a.b", ["a.b"]),
    ("a.b@................7#a.b@................8#e.f", ["a.b", "e.f"]),
    ("a.b@short", ["a.b"]),
    (None, [None]),
])
def test_multi_value_cell(spark, cell, want):
    df = spark.createDataFrame([(1, cell)], "id int, eid string")
    assert [r["eid"] for r in df.transform(reshape.unnest_ids("eid", "eid")).collect()] == want


def test_split_columns_is_literal(spark):
    df = spark.createDataFrame([("a.b",)], "c string").transform(reshape.split_columns("c", ".", ["x", "y", "z"]))
    assert df.first()[1:] == ("a", "b", None)


def test_null_keys_meet_only_when_asked(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, n int")
    right = spark.createDataFrame([(None, "null"), ("a", "x")], "k string, v string")
    assert rows(left.transform(joins.left_join(right, ["k"]))) == [(None, 1, None), ("a", 2, "x")]
    assert rows(left.transform(joins.left_join(right, ["k"], null_safe=True))) == [(None, 1, "null"), ("a", 2, "x")]


def test_lookup_cannot_multiply_rows(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    table = spark.createDataFrame([("a", "2nd", 2), ("a", "1st", 1)], "key string, name string, seq int")
    assert rows(df.transform(joins.lookup(table, "k", "key", {"name": "out"}, order=["seq"]))) == [("a", "1st"), ("b", None)]


def test_member_flag_and_fallback(spark):
    df = spark.createDataFrame([("a", None), ("b", "kept"), (None, None)], "k string, v string")
    other = spark.createDataFrame([("a", "late"), ("a", "late"), (None, "n")], "id string, w string")
    assert rows(df.transform(joins.member_flag(other, "k", "id", "f"))) == [(None, None, 0), ("a", None, 1), ("b", "kept", 0)]
    feed = other.dropDuplicates()
    got = df.transform(joins.late_fallback(feed, {"k": "id"}, {"v": "w"}))
    assert rows(got) == [(None, None), ("a", "late"), ("b", "kept")] and got.columns == ["k", "v"]


def test_sums_and_groups(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2), (None, 5)], "k string, n int")
    assert rows(df.transform(aggregates.group_sum(["k"], ["n"]))) == [("a", 0), ("b", 2)]
    back = df.transform(joins.join_back(["k"], {"s": F.sum("n")}))
    assert rows(back.select("k", "n", "s")) == [(None, 5, None), ("a", None, None), ("a", None, None), ("b", 2, 2)]


def test_time_in_status_counts_equal_rows_once(spark):
    data = [("2024-01-01", "p", "available", "60"), ("2024-01-01", "p", "available", "60"), ("2024-01-01", "p", "available", "30"),
            ("2024-01-01", "p", "meal", "30"), ("2024-01-01", "p", "unavailable", "600")]
    df = spark.createDataFrame(data, "d string, a string, s string, m string")
    once = df.transform(aggregates.time_in_status("d", "a", "s", "m")).first()
    assert (once["available"], once["ts_total_hours"], once["ts_completed_time"], once["coaching"]) == (90.0, 1.5, 2.0, None)
    every = df.transform(aggregates.time_in_status("d", "a", "s", "m", dedupe=False)).first()
    assert every["available"] == 150.0


def test_unions(spark):
    a = spark.createDataFrame([(1, None)], "x int, y string")
    b = spark.createDataFrame([(None, 1), (None, 1)], "y string, x int")
    assert rows(sets.stack_distinct(a, b)) == [(1, None)]
    assert sets.stack(a, spark.createDataFrame([(2,)], "z int")).count() == 2


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, d int")
    assert rows(df.transform(checks.duplicate_keys(["k", "d"]))) == [("a", 1, 2)]
    fact = spark.createDataFrame(
        [("e1", "Analyst", "-", "Work"), ("e2", "Analyst", "-", "Work"), ("e3", "Analyst", "M", "Work"), ("e4", "Trainer", "-", "Work")],
        "EID string, ROLE string, value string, rta_status string")
    assert rows(fact.transform(checks.exit_check(["e2"]))) == [("e1",)]
    assert rows(fact.transform(checks.distinct_values("value"))) == [("-",), ("M",)]
