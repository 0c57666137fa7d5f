import datetime as dt

import pytest

from shiftloom.sources import layouts, quarantine, readers
from shiftloom.sources.published import read_published
from tests.conftest import rows
from tests.test_sources import write

COLUMNS = {"user": "string", "day": "date", "n": "int"}


def test_every_misfit_is_named(spark, tmp_path):
    a = write(tmp_path / "a.csv", "user,day,n", "u1,2024-01-01,1", "u2,13.01.2024,x", 'u3,"two', 'lines",3', "u4,2024-01-02", "u5,,", "u6,1/2/2024,4,5", "")
    b = write(tmp_path / "b.csv", "n,day,user", "7,2024-99-99,v", encoding="utf-8-sig")
    records = quarantine.read_records(spark, [a, b], list(COLUMNS))
    found = quarantine.misfit_rows(quarantine.audit(records, COLUMNS))
    got = [(r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([
        ("a.csv", 2, "day", "13.01.2024", "type"), ("a.csv", 2, "n", "x", "type"), ("a.csv", 3, "day", "two\nlines", "type"),
        ("a.csv", 4, None, "u4,2024-01-02", "fields"), ("a.csv", 6, None, "u6,1/2/2024,4,5", "fields"), ("b.csv", 1, "day", "2024-99-99", "type"),
    ], key=str)


def test_nothing_is_lost(spark, tmp_path):
    lines = [f"u{i},{'bad' if i % 9 == 0 else '2024-01-01'},{i}{',x' if i % 13 == 0 else ''}" for i in range(500)]
    path = write(tmp_path / "a.csv", "user,day,n", *lines)
    feed, bad = str(tmp_path / "feed"), str(tmp_path / "bad")
    got = quarantine.land(spark, path, COLUMNS, feed, bad, max_share=0.5)
    wrong = {i for i in range(500) if i % 9 == 0 or i % 13 == 0}
    assert (got.records, got.rejected) == (500, len(wrong))
    assert {r["n"] for r in got.feed.collect()} == set(range(500)) - wrong
    assert {int(r["texts"]["user"][1:]) for r in got.quarantine.collect()} == wrong
    assert {r["record"] for r in got.quarantine.collect()} == {i + 1 for i in wrong}


def test_a_feed_with_too_many_misfits_replaces_nothing(spark, tmp_path):
    feed, bad = str(tmp_path / "feed"), str(tmp_path / "bad")
    quarantine.land(spark, write(tmp_path / "a.csv", "user,day,n", "u,2024-01-01,1"), COLUMNS, feed, bad)
    with pytest.raises(quarantine.TooManyMisfits, match="2 of 3"):
        quarantine.land(spark, write(tmp_path / "b.csv", "user,day,n", "u,x,1", "v,2024-01-01,y", "w,2024-01-01,1"), COLUMNS, feed, bad)
    assert rows(read_published(spark, feed)) == [("u", dt.date(2024, 1, 1), 1)] and read_published(spark, bad).count() == 0
    empty = quarantine.land(spark, write(tmp_path / "c.csv", "user,day,n"), COLUMNS, feed, bad)
    assert (empty.records, empty.rejected) == (0, 0) and empty.feed.count() == 0


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_record_numbers_over_blocks(spark, tmp_path, small_blocks):
    path = write(tmp_path / "a.csv", "user,day,n", *[f"u{i},2024-01-01,{i}" for i in range(2000)])
    records = quarantine.read_records(spark, path)
    assert records.rdd.getNumPartitions() > 1
    assert all(r["record"] == int(r["n"]) + 1 for r in records.collect()) and records.count() == 2000


def test_files_are_split_where_no_text_spans_lines(spark, tmp_path, small_blocks):
    plain = write(tmp_path / "a.csv", "user,note", *[f'u{i},"a ""b"", c{i}"' for i in range(1000)])
    broken = write(tmp_path / "b.csv", "user,note", *[f'u{i},"a\n""b"", c{i}"' for i in range(1000)])
    for path, splits, text in ((plain, True, 'a "b", c'), (broken, False, 'a\n"b", c')):
        df = readers.read_csv_texts(spark, path)
        assert (df.rdd.getNumPartitions() > 1) == splits
        assert rows(df) == sorted((f"u{i}", f"{text}{i}") for i in range(1000))
    assert readers.may_break_lines(spark, plain, "UTF-16LE")
    titled = write(tmp_path / "c.csv", "title", "user,note", *[f"u{i},x{i}" for i in range(2000)])
    below = readers.read_below_preamble(spark, titled, 1)
    assert below.rdd.getNumPartitions() > 1 and rows(below) == sorted((f"u{i}", f"x{i}") for i in range(2000))


def test_small_files_are_not_looked_at(spark, tmp_path):
    assert readers.may_break_lines(spark, write(tmp_path / "a.csv", "user,note", "u,v"))


def test_layout_of_a_column(spark):
    texts = spark.createDataFrame(
        [("03/04/2024", "03/04/2024", "1.2.2024", "", "2024-01-01"), ("25/12/2024", "12/25/2024", None, " ", "1/2/2024"),
         (" 1/1/2024 ", "1/1/2024", "31.12.2024", None, "2024-05-05")], "dayfirst string, monthfirst string, dots string, nothing string, mixed string")
    got = layouts.conform_by_layout(texts, {c: "date" for c in texts.columns})
    assert got.layouts == {"dayfirst": "d/M/yyyy", "monthfirst": "M/d/yyyy", "dots": "d.M.yyyy", "nothing": "yyyy-MM-dd", "mixed": "yyyy-MM-dd"}
    assert got.verdicts["mixed"] == "mixed" and got.verdicts["nothing"] == "empty" and got.verdicts["dayfirst"] == "certain"
    d = dt.date
    assert rows(got.rows, "dayfirst") == [
        (d(2024, 1, 1), d(2024, 1, 1), d(2024, 12, 31), None, d(2024, 5, 5)), (d(2024, 4, 3), d(2024, 3, 4), d(2024, 2, 1), None, d(2024, 1, 1)),
        (d(2024, 12, 25), d(2024, 12, 25), None, None, None)]


def test_ambiguous_columns_are_reported(spark):
    texts = spark.createDataFrame([("03/04/2024", "x"), ("05/06/2024", "y")], "day string, odd string")
    with pytest.raises(layouts.Undecided, match="ambiguous.*d/M/yyyy"):
        layouts.conform_by_layout(texts, {"day": "date"})
    with pytest.raises(layouts.Undecided, match="unknown"):
        layouts.conform_by_layout(texts, {"odd": "date"})
    got = layouts.conform_by_layout(texts, {"day": "date", "odd": "string"}, assume={"day": "d/M/yyyy"})
    assert rows(got.rows) == [(dt.date(2024, 4, 3), "x"), (dt.date(2024, 6, 5), "y")]
    with pytest.raises(layouts.Undecided, match="not written"):
        layouts.conform_by_layout(texts, {"day": "date"}, assume={"day": "d.M.yyyy"})
