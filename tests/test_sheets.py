import pytest

from shiftloom.queries import queries
from shiftloom.sources import sheets
from tests.conftest import plan, rows
from tests.test_sources import write


def test_sheets_with_other_days_and_other_order(spark, tmp_path):
    a = write(tmp_path / "a.csv", "EID,NAME,45290,45291", 'u1,"x, y",M,', "u2,z,L1,E", encoding="utf-8-sig")
    b = write(tmp_path / "b.csv", "1/1/2024,1/2/2024,1/3/2024,NAME,EID,WW01,1/1/2024", "M,,N,n,u1,5,again", "A,B")
    got = sheets.read_sheets(spark, [a, b], ["EID", "NAME"], skip="^WW")
    want = [
        ("a", 2, "u1", "x, y", "45290", "M"), ("a", 2, "u1", "x, y", "45291", None), ("a", 3, "u2", "z", "45290", "L1"), ("a", 3, "u2", "z", "45291", "E"),
        ("b", 2, "u1", "n", "1/1/2024", "M"), ("b", 2, "u1", "n", "1/1/2024", "again"), ("b", 2, "u1", "n", "1/2/2024", None), ("b", 2, "u1", "n", "1/3/2024", "N"),
        *[("b", 3, None, None, h, v) for h, v in (("1/1/2024", "A"), ("1/1/2024", None), ("1/2/2024", "B"), ("1/3/2024", None))],
    ]
    assert sorted(((r[0].rsplit("/", 1)[1][0], *tuple(r)[1:]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_header_below_a_preamble_and_records_over_lines(spark, tmp_path):
    a = write(tmp_path / "a.csv", "Title", "EID,d1", 'u1,"two', 'lines"')
    got = sheets.read_sheets(spark, a, ["EID"], header=1)
    assert rows(got.select("EID", "header", "value")) == [("u1", "d1", "two\nlines")]


def test_a_sheet_without_an_id_is_an_error(spark, tmp_path):
    a, b = write(tmp_path / "a.csv", "EID,d1", "u1,M"), write(tmp_path / "b.csv", "d1,d2", "M,N")
    with pytest.raises(Exception, match="no column EID in .*b.csv"):
        sheets.read_sheets(spark, [a, b], ["EID"]).collect()


def test_the_plan_does_not_grow_with_the_sheets(spark, tmp_path):
    paths = [write(tmp_path / f"s{i:02d}.csv", "EID,d%d" % i, "u,M") for i in range(40)]
    few, many = (sheets.read_sheets(spark, p, ["EID"]) for p in (paths[:2], paths))
    import re

    size = lambda df: len(re.sub(r"(Location|Batched|\[file).*", "", plan(df)))
    assert size(few) == size(many)
    assert rows(many.select("header")) == sorted((f"d{i}",) for i in range(40))


def test_no_records(spark, tmp_path):
    assert sheets.read_sheets(spark, write(tmp_path / "a.csv", "EID,d1"), ["EID"]).count() == 0


def test_bucketed_joins_and_windows_run_in_place(spark):
    df = queries()["bucketed_fact"](spark, "/root/testdata/sf0.001")
    text = plan(df)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2 and "Window" in text
    df.collect()
    assert "Exchange" not in plan(df)  # after adaptive execution too
