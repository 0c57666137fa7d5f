"""Readers and sinks on files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftloom.session import scratch_path
from shiftloom.sources import readers, schemas, writers
from tests.conftest import plan, rows


def write(path, *lines, encoding="utf-8"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return str(path)


def test_csv_by_name_with_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "a.csv", "enterprise_id,unused,hc,hours", "e1,x,1,2.5", "e2,x,bad,", encoding="utf-8-sig")
    df = readers.read_csv(spark, path, {"hours": "double", "enterprise_id": "string", "hc": "int"})
    assert df.dtypes == [("hours", "double"), ("enterprise_id", "string"), ("hc", "int")]
    assert rows(df, "enterprise_id") == [(2.5, "e1", 1), (None, "e2", None)]
    assert "unused" not in plan(df).split("ReadSchema")[-1]
    assert readers.read_csv(spark, path).columns[0] == "enterprise_id"


def test_preamble_is_dropped_in_every_file(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"f{i}.csv", "Daily export", "User Name,Event Name", f'"u{i}, x",Work', "Daily export,again", "User Name,Event Name")
    df = readers.read_below_preamble(spark, str(tmp_path), 1)
    assert df.columns == ["User Name", "Event Name"]
    # data lines that look like the lines above the header are kept
    assert rows(df).count(("Daily export", "again")) == 3 and rows(df).count(("User Name", "Event Name")) == 3
    assert df.count() == 9 and ("u1, x", "Work") in rows(df)
    picked = readers.read_below_preamble(spark, [str(tmp_path / "f0.csv"), str(tmp_path / "f2.csv")], 1, ["Event Name"])
    assert picked.columns == ["Event Name"] and picked.count() == 6
    with pytest.raises(ValueError):
        readers.read_below_preamble(spark, str(tmp_path / "f0.csv"), 99)


def test_preamble_with_many_blocks(spark, tmp_path):
    path = write(tmp_path / "big.csv", "title", "n", *[str(i) for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = readers.read_below_preamble(spark, path, 1, multi_line=False)
        assert df.rdd.getNumPartitions() > 3
        assert df.select(F.sum(F.col("n").cast("int")), F.count("n")).first() == (sum(range(5000)), 5000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headerless_and_several_files(spark, tmp_path):
    paths = [write(tmp_path / f"c{i}.csv", f"MF,M{i},text") for i in range(2)]
    df = readers.read_headerless(spark, paths, schemas.CODES)
    assert rows(df) == [("MF", "M0", "text"), ("MF", "M1", "text")]
    headed = [write(tmp_path / f"h{i}.csv", "Username,Day,Status final", f"u{i},2024-01-0{i + 1},Work") for i in range(2)]
    fixed = readers.read_csv(spark, headed, {"Username": "string", "Day": "date", "Status final": "string"})
    assert rows(fixed) == [("u0", dt.date(2024, 1, 1), "Work"), ("u1", dt.date(2024, 1, 2), "Work")]


def test_quotes_breaks_and_empty_texts(spark, tmp_path):
    path = write(tmp_path / "q.csv", "user,status,day", 'a,"1B - SICK LEAVE', '",2024-01-01', 'b,"he said ""x"", y",01/14/2024', 'c,"",1-4-2024', "d,,2024-13-01")
    df = readers.read_csv(spark, path, {"user": "string", "status": "string", "day": "date"})
    assert rows(df, "user") == [
        ("a", "1B - SICK LEAVE\n", dt.date(2024, 1, 1)), ("b", 'he said "x", y', dt.date(2024, 1, 14)),
        ("c", "", dt.date(2024, 1, 4)), ("d", None, None),
    ]
    texts = readers.read_csv_texts(spark, path)
    assert rows(readers.misfits(texts, {"user": "string", "day": "date"})) == [("day", 1)]


def test_columns_in_another_order(spark, tmp_path):
    a, b = write(tmp_path / "a.csv", "Username,Status", "u,Work"), write(tmp_path / "b.csv", "Status,extra,Username", "Off,x,v")
    df = readers.read_csv(spark, [b, a], {"Username": "string", "Status": "string"}, ingest_seq=True)
    assert [tuple(r)[:2] for r in df.orderBy("ingest_seq").collect()] == [("v", "Off"), ("u", "Work")]
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="no column"):
        readers.read_csv(spark, [a, b], {"extra": "string"})


def test_what_is_written_comes_back(spark, tmp_path):
    given = [(1, 'a "b", c\n\nd'), (2, ""), (3, None), (4, "  x  "), (5, "back\\slash\\"), (6, '"'), (7, ","), (8, "tab\t")]
    writers.write_csv(spark.createDataFrame(given, "n int, s string"), str(tmp_path / "csv"))
    assert rows(readers.read_csv(spark, str(tmp_path / "csv"), {"n": "int", "s": "string"})) == given


def test_preamble_and_records_over_several_lines(spark, tmp_path):
    for i in range(2):
        write(tmp_path / f"f{i}.csv", "title", "user,note", f'u{i},"two', 'lines, ""quoted"""', f"v{i},")
    df = readers.read_below_preamble(spark, str(tmp_path), 1)
    assert rows(df) == [("u0", 'two\nlines, "quoted"'), ("u1", 'two\nlines, "quoted"'), ("v0", None), ("v1", None)]


def test_parquet_pruning(spark, tmp_path):
    spark.range(5).select("id", (F.col("id") * 2).alias("b"), F.lit("x").alias("c")).write.parquet(str(tmp_path / "p"))
    df = readers.read_parquet(spark, str(tmp_path / "p"), ["b"]).where("b > 2")
    assert "ReadSchema: struct<b:bigint>" in plan(df) and "PushedFilters: [IsNotNull(b), GreaterThan(b,2)]" in plan(df)
    assert readers.read_parquet(spark, [str(tmp_path / "p")]).count() == 5


def test_latest_replaces_and_snapshots_add(spark, tmp_path):
    latest, history = str(tmp_path / "latest"), str(tmp_path / "history")
    for n, d in ((3, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (4, dt.date(2024, 1, 2))):
        df = spark.range(n)
        writers.write_latest(df, latest)
        writers.write_snapshot(df, history, d)
    assert spark.read.parquet(latest).count() == 4
    counts = spark.read.parquet(history).groupBy("run_date").count()
    assert rows(counts) == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 4)]


def test_uncompressed_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, s string")
    writers.write_latest(df, str(tmp_path / "plain"), compression="none")
    files = [f.name for f in (tmp_path / "plain").iterdir() if f.name.startswith("part")]
    assert files and not any("snappy" in f for f in files)
    writers.write_csv(df, str(tmp_path / "csv"))
    assert rows(readers.read_csv(spark, str(tmp_path / "csv"), {"n": "int", "s": "string"})) == [(1, "a,b"), (2, None)]


def test_scratch_folder_is_the_one_of_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x") and (base is None or path.startswith(base))


def test_schemas():
    assert schemas.sheet(["45290"]).names[-2:] == ["SHIFT BLOCK", "45290"] and len(schemas.SHEET_STATIC) == 17
    assert len(schemas.BILLED_HOURS_COLUMNS) == 26 and len(schemas.WEEKLY_ROSTER_COLUMNS) == 17


def test_runtime_defaults_can_be_set_on_any_session(spark):
    from shiftloom.session import DEFAULTS, STATIC, configure

    assert all(spark.conf.isModifiable(k) for k in DEFAULTS) and not any(spark.conf.isModifiable(k) for k in STATIC)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    configure(spark)  # what the session was built with is left alone
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
