"""Readers. Sheets are landed as CSV or Parquet; a list of paths is one frame."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.functions.dates import parse_any_date
from shiftloom.operators.projection import q

BOM = "\ufeff"


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet, read for the wanted columns only."""
    df = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    return df if columns is None else df.select(*[q(c) for c in columns])


# Feeds write dates in these ways; each text fits one of them at most.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "M-d-yyyy")
EMPTY = "\ue000"  # stands for a quoted empty text while a file is read, as Spark takes "" for null


def _csv(spark: SparkSession, multi_line: bool, encoding: str = "UTF-8"):
    return (
        spark.read.option("quote", '"').option("escape", '"').option("emptyValue", EMPTY)
        .option("encoding", encoding).option("multiLine", multi_line)
    )


def may_break_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> bool:
    """Whether a quoted text of the files may hold a line break, so that they cannot be split.

    The line in which such a text opens has an odd number of quotes, and a file in which
    every line has an even number has none. Files that fit one task anyway, and
    encodings in which a quote is more than one byte, are not looked at: they may.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    size = int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    block = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if size <= block or encoding.upper() not in ("UTF-8", "US-ASCII", "ASCII", "ISO-8859-1", "LATIN1"):
        return True
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
    return not lines.where(odd).isEmpty()


def _lines_in(spark: SparkSession, path: str | Sequence[str], multi_line: bool | None, encoding: str = "UTF-8") -> bool:
    return may_break_lines(spark, path, encoding) if multi_line is None else multi_line


def _text(c: Column) -> Column:
    return F.when(c == EMPTY, F.lit("")).otherwise(c)


def read_csv_texts(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                   encoding: str = "UTF-8", multi_line: bool | None = None, ingest_seq: bool = False) -> DataFrame:
    """CSV with a header, by column name, all columns as text.

    Quotes inside quoted texts are doubled, line breaks may stand inside quotes, and an
    empty text in quotes is not null. Files without such breaks can be split among tasks:
    ``multi_line`` says whether there may be any; left out, the quotes of files that
    are large enough to be split are counted (:func:`may_break_lines`). A byte order mark before the first
    header is dropped. Every path has its own order of columns; files of one folder must
    have the same header, else reading fails.

    ``ingest_seq`` adds the place of a row: paths in the order given, then rows as they
    stand in the file. Where that order matters, name files and not folders (below
    32,768 paths, and tasks per path).
    """
    frames = []
    for i, p in enumerate([path] if isinstance(path, str) else path):
        raw = _csv(spark, _lines_in(spark, p, multi_line, encoding), encoding).option("header", True).option("enforceSchema", False).csv(p)
        names = {c.lstrip(BOM): c for c in raw.columns}
        wanted = list(names) if columns is None else columns
        missing = [c for c in wanted if c not in names]
        if missing:
            raise ValueError(f"no column {missing} in {p}")
        found = raw.select(*[_text(q(names[c])).alias(c) for c in wanted])
        if ingest_seq:
            found = found.withColumn("ingest_seq", F.lit(i << 48) + F.monotonically_increasing_id())
        frames.append(found)
    return reduce(DataFrame.unionByName, frames)


def typed(c: Column, kind: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A text as a value of the type; null where it does not fit."""
    return parse_any_date(F.trim(c), formats) if kind == "date" else c.try_cast(kind)


def conform(texts: DataFrame, columns: Mapping[str, str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """``{column: type}`` of a frame of texts; its ``ingest_seq`` stays."""
    rest = [c for c in texts.columns if c == "ingest_seq" and c not in columns]
    return texts.select(*[typed(q(c), t, formats).alias(c) for c, t in columns.items()], *rest)


def misfits(texts: DataFrame, columns: Mapping[str, str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """(column, n): how many non-empty texts of each column are null as values."""
    lost = {c: F.count_if((F.trim(q(c)) != "") & typed(q(c), t, formats).isNull()) for c, t in columns.items()}
    counts = texts.agg(F.array(*[F.struct(F.lit(c).alias("column"), n.alias("n")) for c, n in lost.items()]).alias("a"))
    return counts.select(F.inline("a")).where("n > 0")


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str] | None = None,
             encoding: str = "UTF-8", multi_line: bool | None = None, ingest_seq: bool = False) -> DataFrame:
    """:func:`read_csv_texts` with types: ``{column: type}`` picks and types columns.

    Types come from the caller; values that do not fit become null, and
    :func:`misfits` counts them. Dates are read in any of :data:`DATE_FORMATS`.
    """
    texts = read_csv_texts(spark, path, None if columns is None else list(columns), encoding, multi_line, ingest_seq)
    return texts if columns is None else conform(texts, columns)


def read_headerless(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV without a header; columns are named by position."""
    paths = path if isinstance(path, str) else list(path)
    raw = _csv(spark, may_break_lines(spark, paths)).option("header", False).schema(schema).csv(paths)
    return raw.select(*[_text(q(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else q(f.name) for f in schema])


def read_below_preamble(spark: SparkSession, path: str | Sequence[str], header: int,
                        columns: Sequence[str] | None = None, multi_line: bool | None = None) -> DataFrame:
    """Sheet export whose header is line ``header`` (counted from 0), all columns as text.

    The lines above it are dropped in every file. They are found by the ids Spark gives
    to rows in reading order, less the least id of the same file. With ``multi_line``
    records may span lines (the lines up to the header may not) and a file is read by
    one task; without it files are split, and only the lines of a file's first block are
    joined with the place where the file starts; left out, quotes decide as for other
    files. The driver sees one line, the header.
    """
    paths = path if isinstance(path, str) else list(path)
    multi_line = _lines_in(spark, paths, multi_line)
    meta = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.text(paths).select("value", *meta).withColumn("id", F.monotonically_increasing_id())
    first = _from_start(lines.where(F.col("block") == 0))
    head = first.where(F.col("line") == header).select("value").first()
    if head is None:
        raise ValueError(f"no line {header} in {path}")
    names = next(csv.reader([head["value"].lstrip(BOM)]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    wanted = names if columns is None else columns
    if multi_line:
        raw = _csv(spark, True).option("header", False).schema(schema).csv(paths)
        row = F.struct(*[q(n) for n in names]).alias("r")
        records = _from_start(raw.select(row, *meta).withColumn("id", F.monotonically_increasing_id()))
        records = records.where(F.col("line") > header)
    else:
        parsed = F.from_csv("value", ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names),
                            {"escape": '"', "emptyValue": EMPTY}).alias("r")
        rest = lines.where(F.col("block") > 0).select(parsed)
        records = first.where(F.col("line") > header).select(parsed).unionByName(rest)
    return records.select(*[_text(F.col("r").getField(c)).alias(c) for c in wanted])


def _from_start(rows: DataFrame) -> DataFrame:
    """Adds ``line``: the number of a row in its file. The rows of a file's start lie in one task."""
    starts = rows.groupBy("file").agg(F.min("id").alias("start"))
    # one row per file; whether that is small enough to broadcast is for Spark to see
    return rows.join(starts, "file").withColumn("line", F.col("id") - F.col("start"))
