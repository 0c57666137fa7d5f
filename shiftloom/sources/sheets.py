"""Sheets of several periods in one scan, each with day columns of its own.

Every file's header row travels as an array beside the records of the file, and cells find
their names by position. So a hundred sheets with different days are one scan and one
plan, as wide as the widest sheet; nothing is a union of wide frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.sources import readers
from shiftloom.sources.quarantine import FILE, RECORD, numbered

HEADERS_MB = 32  # header rows up to here are broadcast: files x columns x NAME_BYTES
NAME_BYTES = 48


def _meta() -> tuple[Column, Column]:
    return F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block")


def widest(spark: SparkSession, paths: Sequence[str], header: int = 0) -> int:
    """Columns of the widest header row, or more where a name holds a comma. Files' first blocks are read."""
    lines = spark.read.text(list(paths)).select("value", *_meta()).withColumn("id", F.monotonically_increasing_id())
    heads = readers._from_start(lines.where(F.col("block") == 0)).where(F.col("line") == header)
    return heads.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 0


def read_sheets(spark: SparkSession, path: str | Sequence[str], ids: Sequence[str], header: int = 0,
                skip: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """(file, record, ``ids``, header, value): one row per record and cell that is no id.

    ``header`` counts the lines above the header row of every file; ``skip`` is a
    pattern of column names to leave out. Ids may stand in any column; a file without one of them is an
    error. A column that occurs twice gives both cells; cells beyond the header row have
    no name and are left out; missing cells are null.
    """
    paths = [path] if isinstance(path, str) else list(path)
    width = widest(spark, paths, header)
    names = [f"c{i}" for i in range(width)]
    csv = readers._csv(spark, readers._lines_in(spark, paths, multi_line)).option("header", False)
    raw = csv.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(paths)
    cells = F.array(*[readers._text(F.col(c)) for c in names]).cast("array<string>").alias("cells")
    rows = numbered(raw.select(cells, *_meta()))
    plain = F.transform("cells", lambda c: F.ltrim(c, F.lit(readers.BOM)))
    # trailing nulls are the columns that only wider sheets have
    last = F.aggregate(F.transform("names", lambda n, i: F.when(n.isNotNull(), i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    heads = rows.where(F.col(RECORD) == header + 1).select(FILE, plain.alias("names")).select(FILE, F.slice("names", F.lit(1), last).alias("names"))
    if len(raw.inputFiles()) * width * NAME_BYTES <= HEADERS_MB << 20:
        heads = F.broadcast(heads)
    met = rows.where(F.col(RECORD) > header + 1).join(heads, FILE)

    def cell_of(c: str) -> Column:
        at = F.array_position("names", F.lit(c))
        lacking = F.raise_error(F.concat(F.lit(f"no column {c} in "), FILE))
        return F.when(at > 0, F.get("cells", (at - 1).cast("int"))).otherwise(lacking).alias(c)

    wanted = ~F.col("p.header").isin(list(ids))
    if skip is not None:
        wanted = wanted & ~F.col("p.header").rlike(skip)
    pairs = F.transform("names", lambda n, i: F.struct(n.alias("header"), F.get(F.col("cells"), i).alias("value")))
    long = met.select(FILE, RECORD, *[cell_of(c) for c in ids], F.explode(pairs).alias("p")).where(wanted & F.col("p.header").isNotNull())
    return long.select(FILE, RECORD, *[F.col(f"`{c}`") for c in ids], "p.header", "p.value")
