"""Feeds with rows that do not fit: every misfit is named, kept apart and counted.

Records are read once, with file and record number, and judged once: a text that is no
value of its column's type is a misfit, and so is a record with too many or too few
fields. What fits is the feed; what does not goes to the quarantine, whole, with all
its misfits. A feed with too many of them replaces nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.operators.projection import q
from shiftloom.session import scratch_path
from shiftloom.sources import published, readers

FILE, RECORD, MALFORMED, MISFITS, TEXTS = "file", "record", "malformed", "misfits", "texts"
NOT_A_VALUE, NOT_THE_FIELDS = "type", "fields"


class TooManyMisfits(ValueError):
    """A feed whose share of records in quarantine is above what the caller allows."""


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``record``, the number of a row in its file from 1 on, to rows with ``file`` and ``block``.

    A block is read by one task in order, so ids tell the place in a block, and the rows of
    the blocks before it (one small row per block) the place of the block in the file.
    """
    marked = rows.withColumn("__id", F.monotonically_increasing_id())
    blocks = marked.groupBy(FILE, "block").agg(F.min("__id").alias("__start"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(FILE, "block", "__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__id") - F.col("__start") + 1
    return marked.join(offsets, [FILE, "block"]).withColumn(RECORD, place).drop("block", "__id", "__start", "__before")


def read_records(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                 encoding: str = "UTF-8", multi_line: bool | None = None) -> DataFrame:
    """As :func:`~shiftloom.sources.readers.read_csv_texts`, with file, record and ``malformed``.

    ``malformed`` is the text of a record whose number of fields is not that of the
    header, else null. Where a quoted text is never closed, the rest of the file is one such record.
    """
    frames = []
    for p in [path] if isinstance(path, str) else path:
        wide = readers._csv(spark, readers._lines_in(spark, p, multi_line, encoding), encoding).option("header", True)
        names = wide.csv(p).columns
        plain = {c.lstrip(readers.BOM): c for c in names}
        wanted = list(plain) if columns is None else list(columns)
        if missing := [c for c in wanted if c not in plain]:
            raise ValueError(f"no column {missing} in {p}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "__corrupt"]])
        raw = (
            wide.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", "__corrupt")
            .option("columnPruning", False).csv(p)  # else surplus fields go unnoticed
        )
        meta = F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block")
        found = raw.select(*[readers._text(q(plain[c])).alias(c) for c in wanted], F.col("__corrupt").alias(MALFORMED), *meta)
        frames.append(numbered(found))
    return reduce(DataFrame.unionByName, frames)


def audit(records: DataFrame, columns: Mapping[str, str], formats: Sequence[str] = readers.DATE_FORMATS) -> DataFrame:
    """Typed ``columns``, then file, record, ``misfits`` (column, text, reason) and the texts they came from.

    An empty text is no misfit; a malformed record has its whole text as one, under no column.
    """
    def misfit(column: Column, text: Column, reason: str) -> Column:
        return F.struct(column.alias("column"), text.alias("text"), F.lit(reason).alias("reason"))

    typed = {c: readers.typed(q(c), t, formats) for c, t in columns.items()}
    bad = [F.when((F.trim(q(c)) != "") & typed[c].isNull(), misfit(F.lit(c), q(c), NOT_A_VALUE)) for c in columns]
    whole = F.when(F.col(MALFORMED).isNotNull(), misfit(F.lit(None).cast("string"), F.col(MALFORMED), NOT_THE_FIELDS))
    return records.select(
        *[v.alias(c) for c, v in typed.items()], FILE, RECORD,
        F.array_compact(F.array(*bad, whole)).alias(MISFITS), F.struct(*[q(c) for c in columns]).alias(TEXTS),
    )


def misfit_rows(audited: DataFrame) -> DataFrame:
    """(file, record, column, text, reason): one row per misfit."""
    return audited.select(FILE, RECORD, F.inline(MISFITS))


@dataclass(frozen=True)
class Landed:
    """A feed that was taken in: the rows that fit, those that do not, and how many records there were."""

    feed: DataFrame
    quarantine: DataFrame
    records: int
    rejected: int


def land(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str], feed: str, quarantine: str,
         max_share: float = 0.01, formats: Sequence[str] = readers.DATE_FORMATS, **reading) -> Landed:
    """Takes a CSV feed in: publishes what fits at ``feed`` and what does not at ``quarantine``.

    The files are read once; the counts come from the pass that writes. Above ``max_share``
    of rejected records :class:`TooManyMisfits` is raised and both tables stay as they
    were. Rows in the feed and in the quarantine add up to the records of the files.
    """
    seen = Observation()
    fits = F.size(MISFITS) == 0
    judged = audit(read_records(spark, path, list(columns), **reading), columns, formats)
    store = scratch_path(spark, "audited")
    judged.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~fits).alias("bad")).write.parquet(store)
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > max_share * n:
        raise TooManyMisfits(f"{bad} of {n} records of {path} do not fit; the feed is left as it was")
    audited = spark.read.schema(judged.schema).parquet(store)
    published.publish(audited.where(~fits).select(FILE, RECORD, MISFITS, TEXTS), quarantine)
    published.publish(audited.where(fits).select(*[q(c) for c in columns]), feed)
    return Landed(published.read_published(spark, feed), published.read_published(spark, quarantine), n, bad)
