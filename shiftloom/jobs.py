"""The jobs end to end: landed feeds in, facts and reports out.

A feed is a CSV path, a list of such paths, or a :class:`Feed` that says how it is
written. :func:`files_of` picks the files of a period. Every job takes its run date and writes the
latest state, and a dated copy where one is kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.operators.checks import Watch, distinct_values, duplicate_keys, exit_check, gone_but_working
from shiftloom.operators.projection import q
from shiftloom.plans import feeds, roster
from shiftloom.plans.schedule_fact import ScheduleInputs, build_schedule_fact, export_edges
from shiftloom.plans.snapshot import snapshot_fact
from shiftloom.session import configure
from shiftloom.sources import published, readers, schemas, writers

@dataclass(frozen=True)
class Feed:
    """Where a feed lies and how it is written. A bare path, or a list of paths, is CSV.

    ``header``: lines above the header of a CSV. ``multi_line``: whether records may span
    lines, so that files cannot be split; left out, the readers find out. ``format``: csv, parquet, or published for a table
    of :mod:`shiftloom.sources.published`, which a job may read and replace in one run.
    """

    path: str | Sequence[str]
    format: str = "csv"
    header: int = 0
    multi_line: bool | None = None


Path = str | Sequence[str] | Feed


def feed_texts(spark: SparkSession, path: Path, columns: Sequence[str], header: int = 0, ingest_seq: bool = False) -> DataFrame:
    feed = path if isinstance(path, Feed) else Feed(path, header=header)
    if feed.header == 0:
        return readers.read_csv_texts(spark, feed.path, columns, multi_line=feed.multi_line, ingest_seq=ingest_seq)
    below = readers.read_below_preamble(spark, feed.path, feed.header, columns, feed.multi_line)
    return below.withColumn("ingest_seq", F.monotonically_increasing_id()) if ingest_seq else below


def read_feed(spark: SparkSession, path: Path, schema: T.StructType, header: int = 0, ingest_seq: bool = False) -> DataFrame:
    """The schema's columns of a feed, by name.

    ``ingest_seq`` adds the order of the rows in the files, which rules like "keep the
    first" need (CSV only: other feeds bring the column along).
    """
    wanted = [*schema.names, *(["ingest_seq"] if ingest_seq else [])]
    if isinstance(path, Feed) and path.format == "parquet":
        return readers.read_parquet(spark, path.path, wanted)
    if isinstance(path, Feed) and path.format == "published":
        return published.read_published(spark, path.path).select(*[q(c) for c in wanted])
    return readers.conform(feed_texts(spark, path, schema.names, header, ingest_seq), _types(schema))


def feed_misfits(spark: SparkSession, path: Path, schema: T.StructType, header: int = 0) -> DataFrame:
    """(column, n) of the texts of a CSV feed that are no values of the schema's types."""
    return readers.misfits(feed_texts(spark, path, schema.names, header), _types(schema))


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def texts(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def files_of(pattern: str, days: Sequence[dt.date]) -> list[str]:
    """The paths of a period: ``pattern`` with every day put in, in order.

    Written as for ``strftime``: ``files_of("roster/%Y-%m.csv", days)``; equal paths once.
    """
    return list(dict.fromkeys(day.strftime(pattern) for day in days))


def replaced(df: DataFrame, path: str, publish: bool, watch: Watch | None = None) -> DataFrame:
    """Makes ``df`` the latest state at ``path`` and returns it as written. ``watch`` looks on as it is written.

    With ``publish`` the switch is one rename: readers and a run that dies never see
    half of it, and ``df`` may come from the table itself. Without it the folder is
    plain Parquet, emptied before it is written.
    """
    df = df if watch is None else watch.over(df)
    if publish:
        published.publish(df, path)
        return published.read_published(df.sparkSession, path)
    writers.write_latest(df, path)
    return df.sparkSession.read.parquet(path)


# -- feed jobs -------------------------------------------------------------------


def run_daily_extract(spark: SparkSession, extract: Path, status_map: Path, run_date: dt.date, latest: str, backup: str,
                      hours: int = 10, day: str = "today", header: int = 1, publish: bool = False) -> DataFrame:
    """Shift extract to the daily status feed; returns the feed as written."""
    raw = read_feed(configure(spark), extract, schemas.SHIFT_EXTRACT, header)
    out = feeds.daily_extract(raw, read_feed(spark, status_map, schemas.STATUS_MAP), run_date, hours, day)
    written = replaced(out, latest, publish)
    writers.write_csv(written, f"{backup}/run_date={run_date}")
    return written


def run_attendance(spark: SparkSession, compiled: Path, adjusted: Path, extract: Path, run_date: dt.date, out: str,
                   hours: int = 15, day: str = "today", header: int = 1) -> DataFrame:
    """Compiled attendance as CSV; returns the keys that occur more than once.

    The output may be the ``compiled`` feed of the next run: its dates are read back.
    """
    shifts = feeds.shift_attendance(read_feed(configure(spark), extract, schemas.SHIFT_EXTRACT, header), run_date, hours, day)
    kept = [read_feed(spark, p, schemas.ATTENDANCE_FEED) for p in (compiled, adjusted)]
    writers.write_csv(feeds.attendance_compile(*kept, shifts), out)
    written = readers.read_csv(spark, out, {"Username": "string", "Date": "string"})
    return written.transform(duplicate_keys(["Username", "Date"]))


def run_billed_hours(spark: SparkSession, path: Path, out: str) -> None:
    raw = read_feed(configure(spark), path, texts(*schemas.BILLED_HOURS_COLUMNS))
    writers.write_latest(raw.transform(feeds.conform_billed_hours()), out, compression="none")


def run_timestamps(spark: SparkSession, path: Path, out: str) -> None:
    writers.write_latest(readers.read_csv(configure(spark), path).transform(feeds.conform_timestamps()), out)


def run_weekly_roster(spark: SparkSession, path: Path, week: str, out: str) -> None:
    raw = read_feed(configure(spark), path, texts(*schemas.WEEKLY_ROSTER_COLUMNS))
    writers.write_latest(raw.transform(feeds.conform_weekly_roster(week)), out, compression="none")


# -- roster and schedule -----------------------------------------------------------


def run_roster(spark: SparkSession, inputs: roster.RosterInputs, run_date: dt.date, latest: str, backup: str,
               publish: bool = False, **options) -> DataFrame:
    """Enriched roster; returns the keys that occur more than once."""
    configure(spark)
    written = replaced(roster.build_roster_fact(inputs, **options), latest, publish)
    writers.write_snapshot(written, backup, run_date)
    return written.transform(duplicate_keys(roster.KEY))


@dataclass(frozen=True)
class ScheduleReport:
    """The written fact and its quality checks, each a frame of offending rows.

    ``watch`` has what was counted while the fact was written. Where that settles a check,
    its frame holds the answer and reads nothing: ``working_after_exit`` without such rows,
    and ``codes`` unless there are very many. ``duplicates`` reads the two key columns.
    """

    fact: DataFrame
    duplicates: DataFrame
    codes: DataFrame
    working_after_exit: DataFrame
    watch: Watch


def run_schedule(spark: SparkSession, inputs: ScheduleInputs, run_date: dt.date, latest: str, export: str,
                 variant: str = "main", snapshots: str | None = None, file_date: dt.date | None = None,
                 excluded: Sequence[str] = (), null_cells: str = "off", publish: bool = False) -> ScheduleReport:
    """Schedule fact as Parquet and CSV, with a snapshot on request.

    The exports read the written fact, so the job computes it once; the checks are
    settled by what was counted while it was written, as far as that goes.
    """
    configure(spark)
    watch = Watch(["EID", "date"], {"gone": gone_but_working(excluded)}, ["value"])
    fact = replaced(build_schedule_fact(inputs, run_date, variant, null_cells), latest, publish, watch)
    writers.write_csv(fact.transform(export_edges), export)
    if snapshots is not None:
        writers.write_snapshot(fact.transform(snapshot_fact(run_date, file_date or run_date)), snapshots, run_date)
    codes = watch.values("value")
    return ScheduleReport(
        fact, fact.transform(duplicate_keys(["EID", "date"])),
        fact.transform(distinct_values("value")) if codes is None
        else spark.createDataFrame([(v,) for v in codes], fact.select("value").schema),
        fact.transform(exit_check(excluded)) if watch.count("gone") else spark.createDataFrame([], fact.select("EID").schema),
        watch,
    )
