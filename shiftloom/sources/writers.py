"""Sinks: the latest state, dated snapshots, exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_latest(df: DataFrame, path: str, compression: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Replaces the latest state. ``compression='none'`` writes plain Parquet."""
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    out = out.option("compression", compression) if compression else out
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def write_snapshot(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Adds or replaces the snapshot of one run, leaving those of other runs alone."""
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV that the readers of this library, and others, read back as it was.

    Quotes are doubled, an empty text is quoted and null is not, spaces stay.
    """
    (
        df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"')
        .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
