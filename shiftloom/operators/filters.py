"""Row filters. Comparisons are written so that they reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import functions as F

from shiftloom.functions import dates, rules


def not_sentinel(col: str, sentinel: str):
    """Drops rows holding an error marker; null rows stay."""
    return lambda df: df.where(rules.not_equal(col, sentinel))


def equals_any(col: str, values: Sequence):
    return lambda df: df.where(F.col(col).isin(list(values)))


def not_in(col: str, values: Sequence):
    """Drops listed values; null rows stay."""
    return lambda df: df.where(F.coalesce(~F.col(col).isin(list(values)), F.lit(True)))


def present(*cols: str):
    """Keeps rows in which every given column is set."""
    return lambda df: df.dropna("any", subset=list(cols) or None)


def started_by(col: str, run_date: dt.date, hours: int, day: str = "today"):
    """Shifts that start up to the cut-off of the run."""
    return lambda df: df.where(dates.up_to_cutoff(col, dates.shift_cutoff(run_date, hours, day)))


def within_horizon(col: str, run_date: dt.date, days: int, inclusive: bool = False):
    """Events dated later than some days before the run."""
    return lambda df: df.where(dates.after_horizon(col, run_date, days, inclusive))
