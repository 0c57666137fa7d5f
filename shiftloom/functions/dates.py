"""Date expressions. Dates stay ``DateType`` until the export edge."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftloom.functions.text import col_of

SERIAL_EPOCH = dt.date(1899, 12, 30)
NO_DATE_SERIAL = 2  # what a zero serial stands for: 1900-01-01


def serial_to_date(c: Column | str) -> Column:
    """Spreadsheet day count to date."""
    return F.date_add(F.lit(SERIAL_EPOCH), col_of(c).cast("int"))


def serial_or_sentinel(c: Column | str) -> Column:
    """As :func:`serial_to_date`, a zero count becoming the 1900-01-01 sentinel."""
    n = col_of(c).cast("int")
    return serial_to_date(F.when(n == 0, F.lit(NO_DATE_SERIAL)).otherwise(n))


def week_ending_friday(c: Column | str) -> Column:
    """The Friday that closes the Saturday-to-Friday week of a day."""
    return F.next_day(F.date_sub(col_of(c), 1), "Fri")


def week_number(c: Column | str) -> Column:
    """Running number of the Saturday-to-Friday week (1970-01-03 opens week 0)."""
    return F.floor((F.unix_date(col_of(c)) - F.lit(2)) / F.lit(7)).cast("bigint")


def weekday_num(c: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(c))


# What a run of pattern letters stands for, where that is a number of fixed or free width.
_DIGITS = {"yyyy": r"\d{4}", "MM": r"\d{2}", "M": r"\d{1,2}", "dd": r"\d{2}", "d": r"\d{1,2}"}


def shape_of(fmt: str) -> str | None:
    """Regular expression of the texts a numeric date format can fit; None for other formats."""
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z'])", fmt)
    found = [_DIGITS.get(a + b) if a else re.escape(c) for a, b, c in parts]
    whole = "".join(a + b + c for a, b, c in parts)
    return None if None in found or whole != fmt else "^" + "".join(found) + "$"


def parse_date(c: Column | str, fmt: str) -> Column:
    """Text to date; null where the text does not fit.

    Texts of another shape are not tried: an attempt that fails costs an exception.
    """
    c, shape = col_of(c), shape_of(fmt)
    return F.try_to_date(c, fmt) if shape is None else F.when(c.rlike(shape), F.try_to_date(c, fmt))


def parse_any_date(c: Column | str, formats: Iterable[str]) -> Column:
    """First format that parses wins."""
    return F.coalesce(*[parse_date(c, f) for f in formats])


def header_to_date(c: Column | str, fmt: str = "M/d/yyyy") -> Column:
    """Day headers arrive as a serial or as text; either becomes a date."""
    c = col_of(c)
    return F.coalesce(serial_to_date(c.try_cast("int")), parse_date(c, fmt))


def date_text(c: Column | str, fmt: str = "MM/dd/yyyy") -> Column:
    return F.date_format(col_of(c), fmt)


def drop_zone(c: Column | str) -> Column:
    """Zoned timestamp to wall clock, read in the session's time zone."""
    return col_of(c).cast("timestamp_ntz")


def shift_cutoff(run_date: dt.date, hours: int, day: str = "today") -> dt.datetime:
    """Midnight of the run date, or of the day before, plus some hours."""
    if day not in ("today", "yesterday"):
        raise ValueError(f"day must be 'today' or 'yesterday', not {day!r}")
    start = run_date - dt.timedelta(days=1) if day == "yesterday" else run_date
    return dt.datetime.combine(start, dt.time()) + dt.timedelta(hours=hours)


def up_to_cutoff(c: Column | str, cutoff: dt.datetime) -> Column:
    """True up to and including the cut-off *second*: fractions do not count.

    Written against the bare column, so that the filter reaches the scan.
    """
    bound = (cutoff + dt.timedelta(seconds=1)).isoformat(sep=" ")
    return col_of(c) < F.lit(bound).cast("timestamp_ntz")


def after_horizon(c: Column | str, run_date: dt.date, days: int, inclusive: bool = False) -> Column:
    """True for dates later than ``run_date - days`` (or equal, if inclusive)."""
    bound = F.lit(run_date - dt.timedelta(days=days))
    return col_of(c) >= bound if inclusive else col_of(c) > bound
