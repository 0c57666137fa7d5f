"""Aggregations. All of them combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum0(c: Column | str) -> Column:
    """A sum that is 0, not null, over nothing but nulls."""
    return F.coalesce(F.sum(c), F.lit(0))


def group_sum(keys: Sequence[str], measures: Sequence[str], where: Column | None = None):
    """Sums per key; rows without a key form no group."""

    def op(df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        return rows.dropna("any", subset=list(keys)).groupBy(*keys).agg(*[sum0(m).alias(m) for m in measures])

    return op


def first_date(key: str, date: str, out: str, where: Column | None = None):
    """Least date per key, over the qualifying rows only."""

    def op(df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        return rows.dropna("any", subset=[key]).groupBy(key).agg(F.min(date).alias(out))

    return op


def distinct_then_group(columns: Sequence[str], keys: Sequence[str], measure: str, out: str):
    """Equal rows count once, then the measure is summed per key."""
    return lambda df: df.select(*columns).distinct().groupBy(*keys).agg(F.sum(measure).alias(out))


# Output column, then the status it collects.
STATUS_COLUMNS = {
    "available": "available",
    "coaching": "coaching",
    "unavailable": "unavailable",
    "break": "break",
    "meal": "meal",
    "fb_training": "fb_training",
    "team_meeting": "team_meeting",
    "non_fb_training": "non-fb-training",
    "well_being": "wellness_support",
}
TOTAL_PARTS = ["available", "coaching", "fb_training", "team_meeting", "well_being"]
COMPLETED_PARTS = TOTAL_PARTS + ["non_fb_training", "meal", "break"]


def time_in_status(
    day: str, actor: str, status: str, minutes: str, *,
    source_columns: Sequence[str] = (),
    statuses: dict[str, str] = STATUS_COLUMNS,
    total_parts: Sequence[str] = TOTAL_PARTS,
    completed_parts: Sequence[str] = COMPLETED_PARTS,
    dedupe: bool = True,
):
    """Minutes per status and the two hour totals per (day, actor).

    With ``dedupe`` equal status rows count once, as a timestamp feed repeats rows.
    A status that does not occur is null; the totals treat it as 0.
    """

    def op(df: DataFrame) -> DataFrame:
        cols = list(dict.fromkeys([day, actor, status, minutes, *source_columns]))
        rows = df.select(*cols)
        rows = rows.distinct() if dedupe else rows
        mins = F.col(minutes).try_cast("double")
        per_status = rows.groupBy(day, actor).agg(
            *[F.sum(F.when(F.col(status) == s, mins)).alias(c) for c, s in statuses.items()]
        )

        def hours(parts: Sequence[str]) -> Column:
            total = F.lit(0.0)
            for p in parts:
                total = total + F.coalesce(F.col(p), F.lit(0.0))
            return F.round(total / 60, 2)

        return per_status.select(
            "*",
            hours(total_parts).alias("ts_total_hours"),
            hours(completed_parts).alias("ts_completed_time"),
        )

    return op
