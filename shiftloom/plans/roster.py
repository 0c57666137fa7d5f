"""Roster fact: roster rows with resolved hours and attendance status."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators.aggregates import COMPLETED_PARTS, STATUS_COLUMNS, TOTAL_PARTS, sum0, time_in_status
from shiftloom.operators.joins import lookup
from shiftloom.operators.projection import q
from shiftloom.operators.sets import stack
from shiftloom.operators.timeline import keep_first, keep_last
from shiftloom.plans import rule_tables as R

KEY = ["enterprise_id", "roster_date"]


def normalize_workflow(c: Column | str) -> Column:
    return rules.value_map(c, R.WORKFLOW_FAMILIES)


def adjusted_hours(
    keys: Sequence[str] = tuple(KEY), source_day: str = "srtf_date", headcount: str = "hc",
    measures: dict[str, str] | None = None, order: Sequence[str] = ("ingest_seq",),
):
    """Hours with adjustments, one row per (keys, source day), with a fallback feed.

    ``measures`` maps an hours column to its fallback. Rows whose headcount is not 1
    (null included) are adjustments; their sum replaces the hours of every row of the
    key. Zero hours then count as missing. The rows are deduplicated before the totals
    are joined, as a total belongs to the key.
    """
    measures = measures or {"srtf_total_hrs": "ts_total_hours", "srtf_completed_time": "ts_completed_time"}

    def op(df: DataFrame) -> DataFrame:
        adjusted = (
            df.where(rules.not_equal(headcount, 1))
            .dropna("any", subset=list(keys))
            .groupBy(*keys)
            .agg(*[sum0(m).alias(f"__adj_{m}") for m in measures])
        )
        rows = df.transform(keep_first([*keys, source_day], list(order))).join(adjusted, list(keys), "left")
        hours = {
            m: F.coalesce(rules.zero_to_null(F.coalesce(F.col(f"__adj_{m}"), F.col(m))), F.col(fallback))
            for m, fallback in measures.items()
        }
        return rows.withColumns(hours).drop(*[f"__adj_{m}" for m in measures])

    return op


def clean_status(c: Column | str, legacy: bool = False) -> Column:
    """Adjusted status text. ``legacy`` turns a null into sick leave."""
    s = text.replace_chain(c, R.STATUS_COMMA)
    sick = s.contains(R.SICK_LEAVE + "\n")
    sick = F.coalesce(sick, F.lit(True)) if legacy else sick
    return text.replace_chain(F.when(sick, F.lit(R.SICK_LEAVE)).otherwise(s), R.STATUS_TWELVE)


def adjustment_list(adjustments: DataFrame, order: Sequence[str], legacy: bool = False) -> DataFrame:
    """Last entry per (user, day) of (Username, Date, Status Final), cleaned."""
    rows = adjustments.select(
        q("Username").alias("enterprise_id"), q("Date").cast("date").alias("roster_date"),
        q("Status Final").alias("__status"), *[q(c) for c in order],
    )
    last = rows.transform(keep_last(KEY, order))
    return last.select(*KEY, clean_status("__status", legacy).alias("status_final_AL"))


def update_sheets(*sheets: DataFrame) -> DataFrame:
    """All update sheets (Username, Date, Status Final) as a fallback feed."""
    return stack(*sheets).select(
        q("Username").alias("enterprise_id"), q("Date").cast("date").alias("roster_date"),
        q("Status Final").cast("string").alias("status_fallback"),
    )


def shrinkage_feed(feed: DataFrame) -> DataFrame:
    """The shrinkage report (Username, Day, Status final) as a fallback feed; Day may be a serial."""
    day = dates.serial_to_date("Day") if dict(feed.dtypes)["Day"] in ("int", "bigint", "double") else q("Day").cast("date")
    return feed.select(
        q("Username").alias("enterprise_id"), day.alias("roster_date"),
        q("Status final").cast("string").alias("status_fallback"),
    )


def resolve_status(adjusted: DataFrame, fallback: DataFrame, status_map: DataFrame, keys: Sequence[str] = tuple(KEY),
                   attendance: str = "iw_attendance_status", map_key: str = "status_final_AL"):
    """Adjustment list, then the fallback feed, then the attendance status; then mapped."""

    def op(df: DataFrame) -> DataFrame:
        joined = df.join(adjusted, list(keys), "left").join(fallback, list(keys), "left")
        resolved = joined.withColumns(
            {
                "status_final_AL": text.replace_chain(
                    rules.first_present("status_final_AL", "status_fallback", attendance), R.STATUS_COMMA
                ),
                attendance: text.replace_chain(attendance, R.STATUS_COMMA),
            }
        ).drop("status_fallback")
        cols = {"Status": "rta_status", "Status_code": "rta_status_code", "WH Code": "WH Code"}
        return resolved.transform(lookup(status_map, map_key, "Status final", cols))

    return op


def deployment_dates(table: DataFrame) -> DataFrame:
    """Deployment and graduation per person; sentinel texts are no dates."""
    parsed = table.select(
        q("EID").alias("enterprise_id"),
        dates.parse_date(rules.sentinel_to_null(q("OpsDeploymentDate").cast("string"), R.NO_DEPLOYMENT), "yyyy-MM-dd")
        .alias("OpsDeploymentDate"),
        dates.parse_date(rules.sentinel_to_null(q("Graduation Date").cast("string"), R.NO_GRADUATION), "yyyy-MM-dd")
        .alias("Graduation_Date"),
        q("DMR Status"),
    )
    return parsed.where(F.col("OpsDeploymentDate").isNotNull())


def trainee_fill(trainees: DataFrame, role: str = "role"):
    """Workflow, cluster and LOB of trainees from the trainee list, only where missing."""
    side = trainees.select(
        q("EID").alias("__t_id"), q("Training FLOW").alias("__t_flow"), q("Market").alias("__t_market"),
        rules.decision_list(
            [(q("Training FLOW") == f, lob) for f, lob in R.TRAINEE_FLOWS.items()], F.lit(None).cast("string")
        ).alias("__t_lob"),
    )
    fills = {"current_workflow": "__t_flow", "cluster": "__t_market", "workflow": "__t_lob"}

    def op(df: DataFrame) -> DataFrame:
        joined = df.join(side, F.col("enterprise_id") == F.col("__t_id"), "left")
        trainee = F.col(role) == "Trainee"
        return joined.withColumns(
            {c: rules.override(c, trainee & F.col(c).isNull(), F.col(f)) for c, f in fills.items()}
        ).drop("__t_id", *fills.values())

    return op


@dataclass(frozen=True)
class RosterInputs:
    extracts: Sequence[DataFrame]
    adjustments: DataFrame
    fallback: DataFrame  # of update_sheets() or shrinkage_feed()
    status_map: DataFrame
    deployment: DataFrame | None = None
    trainees: DataFrame | None = None
    adjustment_order: Sequence[str] = ("ingest_seq",)
    order: Sequence[str] = ("ingest_seq",)


def build_roster_fact(inp: RosterInputs, map_key: str = "status_final_AL", legacy: bool = False) -> DataFrame:
    """Enriched roster. The 2022 edition maps ``iw_attendance_status``, the others the final status."""
    rows = stack(*inp.extracts).withColumnRenamed("date", "srtf_date")
    rows = rows.withColumns(
        {
            "roster_date": F.col("roster_date").cast("date"),
            "current_workflow": normalize_workflow("current_workflow"),
        }
    )
    if inp.trainees is not None:
        rows = rows.transform(trainee_fill(inp.trainees))
    rows = rows.transform(adjusted_hours(order=inp.order))
    adjusted = adjustment_list(inp.adjustments, inp.adjustment_order, legacy)
    rows = rows.transform(resolve_status(adjusted, inp.fallback, inp.status_map, map_key=map_key))
    rows = rows.withColumn("WH", rules.hours_text("iw_actual_time", q("WH Code"), R.WORKED_THRESHOLD))
    if inp.deployment is not None:
        rows = rows.join(deployment_dates(inp.deployment), "enterprise_id", "left")
    return rows


# -- the warehouse query ---------------------------------------------------------

ROSTER_COLUMNS = [
    "srt_id", "enterprise_id", "role", "employee_status", "skills", "cluster", "workflow", "current_workflow",
    "team_lead", "ops_lead_eid", "roster_date", "week_end_date_text", "report_month", "billable",
]
ATTENDANCE_COLUMNS = [
    "highlevel_status", "updated_status", "attendance_status", "srt_id", "enterprise_id", "shift_date",
    "shift_status", "system_status", "date_txt", "week_end_date_txt", "report_month",
]


def status_roster_fact(roster: DataFrame, attendance: DataFrame, billed: DataFrame, timestamps: DataFrame, *,
                       roster_city: str, work_city: str, week_ending: str | None) -> DataFrame:
    """Roster of a city and week with attendance, billed hours and time in status.

    Text days of the two hour feeds are parsed instead of formatting the roster's date,
    so that the join keys are plain columns on the large side. Without ``week_ending``
    all weeks are kept.
    """
    base = roster.where(F.col("city") == roster_city)
    base = base if week_ending is None else base.where(F.col("week_end_date_text") == week_ending)
    base = base.select(*ROSTER_COLUMNS)
    seen = attendance.select(
        *[F.col(c).alias(f"iw_{c}") for c in ATTENDANCE_COLUMNS],
        F.round(F.col("actual_time_min").cast("float").cast("double") / 60, 2).alias("iw_actual_time"),
    )
    hours = billed.select(
        q("enterprise id").alias("__b_id"), dates.parse_date("date", "MM-dd-yyyy").alias("__b_day"),
        q("total hours").alias("srtf_total_hrs"), q("completed time").alias("srtf_completed_time"), "hc",
        q("adjustment types").alias("srtf_adjustment_type"), "date",
    )
    spent = (
        timestamps.where(F.col("work_city") == work_city)
        .transform(time_in_status("reporting_ds", "actor_id", "status", "time_in_status_mins", source_columns=["work_city"]))
        .select(
            F.col("actor_id").alias("__t_id"), F.to_date("reporting_ds").alias("__t_day"),
            "ts_total_hours", "ts_completed_time",
        )
    )
    return (
        base.join(seen, (F.col("enterprise_id") == F.col("iw_enterprise_id")) & (F.col("roster_date") == F.col("iw_shift_date")), "left")
        .join(hours, (F.col("enterprise_id") == F.col("__b_id")) & (F.col("roster_date") == F.col("__b_day")), "left")
        .join(spent, (F.col("srt_id") == F.col("__t_id")) & (F.col("roster_date") == F.col("__t_day")), "left")
        .drop("__b_id", "__b_day", "__t_id", "__t_day")
    )


# One query over catalog tables. The quoted names hold spaces.
_STATUS_SUMS = ",\n      ".join(
    f"sum(mins) FILTER (WHERE status = '{s}') AS `{c}`" for c, s in STATUS_COLUMNS.items()
)


def _hours_sql(parts: Sequence[str]) -> str:
    return "round((" + " + ".join(f"coalesce(`{p}`, 0.0D)" for p in parts) + ") / 60, 2)"


STATUS_ROSTER_SQL = f"""
WITH logged AS (
    SELECT DISTINCT reporting_ds, actor_id, status, time_in_status_mins
    FROM IDENTIFIER(:timestamps) WHERE work_city = :work_city),
  spent AS (
    SELECT to_date(reporting_ds) AS spent_day, actor_id,
      {_STATUS_SUMS}
    FROM (SELECT *, try_cast(time_in_status_mins AS DOUBLE) AS mins FROM logged)
    GROUP BY 1, 2),
  worked AS (
    SELECT spent_day, actor_id,
      {_hours_sql(TOTAL_PARTS)} AS ts_total_hours,
      {_hours_sql(COMPLETED_PARTS)} AS ts_completed_time
    FROM spent),
  billed AS (
    SELECT *, try_to_date(`date`, 'MM-dd-yyyy') AS billed_day FROM IDENTIFIER(:billed))
SELECT {", ".join("r." + c for c in ROSTER_COLUMNS)},
  {", ".join(f"a.{c} AS iw_{c}" for c in ATTENDANCE_COLUMNS)},
  round(cast(cast(a.actual_time_min AS FLOAT) AS DOUBLE) / 60, 2) AS iw_actual_time,
  b.`total hours` AS srtf_total_hrs, b.`completed time` AS srtf_completed_time, b.hc,
  b.`adjustment types` AS srtf_adjustment_type, b.`date`,
  w.ts_total_hours, w.ts_completed_time
FROM IDENTIFIER(:roster) AS r
LEFT JOIN IDENTIFIER(:attendance) AS a ON r.enterprise_id = a.enterprise_id AND r.roster_date = a.shift_date
LEFT JOIN billed AS b ON r.enterprise_id = b.`enterprise id` AND r.roster_date = b.billed_day
LEFT JOIN worked AS w ON r.srt_id = w.actor_id AND r.roster_date = w.spent_day
WHERE r.city = :roster_city AND (:week_ending IS NULL OR r.week_end_date_text = :week_ending)
"""


def status_roster_tables(spark: SparkSession, **args: str | None) -> DataFrame:
    """The same in SQL, from the catalog tables named by ``roster``, ``attendance``,
    ``billed`` and ``timestamps``; the other arguments as above."""
    return spark.sql(STATUS_ROSTER_SQL, args=args)
