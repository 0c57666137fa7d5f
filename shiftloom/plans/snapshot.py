"""Snapshot of a schedule fact, with run stamps and the first billable day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators import projection
from shiftloom.operators.aggregates import first_date

HEADER_PAIRS = [(" ", "_"), ("/", "_")]


def snapshot_fact(run_date: dt.date, file_date: dt.date, entity: str = "EID"):
    """Header-normalised copy. The first billable day stands on the day itself only.

    It is found by an aggregate per entity and joined back on (entity, day), a key
    that spreads the rows of any entity.
    """

    def op(df: DataFrame) -> DataFrame:
        rows = df.transform(projection.normalize_headers(HEADER_PAIRS))
        if "SRT_ID" in rows.columns:
            rows = rows.withColumn("SRT_ID", text.rstrip_set(F.col("SRT_ID").cast("string"), ".0"))
        rows = rows.withColumn("date_aux", F.col("date").cast("date")).withColumn("date_str", F.col("date_aux").cast("string"))
        rows = rows.withColumn("date", dates.date_text("date_aux", "MM-dd-yyyy"))
        rows = rows.transform(projection.stamp({"mfdate": file_date, "creation_date": run_date}))
        rows = rows.withColumn(
            "ABS_aux", rules.flag((F.col("ABS") == 0) & F.col("iw_highlevel_status").isNotNull())
        )
        billed = rows.transform(first_date(entity, "date_aux", "first_bill_day", F.col("billable") == "billable"))
        billed = billed.withColumnRenamed(entity, "EID_firstbill")
        return rows.join(
            billed,
            (F.col(entity) == F.col("EID_firstbill")) & (F.col("date_aux") == F.col("first_bill_day")),
            "left",
        )

    return op
