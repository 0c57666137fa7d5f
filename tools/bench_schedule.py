"""Times the schedule job on a generated sheet: ``bench_schedule.py [entities] [days] [variant] [hot share]``.

The sheet, roster and change log are made by rule and written to a new folder. With a
hot share, that part of the sheet's rows carries one and the same EID.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiftloom.plans.schedule_fact import ScheduleInputs, build_schedule_fact  # noqa: E402
from shiftloom.session import build_session  # noqa: E402
from shiftloom.sources import schemas  # noqa: E402

CODES = ["M", "M", "M", "E", "N", "L1", "L2", "V", "Xct", "T"]


def main(entities: int, days: int, variant: str, hot_share: float) -> None:
    spark = build_session("bench_schedule", cores=os.environ.get("BENCH_CPUS", "8"), **{
        "spark.sql.shuffle.partitions": "64", "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"})
    base = tempfile.mkdtemp(prefix="run-")
    start = dt.date(2024, 1, 1)
    serial = (start - dt.date(1899, 12, 30)).days
    people = spark.range(0, entities, 1, 32)
    hot = F.col("id") < int(entities * hot_share)
    eid = F.when(hot, F.lit("tbd")).otherwise(F.concat(F.lit("e"), F.col("id").cast("string")))

    def code(n: int) -> Column:
        pick = F.pmod(F.xxhash64("id", F.lit(n)), F.lit(len(CODES))).cast("int") + 1
        return F.element_at(F.array(*[F.lit(c) for c in CODES]), pick).alias(str(serial + n))

    static = {"EID": eid, "NAME": F.concat(F.lit("n"), F.col("id").cast("string")), "ROLL IN DATE": F.lit(44000), "ROLL OFF DATE": F.lit(0),
              "SRT ID": F.lit("1.0"), "LOB": F.lit("CO - GTM"), "SLOB": F.lit("GTM"), "ROLE": F.lit("Trainee")}
    people.select(*[static.get(c, F.lit("x")).alias(c) for c in schemas.SHEET_STATIC], *[code(n) for n in range(days)]).write.parquet(f"{base}/sheet")
    each_week = people.select("id", F.explode(F.sequence(F.lit(0), F.lit(days - 1), F.lit(7))).alias("n"))
    each_week.select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("enterprise_id"), F.date_add(F.lit(start), F.col("n")).alias("roster_date"),
        *[F.lit("x").alias(c) for c in ("role", "employee_status", "workflow", "current_workflow", "cluster", "team_lead", "ops_lead_eid", "skills",
                                        "billable", "iw_highlevel_status", "iw_attendance_status", "status_final_AL", "rta_status", "rta_status_code", "WH")],
        *[F.lit(1.0).alias(c) for c in ("srtf_total_hrs", "srtf_completed_time", "iw_actual_time")],
    ).write.parquet(f"{base}/roster")
    people.where("id % 10 = 0").select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("e_id"), F.lit("SLOB").alias("Change_Type"), F.lit("IDVAAS").alias("New"),
        F.date_add(F.lit(start), (F.col("id") % days).cast("int")).alias("Effective_Date"),
    ).write.parquet(f"{base}/log")
    codes = spark.createDataFrame([("MF", c, "") for c in sorted(set(CODES))], schemas.CODES)
    read = spark.read.parquet
    inputs = ScheduleInputs(read(f"{base}/sheet"), codes, roster=read(f"{base}/roster"), change_log=read(f"{base}/log").withColumn("ingest_seq", F.monotonically_increasing_id()))
    began = time.perf_counter()
    fact = build_schedule_fact(inputs, start, variant)
    built = time.perf_counter()
    fact.write.format("noop").mode("overwrite").save()
    done = time.perf_counter()
    print(json.dumps({"variant": variant, "entities": entities, "days": days, "hot_share": hot_share, "rows": entities * days,
                      "plan_sec": round(built - began, 1), "run_sec": round(done - built, 1),
                      "rows_per_sec": round(entities * days / (done - built))}))


if __name__ == "__main__":
    a = sys.argv[1:]
    main(int(a[0]) if a else 20_000, int(a[1]) if len(a) > 1 else 365, a[2] if len(a) > 2 else "main", float(a[3]) if len(a) > 3 else 0.0)
