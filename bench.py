"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  tables to run on (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to time every registered query
"""

from __future__ import annotations

import json
import os
import time

from shiftloom.queries import queries
from shiftloom.session import build_session

HEADLINE = [
    "schedule_fact", "weekly_schedule", "roster_fact", "roster_fact_sql", "weekly_coefficient", "changelog_overlay",
    "exit_overlay", "forecast_overlay", "effective_overlay", "interval_overlay", "attribute_change",
    "first_qualifying_date", "forward_fill", "backward_fill", "lead_default_self", "dedupe_first", "adjusted_hours",
    "resolve_status", "time_in_status", "agg_join_back", "unpivot_schedule", "unpivot_explicit", "multi_value_unnest",
    "schedule_flags", "attendance_compile", "snapshot_fact", "conform_feed", "week_totals", "dup_check",
]


def run(df) -> None:
    """Computes every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores=cpus, **{"spark.ui.showConsoleProgress": "false"})
    catalog = queries()
    names = list(catalog) if os.environ.get("BENCH_ALL") else HEADLINE
    run(spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count())  # JVM warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        run(catalog[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total wall clock of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
