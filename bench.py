"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs twice to warm up and
then RUNS times; the median counts. Inputs that a live system has anyway (the raw log, the
position table, the feed) are written beforehand, apart from ``ingest``, which is the
writing of the position table.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidegrid import catalog
from tidegrid.constants import WEEK_DAYS
from tidegrid.operators import aggregates
from tidegrid.plans import job, q1, q2
from tidegrid.session import build_session, new_workspace
from tidegrid.sources import normalized

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

BATCH = [
    "bbox_filter", "sector_assign", "event_time_topn", "daily_rollup",
    "q1_week", "q1_month", "slot_counts_week", "slot_counts_month",
    "q2_week_top3", "q2_month_top3", "q2_week_rendered",
    "q2_cumulative_week", "q2_cumulative_month", "q2_changelog_week", "q2_emissions_week",
    "q1_week_by_rollup", "q2_week_by_rollup",
]
STREAMS = ["stream_q1_week", "stream_q1_month", "stream_q2_week_top3", "stream_q2_changelog"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action, runs: int) -> float:
    for _ in range(2):
        action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    log = catalog.raw_log(spark, SF_DIR)
    table = catalog.position_days(spark, SF_DIR)
    catalog.feed(spark, SF_DIR)
    n_rows = table.count()

    def all_reports() -> None:
        for rows in job.reports(table).values():
            run(rows)

    timings = {name: seconds(lambda: run(catalog.QUERIES[name](spark, SF_DIR)), RUNS)
               for name in BATCH}
    timings["table_q1_week"] = seconds(lambda: run(q1.q1(table, WEEK_DAYS)), RUNS)
    timings["table_q2_week_top3"] = seconds(lambda: run(q2.q2_top3(table, WEEK_DAYS)), RUNS)
    timings["table_daily_rollup"] = seconds(lambda: run(aggregates.daily_rollup(table)), RUNS)
    timings["all_reports"] = seconds(all_reports, min(RUNS, 3))
    timings["ingest"] = seconds(
        lambda: normalized.ingest(spark, log, new_workspace(spark, "bench-ingest")),
        min(RUNS, 3))
    for name in STREAMS:
        timings[name] = seconds(lambda: run(catalog.QUERIES[name](spark, SF_DIR)), min(RUNS, 2))

    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "rows": n_rows, "cpus": int(CPUS),
        "rows_per_sec": {name: round(n_rows / s) for name, s in timings.items()
                         if name in ("q1_week", "table_q1_week", "ingest", "stream_q1_week")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
