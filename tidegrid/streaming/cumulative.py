"""The cumulative ranking of a stream as it changes sector by sector.

Each micro-batch adds its closed windows to a history table in the shared folder, and the emissions
are worked out from that table with the batch plan. (Rankings per window need no history: see
``ranking_state``.)
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.operators.aggregates import slot_totals_with_sea
from tidegrid.plans import q2
from tidegrid.session import new_workspace
from tidegrid.streaming.reports import with_watermark
from tidegrid.streaming.runner import start_closed_windows

TOTALS = ("window_start", "cell", "am", "pm", "last_west")
TOTALS_SCHEMA = "window_start timestamp, cell int, am bigint, pm bigint, last_west boolean"

# What is kept of the cumulative rankings: folder, plan and layout.
REPORTS = {
    "emissions": (q2.q2_emissions, "window_start timestamp, sector string, sea string, "
                                   "rank_a string, rank_p string"),
}


def record_windows(closed: DataFrame, batch_id: int, days: int, out: str,
                   reports: Iterable[str] = tuple(REPORTS)) -> None:
    """Add the slot counts of closed windows to ``out/history`` and write what they bring to
    the rankings to a folder per report.

    Each batch overwrites its own folders, so a batch that is run again after a failure
    leaves the same files. A batch reads only the history up to itself.
    """
    spark = closed.sparkSession
    closed.select(*TOTALS).write.mode("overwrite").parquet(f"{out}/history/batch={batch_id}")
    so_far = (spark.read.schema(f"{TOTALS_SCHEMA}, batch bigint").parquet(f"{out}/history")
              .where(F.col("batch") <= batch_id))
    new = so_far.where(F.col("batch") == batch_id).select("window_start").distinct()
    for name in reports:
        plan, _ = REPORTS[name]
        (plan(so_far.drop("batch"), days).join(new, "window_start", "left_semi")
         .write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}"))


def start_cumulative(positions: DataFrame, days: int, out: str, slot_tz: str = "UTC",
                     finite: bool = True,
                     reports: Iterable[str] = tuple(REPORTS)) -> StreamingQuery:
    totals = slot_totals_with_sea(with_watermark(positions), days, slot_tz)
    return start_closed_windows(
        totals.select(*TOTALS),
        lambda closed, batch_id: record_windows(closed, batch_id, days, out, reports),
        f"{out}/checkpoint", finite)


def read_report(spark: SparkSession, out: str, name: str) -> DataFrame:
    _, layout = REPORTS[name]
    return spark.read.schema(f"{layout}, batch bigint").parquet(f"{out}/{name}").drop("batch")


def run_cumulative(positions: DataFrame, days: int, name: str) -> DataFrame:
    """Run over all that is available and give one of the reports."""
    out = new_workspace(positions.sparkSession, f"cumulative-{days}")
    start_cumulative(positions, days, out, reports=(name,)).awaitTermination()
    return read_report(positions.sparkSession, out, name)
