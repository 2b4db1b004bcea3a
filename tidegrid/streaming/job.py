"""All reports over one feed, in one stream with one pass over the feed.

Records go to their windows of both periods in one aggregation (``periods``), and the windows that
close pass through the state of the cumulative rankings (``ranking_state``). Each micro-batch
writes the reports of what it closed. (The daily rollup of the batch job would not do here: a
stream of it would drop rows whose day has closed while their week is still open.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid import metrics, sinks
from tidegrid.constants import MONTH_DAYS, WEEK_DAYS
from tidegrid.operators.ranking import top_sectors
from tidegrid.plans import q1, q2
from tidegrid.session import materialize
from tidegrid.sources import replay
from tidegrid.streaming import open_windows, periods, ranking_state, runner

PERIODS = {"week": WEEK_DAYS, "month": MONTH_DAYS}
OPEN = "-1"  # in the place of a batch number, for what is provisional


def report_rows(closed: DataFrame, ranked: DataFrame, days: int) -> dict[str, DataFrame]:
    """The literal rows of one period, by report name."""
    closed, ranked = (rows.where(F.col("days") == days) for rows in (closed, ranked))
    return {"q1": q1.rendered(q1.report(closed.where("west"), days)),
            "q2": q2.q2_rendered(top_sectors(closed)),
            "q2_cumulative": q2.render(ranked),
            "q2_changelog": ranked.where("changed").select("window_start", "rank_a", "rank_p")}


def _write(closed: DataFrame, ranked: DataFrame, out: str, batch: str) -> None:
    for name, days in PERIODS.items():
        for report, rows in report_rows(closed, ranked, days).items():
            sinks.as_lines(rows).write.mode("overwrite").text(f"{out}/{name}/{report}/batch={batch}")


def start(positions: DataFrame, out: str, slot_tz: str = "UTC", finite: bool = False) -> StreamingQuery:
    """Write the literal rows of Q1, Q2 and the cumulative Q2, and the changelog, to a folder per
    period and report. A batch that is run again overwrites its own folders."""
    def write_reports(both: DataFrame, batch_id: int) -> None:
        _write(ranking_state.closed_rows(both), ranking_state.ranked_rows(both), out, str(batch_id))

    positions = metrics.count_records(positions, "feed_records")
    totals = periods.closed_windows(positions, tuple(PERIODS.values()), slot_tz)
    both = ranking_state.closed_and_ranked(totals)
    return runner.start_closed_windows(both, write_reports, f"{out}/checkpoint", finite)


def start_feed(spark: SparkSession, feed: str, out_dir: str, slot_tz: str = "UTC",
               finite: bool = False) -> StreamingQuery:
    """Start the weekly and 31-day reports. ``finite`` stops at the end of the feed."""
    return _start_feed(spark, feed, out_dir, slot_tz, finite)[0]


def _start_feed(spark: SparkSession, feed: str, out_dir: str, slot_tz: str,
                finite: bool) -> tuple[StreamingQuery, metrics.BatchCounts]:
    session = runner.streaming_session(spark)
    counts = metrics.BatchCounts(spark, f"{out_dir}/counts")
    session.streams.addListener(counts)  # a listener hears the streams of its own session only
    return start(replay.read_feed(session, feed), out_dir, slot_tz, finite), counts


def run_feed(spark: SparkSession, feed: str, out_dir: str, slot_tz: str = "UTC", finite: bool = True) -> None:
    """Run the reports to the end of the feed, or until stopped: with the counts of all batches in
    ``out_dir/counts``, and at the end the windows that are still open."""
    query, counts = _start_feed(spark, feed, out_dir, slot_tz, finite)
    counts.wait_for(query)
    write_open(spark, out_dir)


def write_open(spark: SparkSession, out: str) -> None:
    """Write the reports of the windows that are still open, from the state of the stream, beside
    the others. Another call replaces them; a window that has closed since is no longer among them."""
    session = ranking_state.with_state_store(runner.streaming_session(spark))
    checkpoint = f"{out}/checkpoint"
    still_open = open_windows.open_rollup(session, checkpoint).where(
        F.year("window_start") < replay.SENTINEL_YEAR - 1)
    still_open = materialize(still_open, "open-windows")
    ranked = ranking_state.ranked_rows(open_windows.open_ranked(session, checkpoint, still_open))
    _write(still_open, materialize(ranked, "open-ranked"), out, OPEN)
