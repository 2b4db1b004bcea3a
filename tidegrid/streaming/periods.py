"""Windows of several lengths in one stateful aggregation.

A record goes to its window of each period. The period's length is part of the key, and a window
closes when the watermark passes its own end, so one scan and one state serve all periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions import event_window
from tidegrid.operators.aggregates import rollup_by
from tidegrid.streaming.reports import with_watermark


def in_periods(rows: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Each row once for each period, with its window and the period's ``days``."""
    for days in periods:  # Spark takes one window function in a projection
        rows = rows.withColumn(f"_w{days}", event_window(F.col("ts"), days))
    windows = F.explode(F.array(*[
        F.struct(F.lit(days).alias("days"), F.col(f"_w{days}").alias("window")) for days in periods]))
    spread = rows.withColumn("_period", windows)
    # A window column carries the mark by which Spark closes it; taking it out of an array loses the mark.
    mark = rows.schema[f"_w{periods[0]}"].metadata
    return spread.withColumns({"days": F.col("_period.days")}).withColumn(
        "window", F.col("_period.window").alias("window", metadata=mark)).drop(
        "_period", *(f"_w{days}" for days in periods))


def closed_windows(positions: DataFrame, periods: Sequence[int], slot_tz: str = "UTC") -> DataFrame:
    """All measures of both reports per (days, window, cell, sea), as a stream that gives each
    window once, when it closes."""
    rows = in_periods(with_watermark(positions), periods)
    return rollup_by(rows, ["days", "window"], slot_tz).withColumn("window_start", F.col("window.start"))
