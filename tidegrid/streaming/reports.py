"""The reports as append-mode streams: a row is emitted once, when the watermark passes the
end of its window, and later records for that window are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.constants import WATERMARK_DELAY
from tidegrid.operators.aggregates import class_totals, slot_totals, window_counts
from tidegrid.functions import cell_name
from tidegrid.operators.ranking import top_sectors_by_list
from tidegrid.plans import q1


def with_watermark(positions: DataFrame) -> DataFrame:
    return positions.withWatermark("ts", WATERMARK_DELAY)


def stream_q1(positions: DataFrame, days: int) -> DataFrame:
    return q1.report(class_totals(with_watermark(positions), days), days)


def stream_q2_top3(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    totals = slot_totals(with_watermark(positions), days, by_sea=True, slot_tz=slot_tz)
    return top_sectors_by_list(totals)


def stream_window_counts(positions: DataFrame, days: int) -> DataFrame:
    counts = window_counts(with_watermark(positions), days)
    return counts.select("window_start", cell_name(F.col("cell")).alias("sector"), "n")
