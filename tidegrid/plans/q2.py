"""The busiest sectors in the morning and in the afternoon.

Three readings of "busiest":
* ``top3``: per window, sea and slot, from the counts of that window alone;
* ``cumulative``: over all sectors, by the score gathered in all windows so far;
* ``emissions``: the cumulative ranking as it changes while the sectors of a window report
  one after the other, labelled with the sea of the sector that reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.constants import SLOT_AM, SLOT_PM
from tidegrid.functions import sea_name, window_label
from tidegrid.operators.aggregates import slot_totals, slot_totals_with_sea
from tidegrid.operators.ranking import (
    changed_lists, cumulative_top, emissions, rank_lists, top_sectors)
from tidegrid.session import materialize


def stored_slot_totals(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    """Slot counts per (window, cell), stored: the cumulative plans read them repeatedly
    and must not scan the positions each time."""
    return materialize(slot_totals_with_sea(positions, days, slot_tz), f"slot-totals-{days}")


def q2_top3(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    return top_sectors(slot_totals(positions, days, by_sea=True, slot_tz=slot_tz))


def render(lists: DataFrame) -> DataFrame:
    """The six-column result row."""
    return lists.select(
        window_label(F.col("window_start")).alias("ts"), "sea",
        F.lit(SLOT_AM).alias("slot_a"), "rank_a",
        F.lit(SLOT_PM).alias("slot_p"), "rank_p")


def q2_rendered(top: DataFrame) -> DataFrame:
    """One result row per window and sea."""
    return render(rank_lists(top, ["window_start", "sea"]))


def q2_cumulative(stored: DataFrame, days: int, suppress_first: bool = True) -> DataFrame:
    return cumulative_top(stored, days, suppress_first)


def q2_changelog(stored: DataFrame, days: int, suppress_first: bool = True) -> DataFrame:
    """Cumulative rank lists of the windows in which they changed. The first window is
    left out before comparing, so the second always reports."""
    return changed_lists(q2_cumulative(stored, days, suppress_first))


def q2_cumulative_rendered(stored: DataFrame, days: int, suppress_first: bool = True) -> DataFrame:
    """One six-column row per window. A row counts as new if anything in it, its label
    included, differs from the row before, so every window has one; its sea is that of the
    window's last record."""
    seas = stored.groupBy("window_start").agg(
        sea_name(F.max_by("last_west", "last_arrival")).alias("sea"))
    lists = rank_lists(q2_cumulative(stored, days, suppress_first), ["window_start"])
    return render(lists.join(seas, "window_start"))


def q2_emissions(stored: DataFrame, days: int, suppress_first: bool = True) -> DataFrame:
    return emissions(stored, days, suppress_first)
