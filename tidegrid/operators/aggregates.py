"""Windowed counts per grid cell.

Every aggregate here is a hash aggregation with map-side combine: what a task sends to the
shuffle is bounded by cells x windows, however many rows it read and however they are
spread over sectors. So a sector with a third of all rows costs no more than any other.

The same functions serve batch and streaming input. Both give ``window_start``; a stream
also keeps the ``window`` struct, by which Spark knows when the watermark closes a window.
(Grouping by the struct costs a batch scan a third more than grouping by the start alone.)

"Last record" follows the ``arrival`` number that ingest gives each record, if there is one,
else (ts, event_id) packed into one decimal, which is exact too but slower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.constants import CLASS_35, CLASS_60_69, CLASS_70_79
from tidegrid.functions import (
    arrival_key, cell_code, event_window, is_class, is_morning, is_west)
from tidegrid.operators.filters import western, within_area
from tidegrid.session import configure, materialize

CLASS_COLUMNS = ("n_35", "n_60_69", "n_70_79", "n_others")


def _cell() -> Column:
    return cell_code(F.col("lat"), F.col("lon")).alias("cell")


def _west() -> Column:
    return is_west(F.col("lat"), F.col("lon")).alias("west")


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _class_counts() -> list[Column]:
    shiptype = F.col("shiptype")
    known = [_count_where(is_class(shiptype, bounds))
             for bounds in (CLASS_35, CLASS_60_69, CLASS_70_79)]
    others = F.count(F.lit(1)) - known[0] - known[1] - known[2]
    return [c.alias(name) for c, name in zip([*known, others], CLASS_COLUMNS)]


def _slot_counts(slot_tz: str) -> list[Column]:
    morning = is_morning(F.col("ts"), slot_tz)
    am = _count_where(morning)
    return [am.alias("am"), (F.count(F.lit(1)) - am).alias("pm")]


def _arrival(positions: DataFrame) -> Column:
    if "arrival" in positions.columns:
        return F.col("arrival")
    return arrival_key(F.col("ts"), F.col("event_id"))


def _per_window(df: DataFrame, ts: str, days: int, keys: list[Column],
                measures: list[Column]) -> DataFrame:
    configure(df.sparkSession)  # day slots and labels follow the session's zone
    window = event_window(F.col(ts), days)
    if df.isStreaming:
        return (df.groupBy(window.alias("window"), *keys).agg(*measures)
                .withColumn("window_start", F.col("window.start")))
    return df.groupBy(window["start"].alias("window_start"), *keys).agg(*measures)


def class_totals(positions: DataFrame, days: int) -> DataFrame:
    """Messages per class in each (window, cell) of the western area, and the ship type of
    the last record to arrive there."""
    rows = positions.transform(within_area).transform(western)
    last = F.max_by("shiptype", _arrival(positions)).alias("last_shiptype")
    return _per_window(rows, "ts", days, [_cell()], [*_class_counts(), last])


def slot_totals(positions: DataFrame, days: int, by_sea: bool,
                slot_tz: str = "UTC") -> DataFrame:
    """Morning and afternoon messages in each (window, cell) of the area. A border cell can
    lie in both seas, so ``by_sea`` adds the sea to the key."""
    rows = positions.transform(within_area)
    keys = [_cell(), _west()] if by_sea else [_cell()]
    return _per_window(rows, "ts", days, keys, _slot_counts(slot_tz))


def slot_totals_with_sea(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    """Slot counts per sector, with the sea in which its last record lay."""
    rows = positions.transform(within_area)
    last = F.max_by(is_west(F.col("lat"), F.col("lon")), _arrival(positions))
    return _per_window(rows, "ts", days, [_cell()],
                       [*_slot_counts(slot_tz), last.alias("last_west"),
                        F.max(_arrival(positions)).alias("last_arrival")])


def slot_totals_with_last(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    """As ``slot_totals`` per sector, with ship, place and time of the last record.

    With ship numbers (``sources.ships``) one scan does: see ``slot_totals_with_last_number``.
    Without, the ship id is a string, which no hash aggregation can carry, so the first scan finds
    only which record is last and a second one fetches it: from the area only, and, in a
    table that is partitioned by day, from the winners' days only. The join is a broadcast as
    long as the stored winners, one per (window, cell), are small enough for Spark's threshold.
    """
    configure(positions.sparkSession)
    rows = positions.transform(within_area)
    record = "arrival" if "arrival" in positions.columns else "event_id"
    day = ["event_date"] if "event_date" in positions.columns else []
    winners = _per_window(rows, "ts", days, [_cell()], [
        *_slot_counts(slot_tz),
        F.max_by(record, _arrival(positions)).alias(record),
        *[F.max_by(c, _arrival(positions)).alias(c) for c in day]])
    winners = materialize(winners, f"slot-winners-{days}")
    records = rows.select(
        record, *day, F.col("ship_id").alias("last_ship_id"), F.col("lat").alias("last_lat"),
        F.col("lon").alias("last_lon"), F.col("ts").alias("last_ts"))
    return records.join(winners, [*day, record]).drop(*day, record)


def slot_totals_with_last_number(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    """The same from one scan, with the ship as ``last_ship_no``: all that is kept of the last record
    has a fixed width, so it travels through the hash aggregation."""
    rows = positions.transform(within_area)
    last = {"last_ship_no": "ship_no", "last_lat": "lat", "last_lon": "lon", "last_ts": "ts"}
    return _per_window(rows, "ts", days, [_cell()], [
        *_slot_counts(slot_tz),
        *[F.max_by(c, _arrival(positions)).alias(name) for name, c in last.items()]])


def with_ship_ids(totals: DataFrame, ships: DataFrame) -> DataFrame:
    """``last_ship_id`` in the place of ``last_ship_no``: a join of a row for each (window, cell)."""
    names = ships.select(F.col("ship_no").alias("last_ship_no"), F.col("ship_id").alias("last_ship_id"))
    return totals.join(names, "last_ship_no", "left").drop("last_ship_no")


def window_counts(positions: DataFrame, days: int) -> DataFrame:
    rows = positions.transform(within_area)
    return _per_window(rows, "ts", days, [_cell()], [F.count(F.lit(1)).alias("n")])


def _all_measures(positions: DataFrame, slot_tz: str) -> list[Column]:
    arrival = _arrival(positions)
    return [*_class_counts(), *_slot_counts(slot_tz),
            F.max_by("shiptype", arrival).alias("last_shiptype"),
            F.max(arrival).alias("last_arrival")]


def rollup(positions: DataFrame, days: int, slot_tz: str = "UTC") -> DataFrame:
    """All measures of both reports per (window, cell, sea), from one pass."""
    rows = positions.transform(within_area)
    return _per_window(rows, "ts", days, [_cell(), _west()], _all_measures(positions, slot_tz))


def rollup_by(positions: DataFrame, keys: list[str], slot_tz: str = "UTC") -> DataFrame:
    """The same per (keys, cell, sea), for rows that know their windows."""
    configure(positions.sparkSession)
    rows = positions.transform(within_area)
    return rows.groupBy(*keys, _cell(), _west()).agg(*_all_measures(positions, slot_tz))


def daily_rollup(positions: DataFrame, slot_tz: str = "UTC") -> DataFrame:
    """Everything the reports of both periods need, per (UTC day, cell, sea).

    7- and 31-day windows are unions of UTC days, counts add up, and the later of two last
    records is the one with the larger arrival, so one scan serves all reports.
    """
    return rollup(positions, 1, slot_tz).withColumnRenamed("window_start", "day")


def class_totals_from_rollup(rollup: DataFrame, days: int) -> DataFrame:
    return _per_window(rollup.where("west"), "day", days, [F.col("cell")], [
        *[F.sum(c).alias(c) for c in CLASS_COLUMNS],
        F.max_by("last_shiptype", "last_arrival").alias("last_shiptype")])


def slot_totals_from_rollup(rollup: DataFrame, days: int, by_sea: bool) -> DataFrame:
    sums = [F.sum("am").alias("am"), F.sum("pm").alias("pm")]
    if by_sea:
        return _per_window(rollup, "day", days, [F.col("cell"), F.col("west")], sums)
    last = F.max_by("west", "last_arrival").alias("last_west")
    latest = F.max("last_arrival").alias("last_arrival")
    return _per_window(rollup, "day", days, [F.col("cell")], [*sums, last, latest])
