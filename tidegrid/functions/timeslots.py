"""Event-time windows, day slots and labels.

Windows are aligned to the epoch in UTC. Slots may follow another zone (``slot_tz``); the
session zone is UTC, so only that case needs a conversion.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegrid.constants import NOON_HOUR, SLOT_AM, SLOT_PM, WINDOW_LABEL_PATTERN


def event_window(ts: Column, days: int) -> Column:
    return F.window(ts, f"{days} days")


def is_morning(ts: Column, slot_tz: str = "UTC") -> Column:
    if slot_tz != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(slot_tz), ts.cast("timestamp_ntz"))
    return F.hour(ts) < F.lit(NOON_HOUR)


def day_slot(ts: Column, slot_tz: str = "UTC") -> Column:
    return F.when(is_morning(ts, slot_tz), F.lit(SLOT_AM)).otherwise(F.lit(SLOT_PM))


def window_label(window_start: Column) -> Column:
    return F.date_format(window_start, WINDOW_LABEL_PATTERN)
