"""Column functions. All are built-in expressions, so they stay in generated code."""

from tidegrid.functions.arrival import arrival_key
from tidegrid.functions.geo import (
    cell_code, cell_name, in_area, is_east, is_west, sea_label, sea_name)
from tidegrid.functions.render import rank_list
from tidegrid.functions.ships import is_class, ship_class
from tidegrid.functions.timeslots import day_slot, event_window, is_morning, window_label

__all__ = [
    "arrival_key", "cell_code", "cell_name", "day_slot", "event_window", "in_area",
    "is_class", "is_east", "is_morning", "is_west", "rank_list", "sea_label", "sea_name",
    "ship_class", "window_label",
]
