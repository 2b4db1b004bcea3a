"""Study area, seas and the lettered grid.

The grid rule takes the first edge that is not below the value. Edges are decimals such
as 35.6, and a coordinate is a double that was printed as a short decimal, so comparing
the double with the double nearest to the edge gives the same answer as comparing the two
decimals. ``(first + step * k) / 10`` over whole numbers is that nearest double, for one
division is correctly rounded. That keeps the hot path free of decimal arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegrid.constants import (
    AREA_LAT, AREA_LON, CHANNEL_LAT, CHANNEL_LON, GRID_COLUMNS, GRID_LETTERS,
    LAT_EDGES_TENTHS, LON_EDGES_TENTHS, OFF_GRID, SEA_EAST, SEA_WEST)

OFF_GRID_CODE = -1


def in_area(lat: Column, lon: Column) -> Column:
    return lon.between(*AREA_LON) & lat.between(*AREA_LAT)


def is_west(lat: Column, lon: Column) -> Column:
    return (lat > F.lit(CHANNEL_LAT)) & (lon < F.lit(CHANNEL_LON))


def is_east(lat: Column, lon: Column) -> Column:
    return (lat < F.lit(CHANNEL_LAT)) & (lon > F.lit(CHANNEL_LON))


def sea_name(west: Column) -> Column:
    """Whatever is not strictly north-west of the channel counts as the eastern sea."""
    return F.when(west, F.lit(SEA_WEST)).otherwise(F.lit(SEA_EAST))


def sea_label(lat: Column, lon: Column) -> Column:
    return sea_name(is_west(lat, lon))


def _edge(tenths: tuple[int, int, int], index: Column) -> Column:
    first, step, _ = tenths
    return (F.lit(first) + F.lit(step) * index) / F.lit(10)


def _last_edge(tenths: tuple[int, int, int]) -> Column:
    first, step, last = tenths
    return F.lit((first + step * last) / 10)


def _edge_index(value: Column, tenths: tuple[int, int, int]) -> Column:
    """Index of the first edge >= value: a guess by division, put right by one comparison
    with the edge on either side."""
    first, step, last = tenths
    position = (value * F.lit(10.0) - F.lit(float(first))) / F.lit(float(step))
    guess = F.ceil(F.greatest(F.least(position, F.lit(last + 1.0)), F.lit(0.0)))
    exact = (guess
             + (value > _edge(tenths, guess)).cast("int")
             - (value <= _edge(tenths, guess - F.lit(1))).cast("int"))
    return F.greatest(exact, F.lit(0))


def cell_code(lat: Column, lon: Column) -> Column:
    """Grid cell as a small integer, the form to group by; -1 is off the grid."""
    top_band = F.lit(len(GRID_LETTERS) - 1)
    band = F.least(_edge_index(lat, LAT_EDGES_TENTHS), top_band)
    column = _edge_index(lon, LON_EDGES_TENTHS)
    off_grid = (lat > _last_edge(LAT_EDGES_TENTHS)) | (lon > _last_edge(LON_EDGES_TENTHS))
    return (F.when(off_grid, F.lit(OFF_GRID_CODE))
             .otherwise(band * F.lit(GRID_COLUMNS) + column).cast("int"))


def cell_name(code: Column) -> Column:
    """Sector id of a cell code, such as ``D7``. The code should be a column of its own, for
    this refers to it several times: group by the code and name the groups, or see
    ``with_sector``."""
    band = F.floor(code / F.lit(GRID_COLUMNS)).cast("int")
    letter = F.substring(F.lit(GRID_LETTERS), band + F.lit(1), F.lit(1))
    number = (code % F.lit(GRID_COLUMNS) + F.lit(1)).cast("string")
    return (F.when(code == F.lit(OFF_GRID_CODE), F.lit(OFF_GRID))
             .otherwise(F.concat(letter, number)))


def cell_bounds(code: int) -> tuple[float | None, float | None, float | None, float | None]:
    """(lat above, lat up to, lon above, lon up to) of a cell on the grid; None where it has no bound."""
    band, column = divmod(code, GRID_COLUMNS)

    def edge(tenths: tuple[int, int, int], index: int) -> float | None:
        first, step, _ = tenths
        return (first + step * index) / 10 if index >= 0 else None

    top = LAT_EDGES_TENTHS[2] if band == len(GRID_LETTERS) - 1 else band  # the last letter has two bands
    return (edge(LAT_EDGES_TENTHS, band - 1), edge(LAT_EDGES_TENTHS, top),
            edge(LON_EDGES_TENTHS, column - 1), edge(LON_EDGES_TENTHS, column))


def in_cell(lat: Column, lon: Column, code: int) -> Column:
    """Whether a place lies in a cell, as comparisons that reach a scan and its statistics."""
    if code == OFF_GRID_CODE:
        return (lat > _last_edge(LAT_EDGES_TENTHS)) | (lon > _last_edge(LON_EDGES_TENTHS))
    south, north, west, east = cell_bounds(code)
    found = (lat <= F.lit(north)) & (lon <= F.lit(east))
    if south is not None:
        found = found & (lat > F.lit(south))
    return found & (lon > F.lit(west)) if west is not None else found


def cell_of_name(sector: str) -> int:
    """The code of a sector id such as ``D7``."""
    if sector == OFF_GRID:
        return OFF_GRID_CODE
    return GRID_LETTERS.index(sector[0]) * GRID_COLUMNS + int(sector[1:]) - 1
