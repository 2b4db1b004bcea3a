"""Row filters. All are plain comparisons, so they reach the Parquet scan.

In a stream they refer to the event time as well: Spark would otherwise apply them before the
watermark, which then would not see the records that they leave out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.functions import in_area, is_east, is_west
from tidegrid.functions.geo import cell_of_name, in_cell


def _kept(positions: DataFrame, condition: Column) -> DataFrame:
    if positions.isStreaming:
        condition = F.when(F.col("ts").isNotNull(), condition)
    return positions.where(condition)


def within_area(positions: DataFrame) -> DataFrame:
    return _kept(positions, in_area(F.col("lat"), F.col("lon")))


def western(positions: DataFrame) -> DataFrame:
    return _kept(positions, is_west(F.col("lat"), F.col("lon")))


def eastern(positions: DataFrame) -> DataFrame:
    return _kept(positions, is_east(F.col("lat"), F.col("lon")))


def in_sector(positions: DataFrame, sector: str) -> DataFrame:
    return _kept(positions, in_cell(F.col("lat"), F.col("lon"), cell_of_name(sector)))
