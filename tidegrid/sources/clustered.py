"""Positions stored by place: inside a day along a space-filling curve.

Neighbouring places share row groups, so the smallest and largest coordinates that Parquet keeps for
each let a reader pass over those outside a box or a sector. The order of arrival is a column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.session import stored_bytes
from tidegrid.sources.normalized import CODEC, sort_partitions

STEPS = 16  # of the curve, in a degree
ROW_GROUP_BYTES = 8 << 20

# Shifts and masks that put a zero before each of 16 bits.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(steps: Column) -> Column:
    return reduce(lambda bits, how: bits.bitwiseOR(F.shiftleft(bits, how[0])).bitwiseAND(F.lit(how[1])),
                  _SPREAD, steps.cast("long"))


def curve(lat: Column, lon: Column) -> Column:
    """Place on the curve: the bits of both coordinates, in steps, by turns. Places without
    coordinates come first."""
    x, y = (F.floor((value + F.lit(offset)) * F.lit(STEPS)) for value, offset in ((lon, 180.0), (lat, 90.0)))
    return F.coalesce(F.shiftleft(_spread(y), 1).bitwiseOR(_spread(x)), F.lit(-1).cast("long"))


def write_clustered(positions: DataFrame, path: str, size: int, row_group_bytes: int = ROW_GROUP_BYTES,
                    partitions: int | None = None) -> DataFrame:
    """Store positions, which have ``event_date`` and ``arrival``, by day and place.

    ``size``: bytes of the table they come from, by which the number of tasks goes. A busy day, or a busy
    place, is split over tasks by the next column.
    """
    spark = positions.sparkSession
    order = ("event_date", "_curve", "arrival")
    (positions.withColumn("_curve", curve(F.col("lat"), F.col("lon")))
     .repartitionByRange(partitions or sort_partitions(spark, size), *order)
     .sortWithinPartitions(*order).drop("_curve")
     .write.mode("overwrite").option("compression", CODEC).option("parquet.block.size", row_group_bytes)
     .partitionBy("event_date").parquet(path))
    return spark.read.schema(positions.schema).parquet(path)


def clustered_copy(positions: DataFrame, source: str, path: str) -> DataFrame:
    """The table stored at ``source``, by place."""
    return write_clustered(positions, path, stored_bytes(positions.sparkSession, source))
