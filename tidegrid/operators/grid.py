"""Sector ids per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions import cell_code, cell_name


def with_sector(positions: DataFrame) -> DataFrame:
    """Add the sector id. The cell code is worked out in a projection of its own, which
    Spark keeps apart because the name refers to it more than once."""
    return (positions.withColumn("cell", cell_code(F.col("lat"), F.col("lon")))
            .withColumn("sector", cell_name(F.col("cell")))
            .drop("cell"))
