"""Text forms used by the literal result rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rank_list(sectors: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(sectors, ", "), F.lit("}"))
