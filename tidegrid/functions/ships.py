"""Ship-type classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegrid.constants import (
    CLASS_35, CLASS_60_69, CLASS_70_79, LABEL_35, LABEL_60_69, LABEL_70_79, LABEL_OTHERS)


def is_class(shiptype: Column, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return (shiptype >= F.lit(low)) & (shiptype <= F.lit(high))


def ship_class(shiptype: Column) -> Column:
    return (F.when(is_class(shiptype, CLASS_35), F.lit(LABEL_35))
             .when(is_class(shiptype, CLASS_60_69), F.lit(LABEL_60_69))
             .when(is_class(shiptype, CLASS_70_79), F.lit(LABEL_70_79))
             .otherwise(F.lit(LABEL_OTHERS)))
