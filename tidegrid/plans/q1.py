"""Mean daily messages per ship class and sector of the western sea."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.constants import LABEL_35, LABEL_60_69, LABEL_70_79, LABEL_OTHERS
from tidegrid.functions import cell_name, window_label
from tidegrid.operators.aggregates import (
    CLASS_COLUMNS, class_totals, class_totals_from_rollup)

AVERAGES = {"n_35": "avg_35", "n_60_69": "avg_60_69",
            "n_70_79": "avg_70_79", "n_others": "avg_others"}


def report(totals: DataFrame, days: int) -> DataFrame:
    """Whole messages per day: the count divided by the window length, without remainder,
    also where the data covers only part of the window."""
    return totals.select(
        "window_start",
        cell_name(F.col("cell")).alias("sector"),
        *[F.expr(f"CAST({c} DIV {days} AS DOUBLE)").alias(AVERAGES[c]) for c in CLASS_COLUMNS],
        "last_shiptype")


def q1(positions: DataFrame, days: int) -> DataFrame:
    return report(class_totals(positions, days), days)


def q1_from_rollup(rollup: DataFrame, days: int) -> DataFrame:
    return report(class_totals_from_rollup(rollup, days), days)


def rendered(q1_rows: DataFrame) -> DataFrame:
    """The eleven-column result row with class labels."""
    return q1_rows.select(
        window_label(F.col("window_start")).alias("date"),
        F.col("last_shiptype").alias("stype"),
        F.col("sector").alias("id_cella"),
        F.lit(LABEL_35).alias("stype_35"), "avg_35",
        F.lit(LABEL_60_69).alias("stype_6069"), F.col("avg_60_69").alias("avg_6069"),
        F.lit(LABEL_70_79).alias("stype_7079"), F.col("avg_70_79").alias("avg_7079"),
        F.lit(LABEL_OTHERS).alias("stype_others"), "avg_others")
