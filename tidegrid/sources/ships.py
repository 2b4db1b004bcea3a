"""Ship ids as numbers, so that an aggregation can carry a ship in a fixed-width buffer.

The dictionary is a table (ship_no, ship_id), which grows by a run for each part of a log that brings
new ships. Numbers are unique and never change; they say nothing about order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.session import is_complete

SHIPS_SCHEMA = "ship_no bigint, ship_id string"


def _runs(spark: SparkSession, path: str, most: int | None = None) -> list[str]:
    runs: list[str] = []
    while (most is None or len(runs) < most) and is_complete(spark, f"{path}/run={len(runs)}"):
        runs.append(f"{path}/run={len(runs)}")
    return runs


def read_ships(spark: SparkSession, path: str, runs: int | None = None) -> DataFrame:
    """The dictionary, or its first ``runs``."""
    found = _runs(spark, path, runs)
    return spark.read.schema(SHIPS_SCHEMA).parquet(*found) if found else spark.createDataFrame([], SHIPS_SCHEMA)


def add_ships(records: DataFrame, path: str, run: int) -> DataFrame:
    """Write the ships that earlier runs do not know as a run of the dictionary; gives all of it."""
    spark = records.sparkSession
    known = read_ships(spark, path, run)
    first = F.coalesce(known.agg(F.max("ship_no") + 1).scalar(), F.lit(0))
    new = records.select("ship_id").where("ship_id IS NOT NULL").distinct().join(known, "ship_id", "left_anti")
    new.select((F.monotonically_increasing_id() + first).alias("ship_no"), "ship_id").write.mode(
        "overwrite").parquet(f"{path}/run={run}")
    return read_ships(spark, path, run + 1)


def with_numbers(records: DataFrame, ships: DataFrame) -> DataFrame:
    """Add ``ship_no``, null without a ship id. The dictionary is broadcast if Spark finds it small."""
    return records.join(ships, "ship_id", "left")
