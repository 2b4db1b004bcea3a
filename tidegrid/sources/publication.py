"""Files written by one job, made visible in event order.

A file stream reads new files by their time of modification, and all files of one write have
about the same. So a job writes to a staging folder, which streams do not see. Its files are then
stamped with ascending times, whole seconds apart, for stores that keep no less, and moved to their place
one by one: file operations only, no job for each day. Moving goes on where it broke off.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from tidegrid.session import data_files, is_complete, move, remove, stamp

STAGED = "_staged"
STEP_MILLIS = 1000
DAY = "event_date"


def stage(rows: DataFrame, target: str, run: int = 0, **options: str) -> str:
    """Write rows, which have an ``event_date``, by day to the staging folder of a run."""
    folder = f"{target}/{STAGED}/run={run}"
    rows.write.mode("overwrite").options(**options).partitionBy(DAY).parquet(folder)
    return folder


def reveal(spark: SparkSession, target: str, run: int = 0, flat: bool = False) -> int:
    """Move the files of a staged run to their place, day by day; gives their number.

    ``flat``: into one folder, else below a folder for each day. A run whose write did not finish,
    or that was revealed before, reveals nothing.
    """
    folder = f"{target}/{STAGED}/run={run}"
    if not is_complete(spark, folder):
        return 0
    staged = data_files(spark, folder)
    latest = max((millis for _, millis in data_files(spark, target)), default=0)
    millis = (max(latest, int(time.time() * 1000)) // STEP_MILLIS + 1) * STEP_MILLIS
    for path, _ in staged:
        day, name = path.split("/")[-2:]
        if not stamp(spark, path, millis):
            raise OSError(f"{target} lies in a store that keeps no times: write it day by day (append_days)")
        move(spark, path, f"{target}/{day.split('=')[1]}-{name}" if flat else f"{target}/{day}/{name}")
        millis += STEP_MILLIS
    remove(spark, folder)
    return len(staged)
