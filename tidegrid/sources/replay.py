"""Replay of a stored position table as a file stream.

Spark reads new files by modification time. All files of one write have about the same
time, so a table written in one go would be read out of event-time order and rows would be
dropped as late. The feed is written by one job, in parallel, and its files are then made visible in
event order (``publication``). Within a day order does not matter: every window ends on a
UTC day boundary, so no row of a day can be late because of another row of that day.

A table that ingest took in bit by bit is published in this way itself, so a stream can read it as it is
(``read_positions``), without a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.session import configure, data_files
from tidegrid.sources import publication

# Closes all windows of a finite replay; its own window stays open and is never reported.
SENTINEL_YEAR = 9999
SENTINEL = (f"'' ship_id, TIMESTAMP '{SENTINEL_YEAR}-01-01' ts, CAST(0 AS INT) shiptype, "
            "CAST(40.0 AS DOUBLE) lat, CAST(5.0 AS DOUBLE) lon, CAST(-1 AS BIGINT) arrival")
FEED_SCHEMA = ("ship_id string, ts timestamp, shiptype int, lat double, lon double, "
               "arrival bigint")
FEED_COLUMNS = tuple(field.split()[0] for field in FEED_SCHEMA.split(", "))


def append(rows: DataFrame, feed: str) -> None:
    rows.write.mode("append").parquet(feed)


def append_days(positions: DataFrame, feed: str) -> None:
    """Append a day-partitioned table to the feed, one append per day. The list of days
    comes from the partition values; each append reads only its own day."""
    days = [r["event_date"] for r in
            positions.select("event_date").distinct().orderBy("event_date").collect()]
    for day in days:
        append(positions.where(F.col("event_date") == F.lit(day)).select(*FEED_COLUMNS), feed)


def append_sentinel(spark: SparkSession, feed: str) -> None:
    append(spark.sql(f"SELECT {SENTINEL}"), feed)


def published_until(spark: SparkSession, feed: str):
    """The last day in the feed, if any; a finished feed ends with the sentinel's."""
    if not data_files(spark, feed):
        return None
    return _published(spark, feed).agg(F.max(F.to_date("ts"))).first()[0]


def _published(spark: SparkSession, feed: str) -> DataFrame:
    """What is in the feed, also after a write that broke off."""
    return spark.read.schema(FEED_SCHEMA).parquet(feed)


def publish(positions: DataFrame, feed: str, sentinel: bool = True) -> str:
    """Write a whole table as a finished feed, by one job. Run again after a failure, it makes visible
    what is staged, and writes those rows of the last day that are missing and the days after it; on a
    finished feed it does nothing. Without ``sentinel`` the last windows stay open."""
    spark = configure(positions.sparkSession)
    publication.reveal(spark, feed, flat=True)
    last = published_until(spark, feed)
    if last is not None and last.year >= SENTINEL_YEAR:
        return feed
    rest = positions
    if last is not None:
        day = F.col("event_date") == F.lit(last)
        written = _published(spark, feed).where(F.to_date("ts") == F.lit(last)).select("arrival")
        rest = positions.where(day).join(written, "arrival", "left_anti").unionByName(
            positions.where(F.col("event_date") > F.lit(last)))
    columns = (*FEED_COLUMNS, publication.DAY)
    rest = rest.select(*columns)
    if sentinel:
        rest = rest.unionByName(spark.sql(f"SELECT {SENTINEL}, DATE '{SENTINEL_YEAR}-01-01' event_date"))
    publication.stage(rest, feed)
    publication.reveal(spark, feed, flat=True)
    return feed


def read_positions(spark: SparkSession, positions: str, max_files_per_trigger: int = 64) -> DataFrame:
    """A table published by ``normalized.take_in`` as a stream, now and as it grows."""
    return (spark.readStream.schema(f"{FEED_SCHEMA}, event_date date")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(positions).drop("event_date"))


def read_feed(spark: SparkSession, feed: str, max_files_per_trigger: int = 64) -> DataFrame:
    return (spark.readStream.schema(FEED_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(feed))
