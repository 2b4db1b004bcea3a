"""Late records, one by one.

Spark tells how many groups the watermark dropped, not which records. Here the watermark in force at
each batch is kept beside the stream: the latest time of all batches before, less the delay. A record
is late if its window had ended by then, and is written with that watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegrid.constants import WATERMARK_DELAY
from tidegrid.functions import event_window
from tidegrid.session import is_complete

_LATEST = "latest timestamp"


def record_late(rows: DataFrame, batch_id: int, days: int, out: str) -> None:
    """Write a batch's late records to ``out/late`` and the latest time so far to ``out/latest``.

    Both go to folders of the batch, so a batch that is run again leaves the same.
    """
    spark = rows.sparkSession
    before = f"{out}/latest/batch={batch_id - 1}"
    known = spark.read.schema(_LATEST).parquet(before) if is_complete(spark, before) else (
        spark.createDataFrame([(None,)], _LATEST))
    latest = known.agg(F.max("latest")).scalar()
    watermark = (latest - F.expr(f"INTERVAL {WATERMARK_DELAY}")).alias("watermark")
    late = rows.select("*", watermark).where(event_window(F.col("ts"), days)["end"] <= F.col("watermark"))
    late.write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
    own = rows.agg(F.max("ts").cast("timestamp").alias("own"))
    own.select(F.greatest("own", latest).alias("latest")).coalesce(1).write.mode("overwrite").parquet(
        f"{out}/latest/batch={batch_id}")


def start_late_rows(positions: DataFrame, days: int, out: str, finite: bool = True) -> StreamingQuery:
    """Write the late records of a feed, for windows of so many days."""
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            record_late(rows, batch_id, days, out)
        finally:
            rows.unpersist()

    writer = positions.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{out}/checkpoint")
    if finite:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_late(spark: SparkSession, out: str, positions: DataFrame) -> DataFrame:
    """The late records so far, with the watermark by which each was late."""
    layout = positions.schema.add("watermark", "timestamp").add("batch", "long")
    return spark.read.schema(layout).parquet(f"{out}/late").drop("batch")
