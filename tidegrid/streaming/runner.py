"""Starting streams and letting finite ones finish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegrid.session import configure, new_workspace

# Rows reach the shuffle already aggregated, at most a few hundred sectors per open window,
# so the number of state stores follows the grid and not the volume of the stream, nor the
# machine: a stream's first run fixes it for good.
STATE_PARTITIONS = 16


def streaming_session(spark: SparkSession, state_partitions: int = STATE_PARTITIONS) -> SparkSession:
    """A session of its own, for the partition count of a stream is fixed by its first run."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def start_file_sink(stream: DataFrame, out: str, fmt: str = "parquet", finite: bool = True,
                    **options: str) -> StreamingQuery:
    """Append to a file sink, which records its batches and so writes each row once."""
    writer = (stream.writeStream.outputMode("append").format(fmt)
              .option("checkpointLocation", f"{out}.checkpoint").options(**options))
    if finite:
        writer = writer.trigger(availableNow=True)
    return writer.start(out)


def start_closed_windows(totals: DataFrame, write: Callable[[DataFrame, int], None],
                         checkpoint: str, finite: bool = True) -> StreamingQuery:
    """Give the windows that close in a micro-batch to ``write``, together with the batch
    id, by which it must make its output repeatable. Batches that close none are passed
    over."""
    def on_batch(closed: DataFrame, batch_id: int) -> None:
        # counted in full, so that every state store commits even if no window closed
        closed = closed.persist()
        try:
            if closed.count():
                write(closed, batch_id)
        finally:
            closed.unpersist()

    writer = (totals.writeStream.outputMode("append").foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    if finite:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_table(stream: DataFrame, name: str) -> tuple[DataFrame, StreamingQuery]:
    """Process all that is available, then give the sink's content as a batch frame."""
    rows, query, _ = run_to_checkpoint(stream, name)
    return rows, query


def run_to_checkpoint(stream: DataFrame, name: str) -> tuple[DataFrame, StreamingQuery, str]:
    """The same, and the checkpoint, from which the windows that are still open can be read."""
    spark = stream.sparkSession
    out = new_workspace(spark, name)
    query = start_file_sink(stream, out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), query, f"{out}.checkpoint"
