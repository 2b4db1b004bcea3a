"""Record counts, observed while a query runs and without a pass of their own.

A stream remembers only its last batches. ``BatchCounts`` writes each batch's counts to a table, so that
they are whole for a stream of any length, over restarts too.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegrid.session import data_files

RECORDS = "records"
LATE = "late"
COUNTS_SCHEMA = "query string, batch bigint, name string, n bigint"


def count_records(df: DataFrame, observation: Observation | str) -> DataFrame:
    """Pass rows through and count them. Batch: an ``Observation``; stream: a metric name."""
    return df.observe(observation, F.count(F.lit(1)).alias(RECORDS))


class BatchCounts(StreamingQueryListener):
    """Writes what each batch of each stream of a session counted to a table: the observed records by
    name, and the rows dropped by the watermark as LATE. A batch that is run again replaces its counts.

    Events come after the batches; ``wait_for`` waits until those of a finished query are written.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = {name: row[RECORDS] for name, row in progress.observedMetrics.items() if RECORDS in row}
        counts[LATE] = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        rows = [(str(progress.id), progress.batchId, name, n) for name, n in counts.items()]
        (self.spark.createDataFrame(rows, COUNTS_SCHEMA).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.out}/of={progress.id}-{progress.batchId}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        query.awaitTermination()
        return self._end_of(str(query.runId)).wait(seconds)


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """(query, batch, name, n) of all batches that a ``BatchCounts`` has written."""
    if not data_files(spark, out):
        return spark.createDataFrame([], COUNTS_SCHEMA)
    return spark.read.schema(COUNTS_SCHEMA).option("recursiveFileLookup", True).parquet(out)


def streamed_records(query: StreamingQuery, name: str) -> int:
    """Records counted under ``name`` in the batches Spark still remembers; see ``BatchCounts``."""
    return sum(p.observedMetrics[name][RECORDS] for p in query.recentProgress
               if name in p.observedMetrics)


def late_rows(query: StreamingQuery) -> int:
    """Partial aggregates dropped by the watermark; several late rows of one group may
    count as one."""
    return sum(op.numRowsDroppedByWatermark
               for p in query.recentProgress for op in p.stateOperators)
