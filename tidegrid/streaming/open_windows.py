"""What a finite run leaves open, read from the state it checkpointed.

A stream reports a window when the watermark passes its end, so the last windows of a finite feed
stay in the state. These functions read that state as a table and give its windows like the
closed ones, so the data need no record that closes them. The state is left as it is: if the feed goes on, the
stream reports these windows in its own time, and what was read here was provisional.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.operators.aggregates import CLASS_COLUMNS
from tidegrid.streaming.ranking_state import RANKED_SCHEMA, Memory, ranked

AGGREGATION, RANKING = "stateStoreSave", "transformWithStateInPySparkExec"

# What an aggregation keeps for a group, in the order of its functions; equal functions are kept once,
# and a maximum by another column keeps both.
_CLASSES = "n_35 bigint, n_60_69 bigint, n_70_79 bigint, total bigint"
CLASS_STATE = f"{_CLASSES}, last_shiptype int, last_arrival bigint"
ROLLUP_STATE = f"{_CLASSES}, am bigint, last_shiptype int, by_arrival bigint, last_arrival bigint"


def _operator(spark: SparkSession, checkpoint: str, name: str) -> int:
    found = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == name)
    return found.first()["operatorId"]


def _groups(spark: SparkSession, checkpoint: str, keys: str, values: str) -> DataFrame:
    """The groups of the aggregation, with names for their keys and for what is kept of them."""
    def named(fields: str) -> str:
        return f"struct<{', '.join(f.strip().replace(' ', ':', 1) for f in fields.split(';'))}>"
    state = spark.read.format("statestore").option(
        "operatorId", _operator(spark, checkpoint, AGGREGATION)).load(checkpoint)
    rows = state.select(F.col("key").cast(named(keys)).alias("key"),
                        F.col("value").cast(named(values.replace(",", ";"))).alias("value"))
    others = F.col("total") - F.col("n_35") - F.col("n_60_69") - F.col("n_70_79")
    return rows.select("key.*", "value.*").withColumns(
        {"n_others": others, "window_start": F.col("window.start")})


_WINDOW = "window struct<start:timestamp,end:timestamp>"


def open_class_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The open windows of a stream of ``class_totals``."""
    rows = _groups(spark, checkpoint, f"{_WINDOW};cell int", CLASS_STATE)
    return rows.select("window_start", "cell", *CLASS_COLUMNS, "last_shiptype")


def open_rollup(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The open windows of a stream of ``periods.closed_windows``."""
    rows = _groups(spark, checkpoint, f"days int;{_WINDOW};cell int;west boolean", ROLLUP_STATE)
    return rows.withColumn("pm", F.col("total") - F.col("am")).select(
        "days", "window_start", "cell", "west", *CLASS_COLUMNS, "am", "pm", "last_shiptype", "last_arrival")


_RANKING_ROWS = ("days int, kind string, window_micros bigint, cell int, slot int, n bigint, am bigint, pm bigint, "
                 "west boolean, last_arrival bigint, cells_a array<int>, cells_p array<int>")
_RANKED = pa.schema([("days", pa.int32()), ("window_micros", pa.int64()), ("last_west", pa.bool_()),
                     ("cells_a", pa.list_(pa.int32())), ("cells_p", pa.list_(pa.int32())), ("changed", pa.bool_())])


def _rank(suppress_first: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()

        def of(kind: str) -> Iterator[dict]:
            return (row for row in rows if row["kind"] == kind)
        last = next(((r["window_micros"], r["cells_a"], r["cells_p"]) for r in of("last")), None)
        memory = Memory(((r["cell"], r["slot"], r["n"]) for r in of("seen")),
                        {r["cell"]: (r["am"], r["pm"]) for r in of("scores")}, last)
        found = ranked(of("open"), memory, suppress_first)
        return pa.Table.from_pylist([{"days": rows[0]["days"], **window} for window in found], schema=_RANKED)
    return run


def open_ranked(spark: SparkSession, checkpoint: str, open_rows: DataFrame, suppress_first: bool = True) -> DataFrame:
    """(ranked) windows as ``ranking_state.closed_and_ranked`` would rank the open ones."""
    operator = _operator(spark, checkpoint, RANKING)

    def state(variable: str) -> DataFrame:
        return (spark.read.format("statestore").option("operatorId", operator)
                .option("stateVarName", variable).load(checkpoint))
    days = F.col("key.days").alias("days")
    parts = {
        "seen": state("seen").select(days, "user_map_key.cell", "user_map_key.slot", "user_map_key.n"),
        "scores": state("scores").select(days, "user_map_key.cell", "user_map_value.am", "user_map_value.pm"),
        "last": state("last").select(days, "value.window_micros", "value.cells_a", "value.cells_p"),
        "open": open_rows.select("days", F.unix_micros("window_start").alias("window_micros"), "cell", "west",
                                 "am", "pm", "last_arrival"),
    }
    rows = spark.createDataFrame([], _RANKING_ROWS)
    for kind, part in parts.items():
        rows = rows.unionByName(part.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    found = rows.groupBy("days").applyInArrow(_rank(suppress_first), RANKED_SCHEMA)
    return found.select(F.struct(*found.columns).alias("ranked"))
