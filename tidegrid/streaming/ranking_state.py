"""Cumulative rankings of a stream, with the scores as state that Spark checkpoints.

Closed windows come in, at most one row for each sector and sea; ranked windows go out, in the
order of time. What is kept for a period: the distinct counts of each sector and slot, their sums, and
the lists that were reported last. So the cost of a window is that of its sectors, however many
windows there were before, and a stream that goes on from its checkpoint goes on from its state.

One key holds a whole period, for the ranking is over all sectors. Its rows are those of the grid, 401
cells and two seas for a window, whatever the volume of the stream.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrid.constants import GRID_COLUMNS, GRID_LETTERS, OFF_GRID, TOP_N
from tidegrid.functions import cell_name, rank_list, sea_name

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLOTS = ("am", "pm")

# What a ranked window is: cells in rank order, for a column function to name.
RANKED_SCHEMA = ("days int, window_micros long, last_west boolean, cells_a array<int>, "
                 "cells_p array<int>, changed boolean")
_SEEN_KEY, _SCORE, _LAST = "cell int, slot int, n long", "am long, pm long", (
    "window_micros long, cells_a array<int>, cells_p array<int>")


class Memory:
    """What is known of a period, in plain dictionaries; the stream keeps the same in its state."""

    def __init__(self, seen: Iterable[tuple[int, int, int]] = (), scores: dict | None = None, last=None):
        self.seen, self.scores, self.last = set(seen), dict(scores or {}), last

    def is_new(self, cell: int, slot: int, n: int) -> bool:
        new = (cell, slot, n) not in self.seen
        self.seen.add((cell, slot, n))
        return new

    def add(self, cell: int, am: int, pm: int) -> None:
        old = self.scores.get(cell, (0, 0))
        self.scores[cell] = (old[0] + am, old[1] + pm)

    def all_scores(self) -> Iterable[tuple[int, tuple[int, int]]]:
        return self.scores.items()

    def get_last(self):
        return self.last

    def set_last(self, window: int, lists: tuple[list[int], list[int]]) -> None:
        self.last = (window, *lists)


class _State(Memory):
    """The same on the state of a stream."""

    def __init__(self, handle: StatefulProcessorHandle):
        self._seen = handle.getMapState("seen", _SEEN_KEY, "known boolean")
        self._scores = handle.getMapState("scores", "cell int", _SCORE)
        self._last = handle.getValueState("last", _LAST)

    def is_new(self, cell: int, slot: int, n: int) -> bool:
        if self._seen.containsKey((cell, slot, n)):
            return False
        self._seen.updateValue((cell, slot, n), (True,))
        return True

    def add(self, cell: int, am: int, pm: int) -> None:
        old = self._scores.getValue((cell,)) if self._scores.containsKey((cell,)) else (0, 0)
        self._scores.updateValue((cell,), (old[0] + am, old[1] + pm))

    def all_scores(self) -> Iterable[tuple[int, tuple[int, int]]]:
        return [(key[0], tuple(value)) for key, value in self._scores.iterator()]

    def get_last(self):
        return tuple(self._last.get()) if self._last.exists() else None

    def set_last(self, window: int, lists: tuple[list[int], list[int]]) -> None:
        self._last.update((window, *lists))


def _name(cell: int) -> str:
    """Sector id of a cell, by which ties are broken."""
    return OFF_GRID if cell < 0 else f"{GRID_LETTERS[cell // GRID_COLUMNS]}{cell % GRID_COLUMNS + 1}"


def ranked(rows: Iterable, memory: Memory, suppress_first: bool = True, top_n: int = TOP_N) -> Iterator[dict]:
    """The ranked windows of closed rows (window_micros, cell, west, am, pm, last_arrival).

    A window that is not after the last one was reported before, by a batch that is run again.
    """
    windows: dict[int, list] = {}
    for row in rows:
        windows.setdefault(row["window_micros"], []).append(row)
    for window in sorted(windows):
        last = memory.get_last()
        if last is not None and window <= last[0]:
            continue
        cells: dict[int, list[int]] = {}
        for row in windows[window]:
            counts = cells.setdefault(row["cell"], [0, 0])
            counts[0] += row["am"]
            counts[1] += row["pm"]
        for cell, counts in cells.items():
            gain = [n if memory.is_new(cell, slot, n) else 0 for slot, n in enumerate(counts)]
            memory.add(cell, *gain)
        scores = [(cell, score, _name(cell)) for cell, score in memory.all_scores()]
        lists = tuple([cell for cell, _, _ in sorted(scores, key=lambda s: (-s[1][slot], s[2]))[:top_n]]
                      for slot in range(len(SLOTS)))
        first = last is None and suppress_first
        # The first window is no report, so what follows it is compared with nothing.
        memory.set_last(window, ([], []) if first else lists)
        if not first:
            latest = max(windows[window], key=lambda row: row["last_arrival"])
            yield {"window_micros": window, "last_west": latest["west"], "cells_a": lists[0], "cells_p": lists[1],
                   "changed": last is None or (list(last[1]), list(last[2])) != lists}


class CumulativeRanking(StatefulProcessor):
    """Ranks the windows that close in a batch, for each period."""

    def __init__(self, columns: list[str], suppress_first: bool = True):
        self.columns, self.suppress_first = columns, suppress_first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = _State(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        for row in rows:
            yield Row(closed=Row(**{c: row[c] for c in self.columns}), ranked=None)
        for window in ranked(rows, self.memory, self.suppress_first):
            yield Row(closed=None, ranked=Row(days=key[0], **window))

    def close(self) -> None:
        pass


def with_state_store(session: SparkSession) -> SparkSession:
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return session


def closed_and_ranked(closed: DataFrame, suppress_first: bool = True) -> DataFrame:
    """A stream with two kinds of rows: ``closed``, the rows as they came, and ``ranked`` windows."""
    with_state_store(closed.sparkSession)
    rows = closed.withColumn("window_micros", F.unix_micros("window_start")).drop("window", "window_start")
    kinds = T.StructType([T.StructField("closed", rows.schema),
                          T.StructField("ranked", T.StructType.fromDDL(RANKED_SCHEMA))])
    return rows.groupBy("days").transformWithState(
        CumulativeRanking(rows.columns, suppress_first), kinds, "Append", "None")


def closed_rows(both: DataFrame) -> DataFrame:
    return both.where("closed IS NOT NULL").select("closed.*").withColumn(
        "window_start", F.timestamp_micros("window_micros")).drop("window_micros")


def ranked_rows(both: DataFrame) -> DataFrame:
    """(days, window_start, sea, rank_a, rank_p, changed) of the ranked windows."""
    def named(cells: str):
        return rank_list(F.transform(cells, cell_name))
    rows = both.where("ranked IS NOT NULL").select("ranked.*")
    return rows.select(
        "days", F.timestamp_micros("window_micros").alias("window_start"), sea_name(F.col("last_west")).alias("sea"),
        named("cells_a").alias("rank_a"), named("cells_p").alias("rank_p"), "changed")
