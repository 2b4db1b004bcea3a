"""Places in a linked list that is stored as a table, found by contraction.

A task takes the elements of its partition in chunks. Within a chunk it follows the links, so that
every run of linked elements becomes one element: the run's head, as long as the run. The heads
form a shorter list, which is contracted again, dealt by another range each round. A list of at
most LAST elements is one chunk. Going back up, an element's place is its head's place and its
way from the head. Any chunking gives the right places; good ranges only make the rounds few. If
a round keeps more than KEPT of the elements, what is left is ranked by doubling instead: each
element looks up the element that its link points to, until all links lead to the end.

Rounds are stored, so that a lost executor repeats a task. No task holds more than CHUNK elements.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

CHUNK = 1 << 18
LAST = 1 << 18
KEPT = 0.75

_RUNS = "element long, head long, way long, next long, length long, a long, b long"


def runs(element: np.ndarray, follower: np.ndarray, length: np.ndarray):
    """For the elements of a chunk: the place of each one's head, the way from it, and, for a head,
    the length of its run and the place of its last element. A follower of -1 ends the list."""
    n = len(element)
    order = np.argsort(element)
    at = np.searchsorted(element, follower, sorter=order)
    at = order[np.minimum(at, n - 1)]
    linked = element[at] == follower
    before = np.arange(n)
    before[at[linked]] = np.flatnonzero(linked)
    step = np.zeros(n, np.int64)
    step[at[linked]] = length[linked]
    while True:
        further = before[before]
        if np.array_equal(further, before):
            break
        step += step[before]
        before = further
    last = np.flatnonzero(~linked)
    ends = np.empty(n, np.int64)
    ends[before[last]] = last
    return before, step, ends


def _contract(chunk: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                if size + part.num_rows > chunk:
                    yield _contracted(held)
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield _contracted(held)
    return run


def _contracted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    element, follower, length, a, b = (
        column.to_numpy() for column in pa.Table.from_batches(held).columns)
    head, way, ends = runs(element, follower, length)
    is_head = head == np.arange(len(element))
    end = np.where(is_head, ends, 0)
    return pa.RecordBatch.from_arrays([
        pa.array(element), pa.array(element[head]), pa.array(way),
        pa.array(follower[end], mask=~is_head), pa.array(way[end] + length[end], mask=~is_head),
        pa.array(a), pa.array(b)], names=["element", "head", "way", "next", "length", "a", "b"])


def _doubled(heads: DataFrame) -> DataFrame:
    """(element, place): by pointer doubling, from the lengths up to the end of the list."""
    left = heads.select("element", "next", "length")
    total = left.agg(F.sum("length")).scalar()
    while True:
        left = materialize(left, "list-doubled")
        if not left.where("next >= 0").limit(1).count():
            return left.select("element", (total - F.col("length")).alias("place"))
        on = left.select(F.col("element").alias("next"), F.col("next").alias("_next"),
                         F.col("length").alias("_length"))
        left = left.join(on, "next", "left").select(
            "element", F.coalesce("_next", F.lit(-1).cast("long")).alias("next"),
            (F.col("length") + F.coalesce("_length", F.lit(0))).alias("length"))


def places(links: DataFrame) -> DataFrame:
    """(element, place) of a list (element, next, a, b), places from 0; -1 ends the list.

    Elements are longs from 0. The first round deals the elements by ranges of (a, b).
    """
    ship(links.sparkSession)
    heads = materialize(links.select("element", "next", F.lit(1).cast("long").alias("length"), "a", "b"), "list")
    n = heads.count()
    rounds: list[DataFrame] = []
    while True:
        if n <= LAST:
            dealt = heads.coalesce(1)
        else:
            dealt = heads.repartitionByRange("a", "b", "element").sortWithinPartitions("a", "b", "element")
        found = materialize(dealt.select("element", "next", "length", "a", "b").mapInArrow(
            _contract(max(CHUNK, LAST)), _RUNS), "list-runs")
        rounds.append(found)
        heads = found.where("element = head").select("element", "next", "length", "a", "b")
        before, n = n, heads.count()
        if n <= 1:
            placed = heads.select("element", F.lit(0).cast("long").alias("place"))
            break
        if n > KEPT * before:
            placed = _doubled(heads)
            break
    for found in reversed(rounds):
        above = placed.select(F.col("element").alias("head"), F.col("place").alias("_place"))
        placed = materialize(found.join(above, "head").select(
            "element", (F.col("_place") + F.col("way")).alias("place")), "list-places")
    return placed
